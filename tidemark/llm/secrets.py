"""Secret scanning: fixed patterns, and formats learnt from what they find by grammar inference."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import by_bytes, stored

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = ("passw", "secret", "token", "key")
ASSIGN_LEAST = 12
#: Maximal runs, so their least lengths of 18 and 16 can stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: What may be a credential: a maximal run of its characters, from the least length of a labelled one on.
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{ASSIGN_LEAST},}}")

#: Most labelled credentials a kind's automaton is inferred from, and most documents ordinary words are gathered from.
MAX_EXAMPLES = 2_000
MAX_TRAIN_DOCS = 20_000
#: Confidence of the compatibility test of two states.
ALPHA = 0.01
#: Least mean log-likelihood ratio a symbol, in nats, by which a candidate looks more like a credential.
LEAST_RATIO = 0.5

CLASSES = "dhguU+/_.=-"
_CLASS = {c: ("d" if c in "0123456789" else "h" if c in "abcdef" else "g" if c.islower() else "u" if c in "ABCDEF" else "U" if c.isupper() else c)
          for c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_.=-"}
_TO_CLASS = str.maketrans(_CLASS)
END = "$"


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the matches of the fixed patterns in code points, by start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def credentials(text: str) -> list[tuple[str, str]]:
    """Kind and value of the matches: for assignments what is assigned."""
    out = []
    for a, kind, b in base_spans(text):
        value = text[a:b]
        if kind == "assign":
            value = ASSIGN.match(text, a).group(2)
        out.append((kind, value))
    return out


@dataclass
class Automaton:
    """Deterministic probabilistic automaton over character classes; every state can give every class."""

    next: list[dict[str, int]] = field(default_factory=list)
    logp: list[dict[str, float]] = field(default_factory=list)

    def score(self, symbols: str, plain: Sequence[float]) -> float:
        """Log-likelihood ratio of a string against ``plain``, the log-probabilities of its symbols as a word.

        A symbol never seen in a state leads out of the automaton; what follows is likelier in a word by ``LOST`` a symbol.
        """
        state, total = 0, 0.0
        for i, c in enumerate(symbols):
            total += self.logp[state][c] - plain[i]
            state = self.next[state].get(c, -1)
            if state < 0:
                return total + LOST * (len(symbols) - i - 1)
        return total


LOST = log(0.1)
#: Added to every class's count in a state, and to every length's.
SMOOTH = 0.1
LONGEST = 256


def infer(examples: Sequence[str], alpha: float = ALPHA) -> Automaton:
    """Merge the states of the examples' prefix tree that are statistically compatible.

    States are visited breadth first; a blue state is folded into the first red state whose counts of every
    symbol and of ends, here and below, differ by less than the Hoeffding bound, else it turns red.
    """
    children: list[dict[str, int]] = [{}]
    counts: list[dict[str, int]] = [{}]
    for x in examples:
        s = 0
        for c in x:
            counts[s][c] = counts[s].get(c, 0) + 1
            if c not in children[s]:
                children[s][c] = len(children)
                children.append({})
                counts.append({})
            s = children[s][c]
        counts[s][END] = counts[s].get(END, 0) + 1
    bound = sqrt(0.5 * log(2 / alpha))

    def alike(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = sum(counts[a].values()), sum(counts[b].values())
            if not na or not nb:
                continue
            most = bound * (1 / sqrt(na) + 1 / sqrt(nb))
            for c in counts[a].keys() | counts[b].keys():
                if abs(counts[a].get(c, 0) / na - counts[b].get(c, 0) / nb) > most:
                    return False
            todo += [(children[a][c], children[b][c]) for c in children[a].keys() & children[b].keys()]
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for c, n in counts[b].items():
                counts[a][c] = counts[a].get(c, 0) + n
            for c, t in children[b].items():
                if c in children[a]:
                    todo.append((children[a][c], t))
                else:
                    children[a][c] = t

    red, blue = [0], [(0, c) for c in sorted(children[0])]
    while blue:
        parent, c = blue.pop(0)
        b = children[parent][c]
        if b in red:
            continue
        for r in red:
            if alike(r, b):
                children[parent][c] = r
                fold(r, b)
                break
        else:
            red.append(b)
        blue = [(r, c) for r in red for c in sorted(children[r]) if children[r][c] not in red]
    number = {r: i for i, r in enumerate(red)}
    out = Automaton()
    every = CLASSES + END
    for r in red:
        n = sum(counts[r].values()) + SMOOTH * len(every)
        out.next.append({c: number[t] for c, t in children[r].items()})
        out.logp.append({c: log((counts[r].get(c, 0) + SMOOTH) / n) for c in every})
    return out


def lengths(values: Sequence[str]) -> list[float]:
    """Smoothed log-probability of each length; those of ``LONGEST`` and more count as one."""
    n = np.bincount([min(len(v), LONGEST) for v in values], minlength=LONGEST + 1) + SMOOTH
    return np.log(n / n.sum()).tolist()


@dataclass
class Formats:
    """An automaton for each kind of credential and one for ordinary candidates."""

    kinds: dict[str, Automaton]
    ordinary: dict[str, float]
    #: Log-probabilities of lengths by kind, and of words under ``word``; without them lengths do not count.
    sizes: dict[str, list[float]] = field(default_factory=dict)

    def rate(self, value: str) -> tuple[float, str]:
        """Mean log-likelihood ratio a symbol of the likeliest kind, its length counted, and that kind."""
        x = value.translate(_TO_CLASS)
        plain = [self.ordinary[a + b] for a, b in zip("^" + x, x)]
        size = min(len(x), LONGEST)
        long = {k: self.sizes[k][size] - self.sizes["word"][size] if k in self.sizes else 0.0 for k in self.kinds}
        best = max(((a.score(x, plain) + long[k], k) for k, a in self.kinds.items()), default=(float("-inf"), ""))
        return best[0] / max(1, len(x)), best[1]


def bigrams(words: Sequence[str]) -> dict[str, float]:
    """Smoothed log-probabilities of class pairs in ordinary words."""
    n: dict[str, int] = {}
    total: dict[str, int] = {}
    for w in words:
        last = "^"
        for c in w.translate(_TO_CLASS):
            n[last + c] = n.get(last + c, 0) + 1
            total[last] = total.get(last, 0) + 1
            last = c
    every = "^" + CLASSES
    return {a + b: log((n.get(a + b, 0) + 1) / (total.get(a, 0) + len(CLASSES))) for a in every for b in CLASSES}


WORD = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: How dates, times, book and telephone numbers are written, 0 for any digit.
NUMBERS = ("0000-00-00", "00.00.0000", "00/00/0000", "0000-00-00T00", "000-0-000-00000-0", "0-000-00000-0", "00-000-000-0000")


def fit(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS, max_examples: int = MAX_EXAMPLES) -> Formats:
    """Formats from the credentials that the fixed patterns label in all documents.

    At most ``max_examples`` distinct values a kind, those of smallest hash, leave a task and reach the driver, so a
    rare kind is learnt from all that there is of it. Ordinary words are those of smallest hash in about ``max_docs`` documents
    chosen by a hash of their text, so neither depends on how the rows are split. A word also stands for itself in
    capitals and for a number of its length, which texts hold less often but which are as ordinary, as are ``NUMBERS``.
    """
    texts = docs.select("text").where("text is not null")
    total = texts.count()
    share = min(1.0, max_docs / max(1, total))
    marked = texts.withColumn("sampled", F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def least(values: set[str]) -> list[str]:
        return sorted(values, key=lambda v: hashlib.md5(v.encode()).digest())[:max_examples]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, set[str]] = {k: set() for k in (*KINDS, "word")}
        for batch in by_bytes(batches, "text"):
            for text, sampled in zip(batch.column("text").to_pylist(), batch.column("sampled").to_pylist()):
                values = credentials(text)
                for kind, value in values:
                    found[kind].add(value)
                    if len(found[kind]) > 4 * max_examples:
                        found[kind] = set(least(found[kind]))
                if sampled:
                    secret = {v for _, v in values}
                    found["word"].update(w for w in WORD.findall(text) if w not in secret and not any(s in w for s in secret))
                    if len(found["word"]) > 4 * max_examples:
                        found["word"] = set(least(found["word"]))
        rows = [(k, v) for k, vs in found.items() for v in least(vs)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["kind", "value"])

    found = stored(marked.mapInArrow(gather, "kind string, value string").distinct())
    values = {k: [r[0] for r in found.where(F.col("kind") == k).select("value").orderBy(F.md5("value"), "value").limit(max_examples).collect()] for k in (*KINDS, "word")}
    kinds = {k: infer([v.translate(_TO_CLASS) for v in values[k]]) for k in KINDS if values[k]}
    ordinary = [x for w in values["word"] for x in (w, w.upper(), "0" * len(w))] + [n for n in NUMBERS for _ in range(1 + len(values["word"]) // 8)]
    return Formats(kinds, bigrams(ordinary), {k: lengths(values[k]) for k in (*kinds, "word")})


def learnt_spans(formats: Formats, text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Candidates that no base match covers and that are likelier in a credential's format than as a word.

    One that reaches beyond a base match is rated as a whole, and both count.
    """
    if not formats.kinds:
        return []
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if any(s <= a and b <= e for s, _, e in base):
            continue
        ratio, _ = formats.rate(m.group())
        if ratio >= LEAST_RATIO:
            out.append((a, "format", b))
    return out


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """For every row ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Spans are in code points, end exclusive, written ``kind:start:end``; ``base_sha256`` is over those of the fixed
    patterns, ``spans`` adds those that only the learnt formats find, as kind ``format``. Null and empty texts
    have none. Rows with a null or repeated id are answered row by row; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(formats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in by_bytes(batches, "text"):
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            digests, spans = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                more = learnt_spans(own, text or "", base)
                for k in KINDS:
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                order = {k: i for i, k in enumerate((*KINDS, "format"))}
                spans.append(joined(sorted(base + more, key=lambda s: (s[0], order[s[1]]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)


def redact(text: str, formats: Formats, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    base = base_spans(text)
    spans = sorted((a, b) for a, _, b in base + learnt_spans(formats, text, base))
    if not spans:
        return text
    out, at, end = [], 0, -1
    for a, b in spans:
        if a >= end:
            out += [text[at:a], mark]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])
