"""Toxicity: a weighted lexicon, matched by Aho-Corasick over folded text, with exception phrases."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import by_bytes

#: Most toxic documents that a lexicon is learnt from, chosen by a hash, and clean ones for each of them.
MAX_TRAIN = 2_000
CLEAN_FOR_TOXIC = 4
#: Word beginnings looked at as terms, besides whole words.
STEMS = range(4, 9)
LEAST_DOCS = 3
#: Least log-likelihood ratio statistic of a term.
LEAST_G2 = 25.0
STRONG, WEAK = 20.0, 4.0
#: Share of clean documents among those with a phrase from which on it is an exception.
EXCEPTION_SHARE = 0.9
MAX_TERMS = 2_000

#: Look-alike letters, Cyrillic and Greek, and digits and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ӏ": "l", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": " "}


def _table() -> dict[int, str]:
    out = {i: " " for i in range(128) if not chr(i).isalnum()}
    out |= {0x2000 + i: " " for i in range(0x70)} | {0xA0: " ", 0xAB: " ", 0xBB: " "}
    out |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
    out |= {ord(a): b for a, b in {**HOMOGLYPHS, **SUBSTITUTES}.items()}
    out |= {0x00AD: "", 0x200B: "", 0x200C: "", 0x200D: "", 0xFEFF: ""}
    return out


TABLE = _table()
_NARROW = bytes(ord(TABLE.get(i, chr(i)) or " ") for i in range(256))


def fold(text: str | None) -> str:
    """Lower case, look-alikes and digits as letters, punctuation as blanks, one blank at either end."""
    low = (text or "").lower()
    try:
        low = low.encode("latin-1").translate(_NARROW, b"\xad").decode("latin-1")
    except UnicodeEncodeError:
        low = low.translate(TABLE)
    return f" {low} "


def terms_of(text: str | None) -> set[str]:
    """Terms of a text: ``" word "`` for whole words and ``" stem"`` for beginnings."""
    out = set()
    for w in set(fold(text).split()):
        if len(w) >= STEMS.start:
            out.add(f" {w} ")
            out.update(f" {w[:k]}" for k in STEMS if k <= len(w))
    return out


@dataclass(frozen=True)
class Lexicon:
    """Weights of terms, exception phrases, and the logistic curve over length-normalised weight."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-2.0, 1.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        a = ahocorasick.Automaton()
        for t, w in self.weights.items():
            a.add_word(t, (len(t), w))
        for p in self.exceptions:
            a.add_word(p, (len(p), 0.0))
        a.make_automaton()
        return a


def hits(automaton: ahocorasick.Automaton | None, folded: str) -> list[tuple[int, int, float]]:
    """``(start, end, weight)`` of the terms outside exception phrases, one for each place."""
    if automaton is None:
        return []
    best: dict[int, tuple[int, float]] = {}
    free: list[tuple[int, int]] = []
    for end, (n, w) in automaton.iter(folded):
        start = end - n + 1
        if w == 0.0:
            free.append((start, end))
        elif start not in best or w > best[start][1]:
            best[start] = (end, w)
    return [(a, b, w) for a, (b, w) in best.items() if not any(s <= a and b <= e + 1 for s, e in free)]


def features(automaton: ahocorasick.Automaton | None, text: str | None) -> tuple[float, float]:
    """Logarithm of the summed weight, and of the weight per hundred words."""
    folded = fold(text)
    total = sum(w for _, _, w in hits(automaton, folded))
    n = folded.count(" ") if total else 1
    return float(np.log1p(total)), float(np.log1p(100 * total / max(1, n)))


def choose(toxic_docs: list[set[str]], clean: Counter, n_clean: int) -> dict[str, float]:
    """Terms that tell toxic documents, with their log-odds as weights.

    Terms ``STRONG`` times as common in toxic documents are taken first, of those with a common beginning the
    most telling, at a draw the longest. Weaker ones follow one by one, judged by the toxic documents that
    no chosen term explains, so words that merely share a document with a telling term are not taken.
    """
    where: dict[str, set[int]] = defaultdict(set)
    for i, d in enumerate(toxic_docs):
        for t in d:
            where[t].add(i)
    n_toxic = max(1, len(toxic_docs))

    def g2(a: int, b: int) -> float:
        if a / n_toxic <= (b + 0.5) / (n_clean + 1):
            return 0.0
        out = 0.0
        share = (a + b) / (n_toxic + n_clean)
        for k, n in ((a, n_toxic), (b, n_clean)):
            for x, e in ((k, n * share), (n - k, n * (1 - share))):
                out += 2 * x * np.log(x / e) if x and e else 0.0
        return out

    left = {t: s for t, s in where.items() if len(s) >= LEAST_DOCS and g2(len(s), clean[t]) >= LEAST_G2}
    full = {t: len(s) for t, s in left.items()}
    rate = {t: (n + 0.5) / (n_toxic + 1) * (n_clean + 1) / (clean[t] + 0.5) for t, n in full.items()}
    left = {t: s for t, s in left.items() if rate[t] >= WEAK}

    def order(t: str) -> tuple[float, int, str]:
        return g2(len(left[t]), clean[t]), len(t.strip()), t

    def related(t: str, u: str) -> bool:
        return t.startswith(u.rstrip()) or u.startswith(t.rstrip())

    weights: dict[str, float] = {}
    done: set[int] = set()
    for t in sorted((t for t in left if rate[t] >= STRONG), key=order, reverse=True)[: 20 * MAX_TERMS]:
        if len(weights) < MAX_TERMS and not any(related(t, u) for u in weights):
            weights[t] = float(np.log(rate[t]))
            done |= left[t]
    left = {t: s - done for t, s in left.items() if t not in weights}
    while left and len(weights) < MAX_TERMS:
        best = max(left, key=order)
        if g2(len(left[best]), clean[best]) < LEAST_G2:
            break
        done = left.pop(best)
        weights[best] = float(np.log(rate[best]))
        left = {t: s - done for t, s in left.items() if len(s - done) >= LEAST_DOCS}
    return weights


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Coefficients by Newton's method; the ridge keeps them finite where the labels separate."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return tuple(float(v) for v in w)


def sample(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """``text`` and ``toxic`` of at most about ``max_train`` toxic documents and ``CLEAN_FOR_TOXIC`` times as many clean ones.

    Ids are chosen first, by hash, so only chosen texts move; equal texts with equal labels count once.
    """
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").distinct()
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    limit = F.lit(0)
    for label, n in total.items():
        most = max_train if label else CLEAN_FOR_TOXIC * max_train
        limit = F.when(F.col("toxic") == label, int(min(1.0, most / n) * (1 << 30))).otherwise(limit)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < limit).select(F.col("doc_id").alias("_id"), "toxic")
    joined = docs.select(F.col("doc_id").alias("_id"), "text").where("text is not null").join(F.broadcast(chosen), "_id")
    return joined.select("text", "toxic", F.sha2("text", 256).alias("_k")).dropDuplicates(["_k", "toxic"]).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Lexicon:
    """Lexicon, exceptions and curve from labelled documents; at most ``max_train`` toxic ones and four times as many clean ones reach the driver."""
    rows = sorted(sample(docs, labels, max_train).collect(), key=lambda r: (r["toxic"], r["text"]))  # one order in every run
    toxic_rows = [r["text"] for r in rows if r["toxic"] == 1]
    held: Counter = Counter()
    for t in toxic_rows:
        held.update(terms_of(t))
    often = {t: t for t, n in held.items() if n >= LEAST_DOCS}
    del held
    toxic = [{often[t] for t in terms_of(x) if t in often} for x in toxic_rows]
    clean: Counter = Counter()
    n_clean = 0
    for r in rows:
        if r["toxic"] == 0:
            n_clean += 1
            clean.update(often[t] for t in terms_of(r["text"]) if t in often)
    weights = choose(toxic, clean, n_clean)
    plain = Lexicon(weights)
    exceptions = phrases(plain, ((r["text"], r["toxic"]) for r in rows)) if weights else ()
    lexicon = Lexicon(weights, exceptions)
    automaton = lexicon.automaton()
    y = np.array([float(r["toxic"]) for r in rows])
    if len(set(y.tolist())) < 2:
        return lexicon
    x = np.array([features(automaton, r["text"]) for r in rows])
    return Lexicon(weights, exceptions, logistic(x, y))


def phrases(lexicon: Lexicon, rows: Iterable[tuple[str, int]]) -> tuple[str, ...]:
    """Two-word phrases around terms that are nearly always in clean documents."""
    automaton = lexicon.automaton()
    seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for text, label in rows:
        folded = fold(text)
        mine = set()
        for a, b, _ in hits(automaton, folded):
            end = folded.find(" ", a + 1)
            before = folded[:a].rsplit(None, 1)[-1:] if a else []
            after = folded[end : end + 60].split(None, 1)[:1]
            word = folded[a + 1 : end]
            mine |= {f" {x} {word} " for x in before} | {f" {word} {x} " for x in after}
        for p in mine:
            seen[p][label] += 1
    return tuple(sorted(p for p, (c, t) in seen.items() if c >= LEAST_DOCS and c / (c + t) >= EXCEPTION_SHARE))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (score of 0.5 or more) for every row.

    Only ``text`` is looked at, whole. Null and empty texts have no hits and get the curve's lowest score.
    Rows with a null or repeated id are answered row by row; other columns are ignored. The lexicon has at most
    ``MAX_TERMS`` terms.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        automaton = own.automaton()
        b0, b1, b2 = own.curve
        for batch in by_bytes(batches, "text"):
            x = np.array([features(automaton, t) for t in batch.column("text").to_pylist()]).reshape(-1, 2)
            p = 1 / (1 + np.exp(-np.clip(b0 + b1 * x[:, 0] + b2 * x[:, 1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
