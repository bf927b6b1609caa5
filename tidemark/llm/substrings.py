"""Substring dedup: words of long word sequences that stand earlier in the corpus, by suffix automata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats

WIDTH = 20
GRAM = 5
PLAN = repeats.Plan(WIDTH, GRAM, repeats.word_symbols, every=False)


class SuffixAutomaton:
    """Suffix automaton of the reference texts so far, over any hashable symbols."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0

    def extend(self, symbol) -> int:
        """Add a symbol; the matching statistic here: the longest end of the text that also stands earlier."""
        nexts, link, length = self.next, self.link, self.length
        cur = len(nexts)
        nexts.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        p = self.last
        while p >= 0 and symbol not in nexts[p]:
            nexts[p][symbol] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][symbol]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(symbol) == q:
                    nexts[p][symbol] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self.last = cur
        return length[link[cur]]


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    """Start and length of the stretches of true flags."""
    x = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(int(a), int(b - a)) for a, b in zip(x[::2], x[1::2])]


def repeated(group: list[list]) -> list[list[tuple[int, int]]]:
    """For each word list the runs of windows that also start in an earlier one, or earlier in itself.

    The lists are streamed in order through the automaton of what came before; where the matching statistic reaches
    the width, the window that ends there is a repeat. A mark that never comes again keeps the lists apart.
    """
    automaton, out = SuffixAutomaton(), []
    for i, line in enumerate(group):
        reach = [automaton.extend(w) for w in line]
        out.append(runs([r >= WIDTH for r in reach[WIDTH - 1 :]]))
        automaton.extend((i,))
    return out


def pieces(text: str, parts: list) -> list[bytes]:
    w = text.encode().split()
    return [b" ".join(w[p["start"] : p["start"] + p["n"] + WIDTH - 1]) for p in parts]


def resolve(t: pa.Table) -> Iterator[pa.RecordBatch]:
    key, doc, h, start = (t.column(c).to_numpy() for c in ("key", "doc_id", "h", "start"))
    content = t.column("content").to_pylist()
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    rows = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        for i, found in enumerate(repeated([content[k].split(b" ") for k in range(a, b)])):
            rows += [(doc[a + i], h[a + i], start[a + i] + s, n) for s, n in found]
    if rows:
        d, hh, s, n = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(hh, pa.int32()), pa.array(s, pa.int32()), pa.array(n, pa.int32())], names=["doc_id", "h", "start", "n"])


def remove(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row with an id.

    A word goes if one of the windows of ``WIDTH`` words over it also starts earlier: in a document of smaller id, or
    earlier in its own. Words are runs of bytes other than ASCII white space, unchanged. Null texts have no words.
    Rows repeated under one id are the same document, so neither is earlier; texts that differ under one id are
    ordered by where the window starts. Rows with a null id are left out; other columns are ignored.

    Windows meet by key (see ``repeats``). Only segments that share a key and differ are looked into: one of
    each content, in corpus order, streamed through the suffix automaton of their shard of the reference.
    """
    own = repeats.identified(docs)
    spans = repeats.spans_of(own, PLAN, pieces, resolve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digest, texts = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                w = text.encode().split()
                if found:
                    gone = repeats.covered(found, WIDTH, len(w)).tolist()
                    kept = b" ".join([x for x, g in zip(w, gone) if not g])
                    n_removed.append(sum(gone))
                else:
                    kept = b" ".join(w)
                    n_removed.append(0)
                n_words.append(len(w))
                digest.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    joined = own.join(spans.hint("shuffle_hash"), ["doc_id", "h"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
