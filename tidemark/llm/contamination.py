"""Benchmark decontamination: containment search by size-partitioned MinHash, then exact containment."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import U64, by_bytes, lower, mix, starts_inside, utf8, window_hashes, word_hashes, words

SHINGLE = 5
THRESHOLD = 0.8
#: Characters of test items in one block; a block's sketches and texts are broadcast together.
BLOCK_CHARS = 16_000_000
#: Sketch hashes beyond those that the pigeonhole bound asks for.
SPARE = 8
FOUND = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"


def shingles(text: bytes) -> list[bytes]:
    """Lower-cased word sequences; a text of fewer words is one shingle, an empty one has none."""
    w = text.lower().split()
    if len(w) < SHINGLE:
        return [b" ".join(w)] if w else []
    return [b" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)]


def hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of every text, and the text it belongs to."""
    starts, ends, first = words(raw, at)
    h = word_hashes(lower(raw), starts, ends)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    inside = starts_inside(first, SHINGLE)
    whole = window_hashes(h, SHINGLE)[inside]
    of = owner[: len(inside)][inside]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        rest = np.zeros(len(short), U64)
        for i, t in enumerate(short):
            rest[i] = window_hashes(h[first[t] : first[t + 1]], int(n[t]))[0] + U64(n[t])
        whole, of = np.concatenate([whole, rest]), np.concatenate([of, short])
    return whole, of


class Sketches:
    """Sketches of a block of test items, held by the partition of their number of shingles.

    In a partition of sizes up to ``u`` the sketch of an item is its ``(1 - threshold) * u + SPARE`` smallest
    shingle hashes (a bottom-k MinHash), so an item of containment ``threshold`` or more shares at least one
    with the document, and about the containment's share of all. The size of the document plays no part.
    """

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        self.threshold = threshold
        self.sets = [(i, set(shingles(t.encode()))) for i, t in items]
        size_of, hash_rows = [], []
        raw = [t.encode() for _, t in items]
        at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        h, of = hashes(np.frombuffer(b"".join(raw), np.uint8), at)
        order = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[order], np.arange(len(items) + 1))
        for i in range(len(items)):
            own = np.unique(mix(h[order[cut[i] : cut[i + 1]]]))
            size_of.append(len(own))
            upper = 1 << max(0, len(own) - 1).bit_length()
            k = min(len(own), int((1 - threshold) * upper + 1e-9) + SPARE)
            hash_rows.append(own[:k])
        self.need = [max(1, len(r) - int((1 - threshold) * n + 1e-9)) if n else 0 for n, r in zip(size_of, hash_rows)]
        self.keys = np.concatenate(hash_rows) if hash_rows else np.zeros(0, U64)
        self.item = np.repeat(np.arange(len(items)), [len(r) for r in hash_rows])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.item = self.keys[order], self.item[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.keys >> U64(44)] = True

    def candidates(self, raw: np.ndarray, at: np.ndarray) -> dict[int, list[int]]:
        """Items that each text may contain: those of which enough sketch hashes are met."""
        h, of = hashes(raw, at)
        h = mix(h)
        maybe = np.flatnonzero(self.bits[h >> U64(44)])
        h, of = h[maybe], of[maybe]
        low, high = np.searchsorted(self.keys, h), np.searchsorted(self.keys, h, side="right")
        n = high - low
        at_key = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        met = np.unique(np.stack([np.repeat(of, n), at_key]), axis=1)
        pairs, counts = np.unique(np.stack([met[0], self.item[met[1]]]), axis=1, return_counts=True)
        out = defaultdict(list)
        for t, i, c in zip(*pairs.tolist(), counts.tolist()):
            if c >= self.need[i]:
                out[t].append(i)
        return out


def blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``BLOCK_CHARS`` characters, dealt by a hash of their ids."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, ceil(size / BLOCK_CHARS))
    for k in range(n):
        yield [(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).sort("item_id").collect()]


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a document and a test item of whose distinct five-word shingles it holds ``threshold`` or more.

    Columns ``doc_id, item_id, n_shared, n_shingles, containment``. Words are runs of bytes other than ASCII
    white space, A-Z in lower case. Null and empty texts are in no pair, nor are rows with a null id. Repeated
    document rows give their pairs once each row; repeated item rows count once, rows with one id and different
    texts are items of their own. Documents are only mapped over, never shuffled: a hot source or a passage in
    a third of the rows costs what its texts cost. Items are the stated query set and broadcast in blocks.
    """
    spark, found = docs.sparkSession, None
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    for block in blocks(items):
        held = spark.sparkContext.broadcast(Sketches(block, threshold))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            sketches = held.value
            for batch in by_bytes(batches, "text"):
                raw, at = utf8(batch.column("text"))
                ids, rows = batch.column("doc_id").to_pylist(), []
                for t, near in sketches.candidates(raw, at).items():
                    own = set(shingles(raw[at[t] : at[t + 1]].tobytes()))
                    for i in near:
                        item, wanted = sketches.sets[i]
                        shared = len(wanted & own)
                        if shared >= threshold * len(wanted) - 1e-9:
                            rows.append((ids[t], item, shared, len(wanted), shared / len(wanted)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"])

        part = base.mapInArrow(run, FOUND)
        found = part if found is None else found.unionByName(part)
    return found
