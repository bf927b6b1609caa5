"""SimHash near-duplicates: 64-bit fingerprints, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.graph import connected_components

from .batches import U64, by_bytes, stored, utf8

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a tile, and hashes whose bits are spread out at once.
TILE = 1024
ROWS = 1 << 15
#: Fewest bits by which fingerprints are brought together; more as their number grows.
LEAST_BLOCKS = RADIUS + 2


def fingerprint(text: bytes) -> int:
    """A bit is one if it is one in over half of the shingles' hashes; no word gives zero."""
    w = text.lower().split()
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= SHINGLE:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(x) + 1 for x in w]).tolist()
    digest = xxhash.xxh64_intdigest
    h = [digest(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[SHINGLE - 1 :])]
    octets = np.array(h, "<u8").view(np.uint8).reshape(-1, 8)
    ones = sum(np.unpackbits(octets[a : a + ROWS], axis=1, bitorder="little").sum(0, dtype=np.int64) for a in range(0, len(h), ROWS))
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``f``, the fingerprint as a signed number, for rows with an id; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            raw, at = utf8(batch.column("text"))
            own = raw.tobytes()
            f = np.array([fingerprint(own[a:b]) for a, b in zip(at[:-1], at[1:])], U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(f)], names=["doc_id", "f"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return ids.mapInArrow(run, "doc_id long, f long")


def block_masks(blocks: int) -> list[int]:
    """Masks of which two fingerprints within the radius agree on at least one.

    The bits are cut into ``blocks`` pieces; four differing bits leave ``blocks - RADIUS`` pieces alike.
    """
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    piece = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(piece, blocks - RADIUS)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def tile_links(a: np.ndarray, b: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint with a partner in the tile pair, links that join all it is near to.

    Exact comparison of sorted-by-population tiles. Rows whose population counts are further apart than the
    radius are not compared. A fingerprint links to its first partner in each row, and rows link on.
    """
    other = a if b is None else b
    pop_a, pop_b = np.bitwise_count(a), np.bitwise_count(other)
    left, right = [], []
    step = 64
    for s in range(0, len(a), step):
        rows = a[s : s + step]
        low = np.searchsorted(pop_b, max(0, int(pop_a[s]) - RADIUS))
        high = np.searchsorted(pop_b, int(pop_a[s : s + step][-1]) + RADIUS, side="right")
        if b is None:
            low = max(low, s)
        near = np.bitwise_count(rows[:, None] ^ other[None, low:high]) <= RADIUS
        i, j = np.nonzero(near)
        left.append(rows[i])
        right.append(other[low + j])
    x, y = (np.concatenate(left), np.concatenate(right)) if left else (a[:0], a[:0])
    keep = x != y
    return spanning(x[keep], y[keep])


def spanning(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest that joins the same fingerprints as the links do, so groups leave a row a member."""
    if not len(x):
        return x, y
    names, ends = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = ends[: len(x)], ends[len(x) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[root]
        if (new == root).all():
            break
        root = new
    i = np.flatnonzero(root != np.arange(len(names)))
    return names[i], names[root[i]]


def links(prints: DataFrame, n: int) -> DataFrame:
    """``u`` and ``v``: links between the distinct fingerprints ``f`` of ``prints`` that span their groups.

    Fingerprints that agree on a mask meet in a bucket. A bucket is cut into tiles of ``TILE`` by a hash;
    a pair of tiles is one group of at most two tiles, so a bucket of any size is spread over the cluster.
    The number of blocks follows the number of fingerprints, and with it the bits that a bucket shares.
    """
    blocks = LEAST_BLOCKS
    while n / 2.0 ** (64 * (blocks - RADIUS) / blocks) > 8 and blocks < 12:
        blocks += 1
    masks = F.array(*[F.struct(F.lit(i).alias("m"), F.col("f").bitwiseAND(F.lit(signed(m)).cast("long")).alias("v")) for i, m in enumerate(block_masks(blocks))])
    keyed = prints.select("f", F.explode(masks).alias("k")).select("f", "k.m", "k.v")
    held = keyed.groupBy("m", "v").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(held, ["m", "v"]).withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    mine = F.pmod(F.xxhash64("f"), F.col("tiles")).cast("int")
    met = met.withColumn("t", mine)
    pair: Column = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least("t", o).alias("i"), F.greatest("t", o).alias("j")))
    dealt = met.select("f", "m", "v", "t", F.explode(pair).alias("p")).select("f", "t", F.xxhash64("m", "v", "p.i", "p.j").alias("g"), (F.col("p.i") == F.col("p.j")).alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            g, f, tile = (t.column(c).to_numpy() for c in ("g", "f", "t"))
            cut = np.flatnonzero(np.diff(g)) + 1
            us, vs = [], []
            for a, b in zip(np.append(0, cut), np.append(cut, len(g))):
                if b - a < 2:
                    continue
                own, part = f[a:b].view(U64), tile[a:b]
                own = own[np.argsort(np.bitwise_count(own), kind="stable")] if (part == part[0]).all() else own
                if (part == part[0]).all():
                    u, v = tile_links(own, None)
                else:
                    sides = [own[part == p] for p in np.unique(part)]
                    u, v = tile_links(*[s[np.argsort(np.bitwise_count(s), kind="stable")] for s in sides])
                us.append(u)
                vs.append(v)
            u, v = (np.concatenate(x) if x else np.zeros(0, U64) for x in (us, vs))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        rows = 0
        for batch in batches:
            g = batch.column("g").to_numpy()
            if rows > 200_000 and len(g):
                last = held[-1].column("g")[held[-1].num_rows - 1].as_py()
                k = int(np.argmax(g != last)) if (g != last).any() else len(g)
                if k:
                    held.append(batch.slice(0, k))
                if k < len(g):
                    yield from flush()
                    held, rows = [], 0
                    batch = batch.slice(k)
                else:
                    continue
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
        if held:
            yield from flush()

    grouped = dealt.repartition("g").sortWithinPartitions("g")
    return grouped.mapInArrow(compare, "u long, v long").distinct()


def components(prints: DataFrame) -> DataFrame:
    """``f`` and ``c``, the smallest ``doc_id`` reachable, for the fingerprints of ``prints`` that have a near one.

    ``prints`` holds a row for each distinct fingerprint ``f`` with its smallest ``doc_id`` ``d``.
    """
    near = stored(links(prints, prints.count()))
    if near.isEmpty():
        return prints.select("f", F.col("d").alias("c")).limit(0)
    joined = connected_components(near.select(F.col("u").alias("src"), F.col("v").alias("dst")))
    named = prints.join(joined.select(F.col("id").alias("f"), "component"), "f")
    least = named.groupBy("component").agg(F.min("d").alias("c"))
    return named.join(least, "component").select("f", "c")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row with an id.

    Fingerprints of four-word shingles link at ``RADIUS`` or fewer differing bits; the component is named by
    the smallest id reachable. Null and empty texts have fingerprint zero and are linked like any other.
    Equal texts share a fingerprint and are one node of the graph, so a group of copies of any size costs one
    row. Rows repeated under one id are answered row by row; other columns are ignored.
    """
    marked = stored(fingerprints(docs))
    prints = stored(marked.groupBy("f").agg(F.min("doc_id").alias("d")))
    joined = components(prints)
    named = prints.join(joined, "f", "left").select("f", F.coalesce("c", "d").alias("component_id"))
    text = F.lower(F.lpad(F.hex("f"), 16, "0"))
    return marked.join(named, "f").select("doc_id", text.alias("fingerprint"), "component_id")
