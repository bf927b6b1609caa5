"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import by_bytes, stored, utf8
from .tokens import Encoder

CAPACITY = 2048
END = 0
#: Bytes of text encoded at once: their hashes and offsets take some 40 times as much, in every worker of an executor.
SLICE_BYTES = 1 << 18
#: Pieces on one island.
ISLAND = 50_000
EPOCHS = 3
GENERATIONS = 4
POPULATION = 4
#: Share of a bin that must be full for it to be handed on.
WELL_FILLED = 0.995
#: Share of the items that a level must finish for another to follow, so levels grow with the logarithm of the items.
LEAST_PROGRESS = 0.1

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_encoders: dict[tuple, Encoder] = {}


def encoder(paths: tuple[str, str, str]) -> Encoder:
    if paths not in _encoders:
        _encoders[paths] = Encoder(*paths)
    return _encoders[paths]


def pieces(docs: DataFrame, paths: tuple[str, str, str], capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, its end mark included.

    Only longer documents are cut; all pieces but the first are full. A null text is empty, so its document
    is the end mark alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(paths)
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            raw, at = utf8(batch.column("text"))
            ids, cut = own.ids(raw, at)
            docs_of, piece, start, length, crc = [], [], [], [], []
            for t in range(batch.num_rows):
                mine = np.append(ids[cut[t] : cut[t + 1]], np.uint32(END)).astype("<u4", copy=False).tobytes()
                n = len(mine) >> 2
                a, b, k = 0, n % capacity or capacity, 0
                while a < n:
                    docs_of.append(t)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(memoryview(mine)[4 * a : 4 * b]))
                    a, b, k = b, b + capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(docs_of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


class Bins:
    """Bins under way, found by the room that is left in them."""

    def __init__(self, capacity: int):
        self.capacity, self.members, self.room = capacity, [], []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def open(self, members: list[int], filled: int) -> None:
        room = self.capacity - filled
        self.members.append(members)
        self.room.append(room)
        self.by_room[room].append(len(self.members) - 1)
        self.mask |= 1 << room

    def put(self, item: int, length: int) -> None:
        """Into the bin where it leaves least room, or a new one."""
        fits = self.mask >> length
        if not fits:
            self.open([item], length)
            return
        room = length + (fits & -fits).bit_length() - 1
        held = self.by_room[room]
        b = held.pop()
        if not held:
            self.mask ^= 1 << room
        self.members[b].append(item)
        left = self.room[b] = room - length
        self.by_room[left].append(b)
        self.mask |= 1 << left


def best_fit(order: list[int], length: list[int], capacity: int, begun: list[list[int]] = ()) -> list[list[int]]:
    bins = Bins(capacity)
    for members in begun:
        bins.open(members, sum(length[i] for i in members))
    for i in order:
        bins.put(i, length[i])
    return bins.members


def worth(groups: list[list[int]], length: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among as many, unevenly filled ones."""
    return -len(groups), float(sum((sum(length[i] for i in g) / capacity) ** 2 for g in groups))


def crossover(into: list[list[int]], injected: list[list[int]], length: list[int], capacity: int) -> list[list[int]]:
    """Whole bins of one parent go into the other: bins that share an item with them are
    dissolved and their other items put back by best fit, longest first."""
    taken = {i for g in injected for i in g}
    kept, loose = [], []
    for g in into:
        if taken.isdisjoint(g):
            kept.append(g)
        else:
            loose += [i for i in g if i not in taken]
    loose.sort(key=length.__getitem__, reverse=True)
    room = [g for g in kept if sum(length[i] for i in g) < capacity]
    full = [g for g in kept if sum(length[i] for i in g) == capacity]
    return injected + full + best_fit(loose, length, capacity, [list(g) for g in room])


def filled(groups: list[list[int]], length: list[int], capacity: int) -> list[list[int]]:
    return [g for g in groups if sum(length[i] for i in g) >= WELL_FILLED * capacity]


def from_patterns(patterns: list[tuple[int, ...]], length: list[int]) -> list[list[int]]:
    """Bins of another island, as lengths, rebuilt from own items as far as those are there."""
    free: dict[int, list[int]] = {}
    for i, n in enumerate(length):
        free.setdefault(n, []).append(i)
    out = []
    for p in patterns:
        got = []
        for n in p:
            if not free.get(n):
                break
            got.append(free[n].pop())
        if len(got) == len(p):
            out.append(got)
        else:
            for i in got:
                free[length[i]].append(i)
    return out


def evolve(length: list[int], capacity: int, seed: int, start: list[list[int]] | None = None, guests: list[tuple[int, ...]] = (), generations: int = GENERATIONS) -> list[list[int]]:
    """The best grouping of a population of best-fit packings after some generations."""
    rng = np.random.default_rng(seed)
    order = sorted(range(len(length)), key=length.__getitem__, reverse=True)
    people = [start] if start else [best_fit(order, length, capacity)]
    lower = ceil(sum(length) / capacity)
    if start is None and len(people[0]) <= lower:
        return people[0]
    if guests:
        migrant = from_patterns(list(guests), length)
        people.append(crossover(people[0], migrant, length, capacity))
    while len(people) < POPULATION:
        noise = np.array(length) * rng.uniform(1 - 0.15 * len(people), 1, len(length))
        people.append(best_fit(np.argsort(-noise).tolist(), length, capacity))
    scored = sorted(((worth(p, length, capacity), k, p) for k, p in enumerate(people)), reverse=True)
    for g in range(generations):
        if -scored[0][0][0] <= lower:
            break
        children = []
        for _ in range(POPULATION // 2):
            a, b = rng.choice(len(scored), 2, replace=False)
            good = filled(scored[b][2], length, capacity)
            share = rng.uniform(0.3, 0.9)
            injected = [x for x, r in zip(good, rng.random(len(good))) if r < share]
            child = crossover(scored[a][2], [list(x) for x in injected], length, capacity)
            children.append((worth(child, length, capacity), POPULATION * (g + 1) + len(children), child))
        scored = sorted(scored + children, key=lambda x: (x[0], -x[1]), reverse=True)[:POPULATION]
    return scored[0][2]


def island_round(rows: DataFrame, islands: int, capacity: int, epoch: int) -> DataFrame:
    """One epoch: every island evolves its items; from the second on, with its neighbour's bins as guests."""
    schema = "island int, doc_id long, piece int, length long, bin int"
    items = rows.groupBy("island")

    def solve(own: pa.Table, near: pa.Table | None) -> pa.Table:
        own = own.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        length = own.column("length").to_pylist()
        start, guests = None, []
        if near is not None:
            start = split(own.column("bin").to_numpy())
            theirs = near.column("length").to_numpy()
            guests = sorted((tuple(sorted(theirs[g].tolist(), reverse=True)) for g in split(near.column("bin").to_numpy())), key=lambda p: (-sum(p), p))
            guests = [p for p in guests if sum(p) >= WELL_FILLED * capacity]
        island = own.column("island")[0].as_py() if own.num_rows else 0
        groups = evolve(length, capacity, island * 1000 + epoch, start, guests)
        bins = np.zeros(own.num_rows, np.int32)
        for b, g in enumerate(groups):
            bins[g] = b
        return own.select(["island", "doc_id", "piece", "length"]).append_column("bin", pa.array(bins))

    if epoch == 0:
        return items.applyInArrow(lambda t: solve(t, None), schema)
    guests = rows.select(F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), "length", "bin")
    return items.cogroup(guests.groupBy("island")).applyInArrow(solve, schema)


def split(bins: np.ndarray) -> list[list[int]]:
    order = np.argsort(bins, kind="stable")
    return [g.tolist() for g in np.split(order, np.flatnonzero(np.diff(bins[order])) + 1)] if len(bins) else []


def group(items: DataFrame, capacity: int = CAPACITY, island: int = ISLAND, epochs: int = EPOCHS) -> DataFrame:
    """``doc_id, piece, length, island, bin`` of items shorter than ``capacity``.

    Items are dealt over islands of about ``island`` by a hash. Every epoch each island takes the well-filled
    bins of its neighbour, as patterns of lengths, into its population. At the end the items of bins that are not
    well filled leave for fewer islands and are grouped anew, until one island holds the rest or a level finishes
    too few: items of which hardly any fill a bin together stay in the bins they are in.
    """
    n = items.count()
    done, level = None, 0
    rest = items.select("doc_id", "piece", "length")
    while True:
        islands = max(1, ceil(n / island))
        rows = rest.withColumn("island", F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(islands)).cast("int"))
        for epoch in range(epochs if islands > 1 else 1):
            rows = stored(island_round(rows, islands, capacity, epoch))
        rows = rows.withColumn("level", F.lit(level))
        if islands == 1:
            break
        fill = F.sum("length").over(Window.partitionBy("island", "bin"))
        rows = rows.withColumn("fill", fill)
        rest = stored(rows.where(F.col("fill") < WELL_FILLED * capacity).select("doc_id", "piece", "length"))
        before, n = n, rest.count()
        if n > (1 - LEAST_PROGRESS) * before:
            rows = rows.drop("fill")
            break
        good = rows.where(F.col("fill") >= WELL_FILLED * capacity).drop("fill")
        done = good if done is None else done.unionByName(good)
        level += 1
    return rows if done is None else done.unionByName(rows)


def pack(docs: DataFrame, paths: tuple[str, str, str], capacity: int = CAPACITY, island: int = ISLAND) -> DataFrame:
    """Every piece of every document with its place: ``sequence_id`` and gapless ``offset``.

    Columns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null text is empty and packed as
    its end mark; other columns are ignored. Rows with a null id or an id given twice are documents of their
    own: pieces are told apart by a number given to each row of the stored piece table.
    """
    cut = stored(pieces(docs, paths, capacity).withColumn("row", F.monotonically_increasing_id()))
    light = cut.where(F.col("length") < capacity).select(F.col("row").alias("doc_id"), "piece", "length")
    order = Window.partitionBy("level", "island", "bin").orderBy(F.desc("length"), "doc_id")
    placed = group(light, capacity, island)
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    number = (F.col("level").cast("long") * (1 << 56)) + F.col("island").cast("long") * (1 << 24) + F.col("bin")
    placed = placed.select(F.col("doc_id").alias("row"), (number + 1).alias("sequence_id"), F.coalesce(before, F.lit(0)).cast("long").alias("offset"))
    full = cut.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    short = cut.where(F.col("length") < capacity).join(placed, "row")
    return full.unionByName(short).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
