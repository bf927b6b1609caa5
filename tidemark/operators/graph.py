"""Graph jobs on edge tables: search, ranks, components and centrality.

Edges are spread once by source vertex, hub vertices over several partitions, and stay there;
each round moves only the vertex side. Rounds are cut by reliable checkpoints.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import HASH_BITS, seeded_hash
from ..functions.numeric import ratio
from ..session import cut_lineage
from . import brandes, lanes
from .edge_tiles import EdgeTiles, cardinality, either, largest, lay_tiles, pack, register_terms, unpack
from .ranks import row_numbers, text_row_numbers
from .skew import all_salts, hot_hashes, salt_of, salted_join

COMPACT_EVERY = 8
EDGES_PER_TASK = 20_000  # a small graph does not need every task of the cluster
PUSHES = 4  # rounds of a ranking between two looks at what is left
RANKS_AT_ONCE = 100_000
WORDS, STATE_BYTES = 16, 16 << 20  # 64-bit words of sources in a part at most, and bytes of its bits in a block
WAVE_BYTES = 2 << 30  # of the bits of all parts that go through tiles at once
FEW_WAYS = 500_000  # edges along which sketches are sent as rows
SKETCH_TILE, SKETCH_PARTS = 6_000_000, 32  # edges of a tile on average, and parts of a sketch at least
REGISTER_BYTES = 64 << 20  # of the registers of a part in a block
MESSAGES = 50_000_000  # rows that one round of a block of sources may send
LOOKS, APART_BYTES = 1024, 512 << 20  # looks counted together, and bytes of the sums of looks that are searched together


# -- building graphs --------------------------------------------------------------------------


def parse_adjacency(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``a: b c d`` lines as edges and vertices; a vertex without neighbours is kept."""
    part = F.split(F.col(value), ":")
    neighbours = F.array_remove(F.split(F.trim(F.try_element_at(part, F.lit(2))), r"\s+"), "")
    rows = lines.where(F.col(value).contains(":")).select(
        F.trim(part[0]).alias("src"), F.explode_outer(neighbours).alias("dst")
    )
    edges = rows.where(F.col("dst").isNotNull())
    ends = rows.select(F.explode(F.array("src", "dst")).alias("id")).where(F.col("id").isNotNull())
    return edges, ends.distinct()


def simple_undirected(edges: DataFrame) -> DataFrame:
    """Each connected pair once, smaller vertex first; loops and repeats dropped."""
    return (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    )


def both_ways(edges: DataFrame) -> DataFrame:
    """Both directions of every edge of the simple undirected graph."""
    ways = F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))
    return simple_undirected(edges).select(F.explode(ways).alias("_e")).select("_e.*")


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def index_vertices(edges: DataFrame) -> DataFrame:
    """Vertex labels with consecutive numbers in label order."""
    return number_labels(vertices(edges).withColumnRenamed("id", "label"))


def number_labels(labels: DataFrame) -> DataFrame:
    """Distinct labels with consecutive numbers ``id`` in their order."""
    if dict(labels.dtypes)["label"] == "string":
        return text_row_numbers(labels, "label", "id")
    return row_numbers(labels, "label", name="id")


def degrees(edges: DataFrame) -> DataFrame:
    """Number of neighbours in the simple undirected graph."""
    pairs = simple_undirected(edges)
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))


def high_degree(edges: DataFrame, more_than: int = 10) -> DataFrame:
    return degrees(edges).where(F.col("degree") > more_than)


def filter_vertices(edges: DataFrame, keep: DataFrame, id: str = "id") -> DataFrame:
    """Edges whose two ends are both in ``keep``."""
    kept = keep.select(id)
    first = edges.join(kept.withColumnRenamed(id, "src"), "src", "left_semi")
    return first.join(kept.withColumnRenamed(id, "dst"), "dst", "left_semi").select("src", "dst")


# -- spread edges -------------------------------------------------------------------------------


@dataclass
class SpreadEdges:
    """Edges kept partitioned by source vertex, the few hubs over many partitions each.

    The layout is cached; a lost executor's part is laid out again from the checkpoint below it.
    """

    edges: DataFrame
    hubs: list[int]

    def follow(self, points: DataFrame, vertex: str) -> DataFrame:
        """Rows of ``points`` joined with the edges leaving their vertex: only points move."""
        kind = dict(self.edges.dtypes)["src"]
        sent = points.withColumnRenamed(vertex, "src").withColumn("src", F.col("src").cast(kind)).withColumn(
            "_salt", F.explode(all_salts(["src"], self.hubs))
        )
        return sent.join(self.edges, ["src", "_salt"]).drop("_salt")

    def __enter__(self) -> SpreadEdges:
        return self

    def __exit__(self, *_: object) -> None:
        self.edges.unpersist()


def spread(edges: DataFrame, share: float = 0.002) -> SpreadEdges:
    """Lay edges out once; a hub holds about ``share`` of them, so there are few."""
    edges = cut_lineage(edges.where("src is not null and dst is not null").select("src", "dst").distinct())
    n = edges.count()
    # the one-pass summary also names rare vertices, whose copies every round would carry
    seen = edges.select(F.xxhash64("src").alias("h")).where(F.col("h").isin(hot_hashes(edges, ["src"], share))).groupBy("h").count()
    hubs = [r["h"] for r in seen.where(F.col("count") >= max(2.0, share * n)).collect()]
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = min(most, n // EDGES_PER_TASK + 1)
    laid = edges.withColumn("_salt", salt_of(["src"], hubs, ["dst"])).repartition(width, "src", "_salt")
    return SpreadEdges(laid.persist(StorageLevel.MEMORY_AND_DISK), hubs)


# -- search -----------------------------------------------------------------------------------


def bfs(edges: DataFrame, source: object, target: object = None) -> DataFrame:
    """Vertices reachable along edges with distance and smallest possible parent.

    Stops when nothing new is found or the target is reached.
    """
    with spread(edges) as graph:
        kind = dict(graph.edges.dtypes)["src"]
        start = graph.edges.sparkSession.range(1).select(
            F.lit(source).cast(kind).alias("node"), F.lit(None).cast(kind).alias("parent"), F.lit(0).alias("distance")
        )
        seen = frontier = cut_lineage(start)
        distance = 0
        while True:
            distance += 1
            reached = graph.follow(frontier.select("node"), "node").groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
            frontier = cut_lineage(
                reached.join(seen.select("node"), "node", "left_anti").select("node", "parent", F.lit(distance).alias("distance"))
            )
            if frontier.isEmpty():
                return seen
            seen = seen.unionByName(frontier)
            if distance % COMPACT_EVERY == 0:
                seen = cut_lineage(seen)
            if target is not None and not frontier.where(F.col("node") == target).isEmpty():
                return seen


def path_table(found: DataFrame) -> DataFrame:
    """Add the whole path from the source, as an array, to every row ``(node, parent, distance)`` of a search.

    Pointer doubling: a node holds the last part of its path and the vertex before that part; each round
    puts that vertex's own part in front, which doubles what is known. So there are as many joins as the longest
    distance has binary digits. Vertices that many others lead back to are spread by ``salted_join``.
    """
    state = cut_lineage(found.select("node", F.col("parent").alias("before"), "distance", F.array("node").alias("path")))
    while not state.where("before is not null").isEmpty():
        open_ = state.where("before is not null")
        jumps = state.select(F.col("node").alias("before"), F.col("before").alias("_b"), F.col("path").alias("_p"))
        longer = salted_join(open_, jumps, ["before"], ["node"]).select(
            "node", F.col("_b").alias("before"), "distance", F.concat("_p", "path").alias("path")
        )
        state = cut_lineage(state.where("before is null").unionByName(longer))
    return state.select("node", "distance", "path")


def shortest_path(edges: DataFrame, source: object, target: object) -> list[object]:
    """Vertices of one shortest path, smallest parents first choice; empty when there is none."""
    row = path_table(cut_lineage(bfs(edges, source, target))).where(F.col("node") == target).first()
    return row["path"] if row else []


def distance_histogram(edges: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Number of (source, vertex) pairs at each distance in the undirected graph.

    Sources are searched together, some hundreds in a part, as bits of every vertex. Where the edges fit a task, lanes
    search their parts to the end. Beyond, a part has a row per block of vertices, and a round sends what is new in them once to
    each tile of edges; ``WAVE_BYTES`` bounds what the parts of a wave hold. The largest distance is the diameter. The
    work grows with edges times ``sources``; for all sources of a large graph use ``distance_sketch``.
    """
    with lay_tiles(both_ways(edges)) as laid:
        ids = number_labels(laid.places.select(F.col("id").alias("label")))
        if sources is not None:
            wanted = sources.select(F.col("id").alias("label")).distinct()
            ids = number_labels(ids.join(wanted, "label", "left_semi").select("label"))
        ids = cut_lineage(ids)
        n, facts = ids.count(), laid.sizes.agg(F.max("size").alias("size"), F.sum("size").alias("all")).first()
        found: dict[int, int] = {}
        if lanes.fits(laid):
            found = _lane_distances(laid, ids, n, lanes.state_words(facts["all"] or 0, WORDS))
        else:
            words = max(1, min(WORDS, STATE_BYTES // (8 * facts["size"])))
            parts = -(-n // (64 * words))
            wave = max(1, min(parts, WAVE_BYTES // (8 * words * facts["all"])))
            with laid.in_lanes(wave) as graph:
                for lo in range(0, parts, wave):
                    some = ids.where((F.col("id") >= lo * 64 * words) & (F.col("id") < (lo + wave) * 64 * words))
                    for distance, n in _distances(graph, some, words):
                        found[distance] = found.get(distance, 0) + n
    return edges.sparkSession.createDataFrame(sorted(found.items()), "distance int, n bigint")


def _lane_distances(laid: EdgeTiles, ids: DataFrame, n: int, words: int) -> dict[int, int]:
    """``_distances`` of a graph that fits a task."""
    many = lanes.lanes_for(laid.edges.sparkSession, -(-n // (64 * words)))
    part = F.floor(F.col("id") / (64 * words)).cast("int")
    begin = ids.select("label", part.alias("a"), F.pmod("id", F.lit(64 * words)).cast("int").alias("b"))
    work = begin.join(lanes.numbered(laid).withColumnRenamed("id", "label"), "label").select(F.pmod("a", F.lit(many)).alias("lane"), "place", "a", "b")
    pairs = lanes.search(lanes.packed_rows(laid), work, many, lambda graph, own: lanes.distances(graph, own, words), "distance int, n bigint")
    return {r["distance"]: r["n"] for r in pairs.groupBy("distance").agg(F.sum("n").alias("n")).collect()}


def _distances(graph: EdgeTiles, ids: DataFrame, words: int) -> list[tuple[int, int]]:
    """Pairs at each distance from the sources ``ids (label, id)``, ``words`` times 64 of which make a part."""

    def begun(group: pa.Table) -> pa.Table:
        bits = np.zeros((group.column("size")[0].as_py(), words), np.uint64)
        bit = group.column("bit").to_numpy()
        bits[group.column("place").to_numpy(), bit // 64] = np.left_shift(np.uint64(1), (bit % 64).astype(np.uint64))
        own = pa.array([bits.tobytes()], pa.binary())
        return pa.table([group.column("block")[:1].combine_chunks(), group.column("part")[:1].combine_chunks(), own, own], names=["block", "part", "state", "message"])

    def along(src: np.ndarray, dst: np.ndarray, size: int, message: bytes) -> bytes:
        return either(src, dst, size, np.frombuffer(message, np.uint64).reshape(-1, words)).tobytes()

    def arrive(state: bytes | None, parts: Iterator[bytes]) -> tuple:
        new = None
        for part in parts:
            more = np.frombuffer(part, np.uint64)
            new = more if new is None else new | more
        if new is None:
            return state, None, 0
        seen = np.zeros_like(new) if state is None else np.frombuffer(state, np.uint64)
        new = new & ~seen
        n = int(np.bitwise_count(new).sum(dtype=np.int64))
        return (seen | new).tobytes(), new.tobytes() if n else None, n

    part = F.floor(F.col("id") / (64 * words)).cast("int")
    begin = ids.select(F.col("label"), part.alias("part"), F.pmod("id", F.lit(64 * words)).cast("int").alias("bit"))
    placed = begin.join(graph.places.withColumnRenamed("id", "label"), "label").join(graph.sizes, "block")
    state = cut_lineage(
        placed.select("block", "part", "place", "bit", "size").groupBy("block", "part")
        .applyInArrow(begun, "block int, part int, state binary, message binary")
    )
    rows = []
    while True:
        state = cut_lineage(graph.carry(state, along, arrive, "n bigint"))
        n = state.agg(F.sum("n")).first()[0]
        if not n:
            return rows
        rows.append((len(rows) + 1, n))


def distance_sketch(edges: DataFrame, log_k: int = 12) -> DataFrame:
    """Estimated number of ordered vertex pairs at each distance in the undirected graph, all vertices being sources.

    Every vertex keeps one distinct-count sketch of the vertices within the round's distance; a round merges its
    neighbours' sketches into it, so the state is one sketch a vertex. ``within`` is the number of pairs up to the
    distance, ``error`` the relative standard error of a sketch, ``1.04 / sqrt(2 ** log_k)``. Ends when no sketch changes.
    Up to ``FEW_WAYS`` edges sketches are sent along each. Beyond, lanes hold all edges and follow a part of the registers to
    the end; where the edges don't fit a task, registers go between blocks of vertices.
    """
    ways = cut_lineage(both_ways(edges))
    if ways.count() > FEW_WAYS:
        with lay_tiles(ways, tile=SKETCH_TILE) as laid:
            whole = lanes.fits(laid)
            size = laid.sizes.agg(F.sum("size") if whole else F.max("size")).first()[0]
            held = (lanes.STATE_BYTES if whole else REGISTER_BYTES) // size
            width = max(1, min(2**log_k // SKETCH_PARTS, 1 << int(math.log2(max(1, held)))))
            if whole:
                rows = _lane_registers(laid, log_k, width, size)
            else:
                with laid.in_lanes(2**log_k // width) as graph:
                    rows = _register_rounds(graph, log_k, width)
    else:
        with spread(ways) as graph:
            rows = _sketch_rounds(graph, log_k)
    found = edges.sparkSession.createDataFrame(rows, "distance int, n bigint, within bigint")
    return found.withColumn("error", F.lit(1.04 / 2 ** (log_k / 2)))


def _sketch_rounds(graph: SpreadEdges, log_k: int) -> list[tuple[int, int, int]]:
    kind = F.col("id").cast("string") if dict(graph.edges.dtypes)["src"] not in ("bigint", "int", "string") else F.col("id")
    own = vertices(graph.edges).select(F.col("id").alias("node"), kind.alias("v"))
    state = cut_lineage(own.groupBy("node").agg(F.hll_sketch_agg("v", F.lit(log_k)).alias("sketch")))
    facts = state.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.hll_sketch_estimate("sketch")), F.lit(0)).alias("total")).first()
    rows, distance, total = [], 0, facts["total"]
    while True:
        distance += 1
        sent = graph.follow(state, "node").select(F.col("dst").alias("node"), "sketch")
        merged = cut_lineage(state.unionByName(sent).groupBy("node").agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch")))
        now = merged.agg(F.coalesce(F.sum(F.hll_sketch_estimate("sketch")), F.lit(0)).alias("total")).first()["total"]
        if now <= total:
            return rows
        rows.append((distance, now - total, now - facts["n"]))
        total, state = now, merged


def _first_register(log_k: int, width: int) -> list[Column]:
    """The register that a vertex ``id`` sets: ``part``, ``register`` in the part and ``value``."""
    hashed = F.xxhash64(F.col("id").cast("string"), F.lit(log_k))
    register = F.pmod(hashed, F.lit(2**log_k))
    # the value is one more than the number of zeros that end the rest of the hash
    rest = F.shiftrightunsigned(hashed, log_k)
    value = F.when(rest == 0, 64 - log_k + 1).otherwise(F.round(F.log2(rest.bitwiseAND(-rest).cast("double"))) + 1).cast("int")
    return [F.floor(register / width).cast("int").alias("part"), F.pmod(register, F.lit(width)).cast("int").alias("register"), value.alias("value")]


def _lane_registers(laid: EdgeTiles, log_k: int, width: int, n: int) -> list[tuple[int, int, int]]:
    """``_register_rounds`` of a graph that fits a task."""
    many = lanes.lanes_for(laid.edges.sparkSession, 2**log_k // width)
    own = lanes.numbered(laid).select("place", *_first_register(log_k, width))
    work = own.select(F.pmod("part", F.lit(many)).alias("lane"), "place", F.col("part").alias("a"), (F.col("register") * 256 + F.col("value")).alias("b"))
    chunk = lanes.CHUNK
    changes = lanes.search(lanes.packed_rows(laid), work, many, lambda graph, own: lanes.registers(graph, own, width, chunk), "chunk int, round int, data binary")
    rows, total, now = [], n, 0.0
    for r in lanes.estimates(changes, n, 2**log_k, chunk).orderBy("round").collect():
        now += r["more"]
        if r["round"] and round(now) > total:
            rows.append((len(rows) + 1, round(now) - total, round(now) - n))
            total = round(now)
    return rows


def _register_rounds(graph: EdgeTiles, log_k: int, width: int) -> list[tuple[int, int, int]]:
    """Distance, pairs at it and pairs up to it, from HyperLogLog registers of which ``width`` make a part.

    A part's registers of a block are one packed row; a message holds those that rose in the round before and zeros. What
    the estimates need of a part is a sum and a count a vertex. A part that stands at the largest values there are is full.
    """
    k = 2**log_k

    def filled(group: pa.Table) -> pa.Table:
        own = np.zeros((group.column("size")[0].as_py(), width), np.uint8)
        own[group.column("place").to_numpy(), group.column("register").to_numpy()] = group.column("value").to_numpy()
        data = pack(own)
        return pa.table([*[group.column(c)[:1].combine_chunks() for c in ("block", "part")], pa.array([data], pa.binary()), pa.array([data], pa.binary())], names=["block", "part", "state", "message"])

    def along(src: np.ndarray, dst: np.ndarray, size: int, message: bytes) -> bytes:
        return pack(largest(src, dst, size, unpack(message, width)))

    def arrive(state: bytes | None, parts: Iterator[bytes]) -> tuple:
        old = None if state is None else unpack(state, width)
        new = old
        for part in parts:
            more = unpack(part, width)
            new = more if new is None else np.maximum(new, more)
        rose = new if old is None else np.where(new > old, new, np.uint8(0))
        changed = int(np.count_nonzero(rose))
        terms, zeros = register_terms(new)
        return pack(new), pack(rose) if changed else None, changed, pack(terms.view(np.uint8)), pack(zeros.view(np.uint8)), new.max(axis=0).tobytes(), new.min(axis=0).tobytes()

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, size = batch.column("block")[i].as_py(), batch.column("size")[i].as_py()
                if held is None or held[0] != block:
                    if held is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([cardinality(held[1], held[2], k)])], names=["total"])
                    held = (block, np.zeros(size), np.full(size, k, np.int64))
                held[1][:] += unpack(batch.column("terms")[i].as_py(), 8).view("<f8").ravel()
                held[2][:] += unpack(batch.column("zeros")[i].as_py(), 4).view("<i4").ravel() - width
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([cardinality(held[1], held[2], k)])], names=["total"])

    def summed(state: DataFrame) -> float:
        parts = state.select("block", "part", "terms", "zeros").join(F.broadcast(graph.sizes), "block")
        parts = parts.repartition(graph.blocks, "block").sortWithinPartitions("block", "part")
        return parts.select("block", "size", "terms", "zeros").mapInArrow(estimated, "total double").agg(F.sum("total")).first()[0]

    own = graph.places.select("block", "place", *_first_register(log_k, width)).join(F.broadcast(graph.sizes), "block")
    placed = own.select("block", "place", "size", "part", "register", "value")
    state = cut_lineage(placed.groupBy("block", "part").applyInArrow(filled, "block int, part int, state binary, message binary"))
    n = graph.places.count()
    rows, total = [], n
    while True:
        state = cut_lineage(graph.carry(state, along, arrive, "changed bigint, terms binary, zeros binary, most binary, least binary"))
        if not state.agg(F.sum("changed")).first()[0]:
            return rows
        now = max(total, round(summed(state)))
        if now > total:
            rows.append((len(rows) + 1, now - total, now - n))
            total = now
        full = state.groupBy("part").agg(F.collect_list("most").alias("most"), F.collect_list("least").alias("least")).collect()
        if all(_full(r["most"], r["least"]) for r in full) and len(full) == k // width:
            return rows


def _full(most: list[bytes], least: list[bytes]) -> bool:
    """Whether every vertex of every block has the largest value of each register."""
    top = np.max([np.frombuffer(m, np.uint8) for m in most], axis=0)
    return all((np.frombuffer(low, np.uint8) == top).all() for low in least)


# -- ranks -------------------------------------------------------------------------------------


def _settle(graph: EdgeTiles, nodes: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """Ranks of ``nodes (id, out)``, where ``out`` counts a vertex's neighbours among them.

    A vertex holds a rank and a residual, what its rank lacks. Each round the vertices whose residual exceeds their share
    of ``tolerance`` add it to their rank and send it on; the others stay quiet. When none is left the residuals sum
    to at most ``tolerance``, so all ranks together are within ``tolerance / (1 - damping)`` of the true ones. The start
    is the share of edges, near which an undirected graph settles. A block's vertices are one row of arrays.
    """
    facts = nodes.agg(F.count("*").alias("n"), F.sum("out").alias("total"), F.count_if(F.col("out") == 0).alias("dead")).first()
    n, total = facts["n"], facts["total"]
    if not n:
        return nodes.select("id", F.lit(None).cast("double").alias("rank"))
    base, least = (1.0 - damping) / n, tolerance / n

    def shown(out: np.ndarray, rank: np.ndarray, residual: np.ndarray, sent: np.ndarray) -> tuple:
        message = np.where(out > 0, sent / np.maximum(out, 1.0) * damping, 0.0)
        lost = float(sent[out == 0].sum())
        return np.stack([out, rank, residual, sent]).tobytes(), message.tobytes() if message.any() else None, int(np.count_nonzero(sent)), lost

    def begun(group: pa.Table) -> pa.Table:
        # a vertex outside ``nodes`` has a place, which counts as -1, and gets parts, but holds and sends nothing
        out = np.empty(len(group))
        out[group.column("place").to_numpy()] = group.column("out").to_numpy()
        rank = np.where(out < 0, 0.0, out / total if total else 1.0 / n)
        state = shown(out, rank, np.where(out < 0, 0.0, base - rank), rank)
        return pa.table([group.column("block")[:1].combine_chunks(), *[pa.array([v], k) for v, k in zip(state, (pa.binary(), pa.binary(), pa.int64(), pa.float64()))]], names=["block", "state", "message", "loud", "lost"])

    def along(src: np.ndarray, dst: np.ndarray, size: int, message: bytes) -> bytes:
        return np.bincount(dst, np.frombuffer(message)[src], size).tobytes()

    def round_of(lost: float) -> Callable:
        def arrive(state: bytes, parts: Iterator[bytes]) -> tuple:
            out, rank, residual, _ = np.frombuffer(state).reshape(4, -1)
            residual = residual + lost * damping / n
            for part in parts:
                residual += np.frombuffer(part)
            residual[out < 0] = 0.0
            loud = np.abs(residual) > least
            return shown(out, np.where(loud, rank + residual, rank), np.where(loud, 0.0, residual), np.where(loud, residual, 0.0))

        return arrive

    placed = graph.places.join(nodes.select("id", F.col("out").cast("double").alias("out")), "id", "left")
    state = cut_lineage(
        placed.select("block", "place", F.coalesce("out", F.lit(-1.0)).alias("out")).groupBy("block")
        .applyInArrow(begun, "block int, state binary, message binary, loud bigint, lost double").withColumn("part", F.lit(0))
    )
    lost = 0.0 if total else 1.0
    together = 1 if facts["dead"] else PUSHES  # what dead ends lose must be known after every round
    while True:
        for _ in range(together):
            state = graph.carry(state, along, round_of(lost), "loud bigint, lost double")
        state = cut_lineage(state)
        now = state.agg(F.sum("loud").alias("loud"), F.sum("lost").alias("lost")).first()
        if not now["loud"]:
            break
        lost = now["lost"]

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("state")):
                out, rank, *_ = np.frombuffer(data.as_py()).reshape(4, -1)
                place = np.flatnonzero(out >= 0)
                for some in (place[k : k + RANKS_AT_ONCE] for k in range(0, len(place), RANKS_AT_ONCE)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), block, np.int32)), pa.array(some.astype(np.int32)), pa.array(rank[some])], names=["block", "place", "rank"]
                    )

    found = state.select("block", "state").mapInArrow(ranks, "block int, place int, rank double")
    return graph.places.join(found, ["block", "place"]).select("id", "rank")


def _degrees(graph: EdgeTiles) -> DataFrame:
    out = graph.edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out"))
    return graph.places.select("id").join(out, "id", "left").select("id", F.coalesce("out", F.lit(0)).alias("out"))


def pagerank(edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-9) -> DataFrame:
    """Rank of every vertex, within ``tolerance / (1 - damping)`` in total; dead ends share their rank with all."""
    with lay_tiles(edges) as graph:
        return _settle(graph, cut_lineage(_degrees(graph)), damping, tolerance)


def connected_components(edges: DataFrame) -> DataFrame:
    """Vertex and the smallest vertex of its component.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), whose number of
    rounds grows with the logarithm of the graph, not with its diameter.
    """

    def star(pairs: DataFrame, emit) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return emit(salted_join(pairs, least.select("u", F.least("u", "m").alias("m")), ["u"], ["v"]))

    def large(pairs: DataFrame) -> DataFrame:
        ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = pairs.select(F.explode(ways).alias("_e")).select("_e.*")
        return star(both, lambda j: j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()

    def small(pairs: DataFrame) -> DataFrame:
        down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        links = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
        return star(down, lambda j: j.select(F.explode(links).alias("_e")).select("_e.*")).where("u <> v").distinct()

    nodes = vertices(edges)
    pairs = cut_lineage(simple_undirected(edges).select(F.col("b").alias("u"), F.col("a").alias("v")))
    mark = None
    while True:
        pairs = cut_lineage(small(cut_lineage(large(pairs))))
        now = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (now["n"], now["h"]) == mark:
            break
        mark = (now["n"], now["h"])
    stars = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.join(stars, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def largest_component(edges: DataFrame) -> DataFrame:
    """Edges of the component with most vertices; the smallest label wins a tie."""
    labels = cut_lineage(connected_components(edges))
    sizes = labels.groupBy("component").agg(F.count("*").alias("n"))
    best = sizes.agg(F.min(F.struct(-F.col("n"), "component"))).scalar()["component"]
    return filter_vertices(edges, labels.where(F.col("component") == best))


def influencers(edges: DataFrame, high: float, low: float, damping: float = 0.85, tolerance: float = 1e-9) -> DataFrame:
    """Ranks above ``low`` in the largest component left after dropping ranks of ``high`` and more.

    Both rankings walk one layout of the edges: the second one counts and keeps only what stays among its vertices.
    """
    with lay_tiles(both_ways(edges)) as graph:
        calm = cut_lineage(_settle(graph, cut_lineage(_degrees(graph)), damping, tolerance).where(F.col("rank") < high))
        # both ways of an edge are in one component, so what leaves a vertex here are its neighbours that stay
        core = largest_component(cut_lineage(filter_vertices(graph.edges, calm)))
        inside = core.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out"))
        return _settle(graph, cut_lineage(inside), damping, tolerance).where(F.col("rank") > low)


def _dependencies(graph: SpreadEdges, sources: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Shortest-path dependencies of one block of sources: by vertex ``(node, dep, dep2)`` and by edge ``(a, b, c)``.

    Forward rounds carry path counts, backward rounds carry dependencies (Brandes, 2001). ``dep2`` sums squares.
    """
    level = cut_lineage(sources.select(F.col("id").alias("s"), F.col("id").alias("node"), F.lit(1.0).alias("paths")))
    levels, seen = [level], level.select("s", "node")
    while True:
        reached = graph.follow(level, "node").groupBy("s", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths"))
        # on an undirected graph a new vertex can only have been seen one or two rounds ago
        level = cut_lineage(reached.join(seen, ["s", "node"], "left_anti"))
        if level.isEmpty():
            break
        levels.append(level)
        seen = levels[-2].select("s", "node").unionByName(level.select("s", "node"))

    lower = levels[-1].withColumn("dep", F.lit(0.0))
    vertex_parts, edge_parts = [lower.where(F.col("s") != F.col("node")).select("node", "dep")], []
    for upper in reversed(levels[:-1]):
        back = graph.follow(lower, "node").select(
            "s", F.col("src").alias("w"), F.col("dst").alias("node"), (F.lit(1.0) + F.col("dep")).alias("gain"), F.col("paths").alias("below")
        )
        shares = cut_lineage(
            back.join(upper, ["s", "node"]).select("s", "node", "w", "paths", (F.col("paths") / F.col("below") * F.col("gain")).alias("c"))
        )
        edge_parts.append(shares.select(F.least("node", "w").alias("a"), F.greatest("node", "w").alias("b"), "c"))
        gained = shares.groupBy("s", "node").agg(F.sum("c").alias("dep"))
        lower = cut_lineage(upper.join(gained, ["s", "node"], "left").withColumn("dep", F.coalesce("dep", F.lit(0.0))))
        vertex_parts.append(lower.where(F.col("s") != F.col("node")).select("node", "dep"))
    by_vertex = reduce(DataFrame.unionByName, vertex_parts).groupBy("node").agg(F.sum("dep").alias("dep"), F.sum(F.col("dep") * F.col("dep")).alias("dep2"))
    by_edge = reduce(DataFrame.unionByName, edge_parts).groupBy("a", "b").agg(F.sum("c").alias("c")) if edge_parts else None
    return by_vertex, by_edge


def _blocks(graph: SpreadEdges | EdgeTiles, nodes: DataFrame, n: int, seed: int, block: int | None) -> tuple[DataFrame, int]:
    """Vertices with the number of their block of sources, in hash order, and the number of blocks.

    A block's rounds send at most its sources times the edges, and ``MESSAGES`` bounds that.
    """
    block = block or max(1, MESSAGES // max(1, graph.edges.count()))
    hashed = nodes.select("id", seeded_hash(seed, "id").alias("h"))
    count = -(-n // block)
    return cut_lineage(hashed.select("id", F.floor(F.col("h") / F.lit(2.0**HASH_BITS) * count).cast("int").alias("block"))), count


def _normalised(value: Column, pairs: float) -> Column:
    return ratio(value / 2.0, F.lit(float(pairs)))


def betweenness(edges: DataFrame, seed: int = 1, block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Exact normalised betweenness of vertices ``(id, score)`` and of edges ``(a, b, score)``.

    All vertices are sources. Where the edges fit a task, sources are dealt over tasks that hold them; larger graphs
    go through joins, in blocks of sources, so what is held at once is a block's share and not all pairs.
    """
    with lay_tiles(both_ways(edges)) as laid:
        if lanes.fits(laid):
            return _lane_betweenness(laid)
    with spread(laid.edges) as graph:
        nodes = cut_lineage(vertices(graph.edges))
        n = nodes.count()
        blocked, count = _blocks(graph, nodes, n, seed, block)
        by_vertex, by_edge = nodes.select(F.col("id").alias("node"), F.lit(0.0).alias("dep")), simple_undirected(graph.edges).withColumn("c", F.lit(0.0))
        for i in range(count):
            own, crossed = _dependencies(graph, blocked.where(F.col("block") == i).select("id"))
            by_vertex = cut_lineage(by_vertex.unionByName(own.select("node", "dep")).groupBy("node").agg(F.sum("dep").alias("dep")))
            if crossed is not None:
                by_edge = cut_lineage(by_edge.unionByName(crossed).groupBy("a", "b").agg(F.sum("c").alias("c")))
        return _scores(by_vertex, by_edge, n)


def _scores(by_vertex: DataFrame, by_edge: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    return (
        by_vertex.select(F.col("node").alias("id"), _normalised(F.col("dep"), (n - 1) * (n - 2) / 2).alias("score")),
        by_edge.select("a", "b", _normalised(F.col("c"), n * (n - 1) / 2).alias("score")),
    )


def _lane_betweenness(laid: EdgeTiles) -> tuple[DataFrame, DataFrame]:
    packed, places = lanes.packed_rows(laid), cut_lineage(lanes.numbered(laid))
    n = places.count()
    sums = cut_lineage(brandes.total(brandes.searched(packed, places.select("place", F.lit(0).alias("look")), n, edges=True)))
    of = lambda kind: sums.where(F.col("kind") == kind)
    by_vertex = places.join(brandes.vertex_rows(of(brandes.VERTEX)), "place").select(F.col("id").alias("node"), "dep")
    by_edge = cut_lineage(brandes.edge_rows(packed, of(brandes.EDGE)))
    named = lambda end, id: places.select(F.col("place").alias(end), F.col("id").alias(id))
    near = salted_join(by_edge, named("p", "x"), ["p"], ["q"])
    ends = salted_join(near, named("q", "y"), ["q"], ["p"])
    by_edge = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "c")
    return _scores(by_vertex, cut_lineage(by_edge), n)


def betweenness_sampled(
    edges: DataFrame, error: float = 0.02, confidence: float = 0.95, seed: int = 1, block: int | None = None
) -> DataFrame:
    """Betweenness from as many sources as an error bound asks for: ``id, score, error, n_sources``.

    Blocks of sources are drawn in hash order until the empirical Bernstein bound (Maurer and Pontil, 2009), taken for all
    vertices and all looks together, is at most ``error`` for every vertex; with all sources the score is exact and
    the bound 0. ``error`` is the vertex's own bound at the end. A graph that fits a task is searched as in ``betweenness``.
    """
    with lay_tiles(both_ways(edges)) as laid:
        if lanes.fits(laid):
            return _lane_sampled(laid, error, confidence, seed, block)
    with spread(laid.edges) as graph:
        nodes = cut_lineage(vertices(graph.edges))
        n = nodes.count()
        if n < 3:
            return nodes.select("id", F.lit(0.0).alias("score"), F.lit(0.0).alias("error"), F.lit(n).cast("bigint").alias("n_sources"))
        blocked, count = _blocks(graph, nodes, n, seed, block)
        held = nodes.select(F.col("id").alias("node"), F.lit(0.0).alias("dep"), F.lit(0.0).alias("dep2"))
        log_term, used = math.log(2.0 * n * count / (1.0 - confidence)), 0
        for i in range(count):
            chosen = blocked.where(F.col("block") == i).select("id")
            used += chosen.count()
            own, _ = _dependencies(graph, chosen)
            held = cut_lineage(held.unionByName(own).groupBy("node").agg(F.sum("dep").alias("dep"), F.sum("dep2").alias("dep2")))
            mean = F.col("dep") / F.lit(float(used * (n - 2)))
            spread_ = F.greatest(F.col("dep2") / F.lit(float(used * (n - 2) ** 2)) - mean * mean, F.lit(0.0)) * (used / max(1, used - 1))
            bound = F.sqrt(spread_ * (2.0 * log_term / max(1, used))) + 7.0 * log_term / (3.0 * max(1, used - 1))
            scored = held.select(
                F.col("node").alias("id"), (mean * (n / (n - 1))).alias("score"),
                (F.lit(0.0) if used >= n else bound * (n / (n - 1))).alias("error"), F.lit(used).cast("bigint").alias("n_sources"),
            )
            if used and (used >= n or scored.agg(F.max("error")).first()[0] <= error):
                break
        return scored


def _lane_sampled(laid: EdgeTiles, error: float, confidence: float, seed: int, block: int | None) -> DataFrame:
    """``betweenness_sampled`` of a graph that fits a task: looks are searched together, and the first one that is close enough counts.

    Looks that can't be close enough are not kept apart from the next one. A sum of squared deviations never falls as
    sources are added, so what a look finds tells how many sources it takes at least.
    """
    n = laid.places.count()
    if n < 3:
        return laid.places.select("id", F.lit(0.0).alias("score"), F.lit(0.0).alias("error"), F.lit(n).cast("bigint").alias("n_sources"))
    blocked, count = _blocks(laid, laid.places, n, seed, block)
    log_term, wider = math.log(2.0 * n * count / (1.0 - confidence)), n / (n - 1)
    packed, places = lanes.packed_rows(laid), cut_lineage(lanes.numbered(laid))
    sources = cut_lineage(blocked.withColumnRenamed("block", "look").join(places, "id").select("place", "look"))
    drawn = sources.groupBy(F.floor(F.col("look") / LOOKS).cast("int").alias("some")).agg(F.count("*").alias("n")).orderBy("some").collect()
    slots = laid.edges.sparkSession.sparkContext.defaultParallelism
    apart = n / count < lanes.PER_SLOT * slots
    # no look before this many sources can be close enough, whatever the dependencies are
    wanted = math.inf if error <= 0 else 7.0 * log_term * wider / (3.0 * error)
    first, done, held = 0, 0, None
    while True:
        near = max(first, _look_of(sources, drawn, wanted))
        last = min(count, near + max(1, min(APART_BYTES // (16 * n), math.ceil(count * min(wanted, n) / n / 16))))
        some = sources.where((F.col("look") >= first) & (F.col("look") < last)).withColumn("look", F.greatest("look", F.lit(near)))
        looks = brandes.looked(brandes.total(brandes.searched(packed, some, n, edges=False, apart=apart, near=near)), held, n, log_term)
        worst = looks.where(F.col("look") >= near).groupBy("look").agg(F.max("n").alias("n"), F.max("worst").alias("worst")).orderBy("look").collect()
        good = [r for r in worst if r["n"] >= n or r["worst"] * wider <= error]
        if good or worst:
            stop = (good or worst[-1:])[0]
            held = looks.where(F.col("look") == stop["look"])
            done = stop["n"]
        if good:
            break
        if worst:
            rest = (stop["worst"] - 7.0 * log_term / (3.0 * max(1, done - 1))) * math.sqrt(done * (done - 1.0))
            wanted = (rest + 7.0 * log_term / 3.0) * wider / error * (1 - 1e-9) if error > 0 else math.inf
        first = last
    rows = places.join(brandes.vertex_rows(held), "place")
    used = stop["n"]
    mean = F.col("dep") / F.lit(float(used * (n - 2)))
    spread_ = F.greatest(F.col("dep2") / F.lit(float(used * (n - 2) ** 2)) - mean * mean, F.lit(0.0)) * (used / max(1, used - 1))
    bound = F.sqrt(spread_ * (2.0 * log_term / used)) + 7.0 * log_term / (3.0 * max(1, used - 1))
    return cut_lineage(rows.select(
        "id", (mean * wider).alias("score"), (F.lit(0.0) if used >= n else bound * wider).alias("error"), F.lit(used).cast("bigint").alias("n_sources"),
    ))


def _look_of(sources: DataFrame, drawn: list, wanted: float) -> int:
    """The first look that has drawn ``wanted`` sources, or the last one; ``drawn`` counts them for ``LOOKS`` looks each."""
    held = 0
    for r in drawn:
        if held + r["n"] >= wanted or r is drawn[-1]:
            break
        held += r["n"]
    own = sources.where(F.floor(F.col("look") / LOOKS) == r["some"]).groupBy("look").agg(F.count("*").alias("n")).orderBy("look").collect()
    for look in own:
        held += look["n"]
        if held >= wanted:
            break
    return look["look"]
