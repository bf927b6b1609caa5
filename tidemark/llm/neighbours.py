"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import stored

#: Most distinct vectors that the tree is fitted on, chosen by a hash; all rows are indexed.
MAX_TRAIN = 20_000
BRANCHES = 8
#: Rows that a leaf is meant to hold: this many times the root of all rows, so that leaves, and the visits
#: of a query, grow with the root too; and at least so many.
LEAF_FACTOR, LEAST_LEAF = 4, 256
#: Query vectors whose exact neighbours calibrate the number of leaves to visit, and the recall to reach.
CALIBRATION = 96
RECALL = 0.97
#: Distinct vectors compared in one group, leaves next to each other in the tree together, and rows of one batch
#: of routed queries.
CHUNK = 4096


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays: centre of each node, its children, and the leaf number of nodes without any."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of every vector, going down to the nearest child."""
        at = np.zeros(len(unit), np.int64)
        while True:
            inner = np.unique(at[self.leaf[at] < 0])
            if not len(inner):
                return self.leaf[at]
            for node in inner:
                rows = np.flatnonzero(at == node)
                kids = self.children[node]
                at[rows] = kids[nearest(unit[rows], self.centres[kids])]

    def visits(self, unit: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves of one vector, taking the nearest open node from a priority queue."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
                continue
            kids = self.children[node]
            far = ((self.centres[kids] - unit) ** 2).sum(1)
            for d, k in zip(far.tolist(), kids.tolist()):
                heapq.heappush(queue, (d, k))
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Cluster of each row; empty clusters vanish."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = nearest(x, centres)
        used = np.unique(own)
        centres = np.stack([x[own == c].mean(0) for c in used])
    return nearest(x, centres)


def grow(unit: np.ndarray, leaf_rows: float, seed: int = 1) -> Tree:
    """Tree whose leaves hold at most about ``leaf_rows`` of the given vectors."""
    rng = np.random.default_rng(seed)
    centres, children, leaf = [unit.mean(0)], [np.zeros(0, np.int64)], [-1]
    todo, leaves = [(0, np.arange(len(unit)))], 0
    while todo:
        node, rows = todo.pop()
        groups = []
        if len(rows) > max(2.0, leaf_rows):
            own = kmeans(unit[rows], min(BRANCHES, len(rows)), rng)
            groups = [rows[own == c] for c in np.unique(own)]
        if len(groups) < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        first = len(centres)
        for g in groups:
            todo.append((len(centres), g))
            centres.append(unit[g].mean(0))
            children.append(np.zeros(0, np.int64))
            leaf.append(-1)
        children[node] = np.arange(first, len(centres))
    return Tree(np.stack(centres), children, np.array(leaf))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equally long vectors, held as bytes of ``width`` a component, in double precision."""
    if not len(column):
        return np.zeros((0, 0))
    return np.stack([np.frombuffer(v, f"<f{width}") for v in column.to_pylist()]).astype(np.float64)


def units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def component_bytes(vectors: DataFrame) -> int:
    """Bytes that hold a component exactly."""
    return 4 if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else 8


def packed(vectors: DataFrame, dim: int) -> DataFrame:
    """``vec_id`` and ``v``, the vector as bytes, of the rows that take part."""
    width = component_bytes(vectors)
    kind = "float" if width == 4 else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            sizes = np.diff(lists.offsets.to_numpy())
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(f"<f{width}")
            rows = np.flatnonzero(sizes == dim)
            if not len(rows):
                continue
            m = x[(np.cumsum(sizes) - sizes)[rows][:, None] + np.arange(dim)[None, :]] + 0
            ok = np.isfinite(m).all(1)
            with np.errstate(over="ignore", invalid="ignore"):
                size = np.linalg.norm(m.astype(np.float64), axis=1)
            ok &= np.isfinite(size) & (size > 0)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows[ok])), pa.array([r.tobytes() for r in m[ok]], pa.binary())], names=["vec_id", "v"])

    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("e"))
    return base.where((F.size("e") == dim) & (F.lit(dim) > 0) & F.col("vec_id").isNotNull()).mapInArrow(run, "vec_id long, v binary")


def dimension(vectors: DataFrame) -> int:
    """The commonest length of a vector."""
    sizes = vectors.where("embedding is not null").groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c"))
    first = sizes.orderBy(F.desc("c"), "n").first()
    return first["n"] if first else 0


def combined(rows: DataFrame, keep: int) -> DataFrame:
    """``v`` and ``ids``, its ``keep`` smallest ids ascending, for every distinct vector.

    Copies are combined before and in the shuffle, hot ones over salts, so that each group meets a bounded list; the
    further copies can be in no answer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            for v, i in zip(batch.column("v").to_pylist(), batch.column("vec_id").to_pylist()):
                held.setdefault(v, []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([sorted(set(i))[:keep] for i in held.values()], pa.list_(pa.int64()))], names=["v", "ids"])

    least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    salted = rows.mapInArrow(run, "v binary, ids array<long>").groupBy("v", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(32)).alias("s")).agg(least)
    return salted.groupBy("v").agg(least)


def search(vectors: DataFrame, k: int = 5, every: int = 50, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for each id divisible by ``every``.

    Score is the cosine in double precision on the original vectors, ties go to the smaller id, a query's own row is
    no candidate. The tree is fitted on at most ``MAX_TRAIN`` distinct vectors and every row is indexed. The
    number of leaves a query visits is the least at which the neighbours of ``CALIBRATION`` query vectors, found
    by comparing them with all rows, are reached with ``recall``.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids and vectors
    of another length than the commonest. Rows repeated under one id count once if their vectors are equal.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    dim, width = dimension(vectors), component_bytes(vectors)
    index = stored(combined(packed(vectors, dim), k + 1))
    n = index.count()
    if not n:
        return spark.createDataFrame([], schema)
    share = min(1.0, MAX_TRAIN / n)
    train = index.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("v").toArrow()
    if not train.num_rows:
        train = index.select("v").limit(1).toArrow()
    unit = units(matrix(train.column("v").combine_chunks(), width))
    order = np.lexsort(unit.T)
    tree = grow(unit[order], max(LEAST_LEAF, LEAF_FACTOR * n**0.5) * len(unit) / n)
    held = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = held.value.assign(units(matrix(batch.column("v"), width)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("v"), batch.column("ids")], names=["leaf", "v", "ids"])

    placed = stored(index.mapInArrow(place, "leaf long, v binary, ids array<long>"))
    size = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # a row a leaf, fewer than MAX_TRAIN
        size[r["leaf"]] = r["n"]
    block = (np.cumsum(size) - size) // CHUNK
    chunks = -(-np.bincount(block, weights=size).astype(np.int64) // CHUNK).clip(1)
    blocks = spark.createDataFrame([(i, int(b), int(chunks[b])) for i, b in enumerate(block)], "leaf long, block long, chunks long")
    dealt_rows = placed.join(F.broadcast(blocks), "leaf").withColumn("chunk", F.pmod(F.xxhash64("v"), F.col("chunks")))

    own = stored(packed(vectors.where(F.pmod("vec_id", F.lit(every)) == 0), dim).distinct())
    asked = stored(own.select("v").distinct().withColumn("q", F.monotonically_increasing_id()))
    visits = calibrate(placed, asked, tree, k, recall, width)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 64):
                batch = whole.slice(a, 64)
                take, at, leaves = [], [], []
                for i, u in enumerate(units(matrix(batch.column("v"), width))):
                    seen = np.sort(held.value.visits(u, visits))
                    for b in np.unique(block[seen]):
                        take.append(i)
                        at.append(int(b))
                        leaves.append(seen[block[seen] == b].tolist())
                q, v = batch.column("q").take(pa.array(take)), batch.column("v").take(pa.array(take))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), q, v, pa.array(leaves, pa.list_(pa.int64()))], names=["block", "q", "qv", "leaves"])

    routed = asked.mapInArrow(route, "block long, q long, qv binary, leaves array<long>")
    split = blocks.select("block", "chunks").distinct()
    dealt = routed.join(F.broadcast(split), "block").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")

    def compare(rows: pa.Table, queries: pa.Table) -> pa.Table:
        """Each leaf's rows with the queries that visit it; of a query only the best in the group go on."""
        none = pa.table({"q": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))})
        if not rows.num_rows or not queries.num_rows:
            return none
        q, x = queries.column("q").to_numpy(), matrix(queries.column("qv").combine_chunks(), width)
        y, ids = matrix(rows.column("v").combine_chunks(), width), rows.column("ids").combine_chunks()
        leaf = rows.column("leaf").to_numpy()
        asking: dict[int, list[int]] = {}
        for i, own in enumerate(queries.column("leaves").to_pylist()):
            for one in own:
                asking.setdefault(one, []).append(i)
        parts = []
        for one, who in asking.items():
            at = np.flatnonzero(leaf == one)
            if len(at):
                parts.append(best(q[who], x[who], y[at], ids.take(pa.array(at)), k + 1))
        if not parts:
            return none
        t = pa.concat_tables(parts).combine_chunks()
        first = np.array([i[0] for i in t.column("ids").to_pylist()])
        order = np.lexsort((first, -t.column("score").to_numpy(), t.column("q").to_numpy()))
        owner = t.column("q").to_numpy()[order]
        head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        rank = np.arange(len(owner)) - np.repeat(head, np.diff(np.append(head, len(owner))))
        return t.take(pa.array(order[rank <= k]))

    found = dealt_rows.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk")).applyInArrow(compare, "q long, score double, ids array<long>")
    pairs = found.select("q", F.explode(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("i")))).alias("p"))
    least = F.slice(F.array_sort(F.collect_list("p")), 1, k + 1).alias("near")
    near = pairs.groupBy("q").agg(least)
    answers = own.withColumnRenamed("vec_id", "query_id").join(asked, "v").join(near, "q")
    listed = answers.select("query_id", F.posexplode(F.slice(F.filter("near", lambda p: p["i"] != F.col("query_id")), 1, k)))
    return listed.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.i").alias("vec_id"), (-F.col("col.s")).alias("score"))


def best(q: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: pa.Array, most: int) -> pa.Table:
    """For every query the ``most`` vectors of largest cosine, ties by their smallest id."""
    cosine = queries @ rows.T / (np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None, :])
    first = np.array([i[0] for i in ids.to_pylist()])
    take_q, take_r = [], []
    for i in range(len(q)):
        s = cosine[i]
        cand = np.arange(len(s)) if len(s) <= most else np.flatnonzero(s >= np.partition(s, -most)[-most])
        cand = cand[np.lexsort((first[cand], -s[cand]))][:most]
        take_q.append(np.full(len(cand), i))
        take_r.append(cand)
    a, b = np.concatenate(take_q), np.concatenate(take_r)
    return pa.table({"q": pa.array(q[a]), "score": pa.array(cosine[a, b]), "ids": ids.take(pa.array(b))})


def calibrate(placed: DataFrame, asked: DataFrame, tree: Tree, k: int, recall: float, width: int) -> int:
    """Leaves to visit so that ``recall`` of the exact neighbours of some query vectors are met."""
    some = asked.orderBy(F.xxhash64("v")).limit(CALIBRATION).toArrow()
    if not some.num_rows:
        return 1
    queries = matrix(some.column("v").combine_chunks(), width)
    sent = placed.sparkSession.sparkContext.broadcast(queries)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = sent.value
                found = best(np.arange(len(own)), own, matrix(batch.column("v"), width), pa.array([[x] for x in batch.column("leaf").to_pylist()], pa.list_(pa.int64())), k + 1)
                yield from found.select(["q", "score", "ids"]).combine_chunks().to_batches()

    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("ids")[0].alias("leaf")))), 2, k).alias("near")
    rows = placed.mapInArrow(scan, "q long, score double, ids array<long>").groupBy("q").agg(top).collect()
    ranks = []
    for r in rows:
        order = {leaf: i for i, leaf in enumerate(tree.visits(units(queries[r["q"] : r["q"] + 1])[0], tree.leaves))}
        ranks += [order[x["leaf"]] for x in r["near"]]
    if not ranks:
        return tree.leaves
    ranks.sort()
    return ranks[min(len(ranks) - 1, ceil(recall * len(ranks)) - 1)] + 1

