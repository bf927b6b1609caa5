import random
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import rows

from tidemark.operators import brandes, edge_tiles, graph, lanes

# The small friendship graph, one line per person, with a repeated edge.
FRIENDS = """Mary: Peter Albert DavidF Peter
Judy: Bob Alan
Peter: Mary DavidF Jon
DavidF: Albert Joseph Peter Mary
Jon: Peter Joseph DavidE
DavidE: Jon Joseph Albert
Joseph: DavidE Jon DavidF
Bob: Judy Alan
Alan: Bob Mary Judy
Albert: DavidF Mary DavidE"""


@pytest.fixture(scope="module")
def friends(spark):
    edges, _ = graph.parse_adjacency(spark.createDataFrame([(l,) for l in FRIENDS.split("\n")], "value string"))
    return edges.persist()


def neighbours(pairs):
    near = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return near


def distances(near, source):
    seen, queue = {source: 0}, deque([source])
    while queue:
        u = queue.popleft()
        for v in near.get(u, ()):
            if v not in seen:
                seen[v] = seen[u] + 1
                queue.append(v)
    return seen


def brute_betweenness(near):
    score = dict.fromkeys(near, 0.0)
    for s in near:
        dist, paths, order, queue = {s: 0}, {s: 1}, [], deque([s])
        while queue:
            u = queue.popleft()
            order.append(u)
            for v in near[u]:
                if v not in dist:
                    dist[v], paths[v] = dist[u] + 1, 0
                    queue.append(v)
                if dist[v] == dist[u] + 1:
                    paths[v] += paths[u]
        gain = dict.fromkeys(near, 0.0)
        for w in reversed(order):
            for v in near[w]:
                if dist[v] == dist[w] - 1:
                    gain[v] += paths[v] / paths[w] * (1 + gain[w])
            if w != s:
                score[w] += gain[w]
    n = len(near)
    return {v: x / ((n - 1) * (n - 2)) for v, x in score.items()}


@pytest.fixture(scope="module")
def random_graph(spark):
    """A hub with a third of the edges, a chain, separate parts and a loop."""
    rng = random.Random(3)
    pairs = [(0, i) for i in range(1, 30)] + [(100 + i, 101 + i) for i in range(25)] + [(29, 100), (7, 7)]
    pairs += [(rng.randint(1, 29), rng.randint(1, 29)) for _ in range(30)] + [(500, 501), (501, 502), (502, 500)]
    return pairs, spark.createDataFrame(pairs, "src bigint, dst bigint").persist()


def test_simple_graph_and_ids(friends):
    assert graph.simple_undirected(friends).count() == 15
    ids = rows(graph.index_vertices(friends).select("id", "label"))
    assert [l for _, l in ids] == sorted(l for _, l in ids) and [i for i, _ in ids] == list(range(10))
    assert ("DavidF", 4) in rows(graph.degrees(friends))
    assert rows(graph.high_degree(friends, 3)) == [("DavidF", 4), ("Mary", 4)]


def test_shortest_path(friends):
    assert graph.shortest_path(friends, "Judy", "Jon") == ["Judy", "Alan", "Mary", "Peter", "Jon"]
    assert graph.shortest_path(friends, "Judy", "Nobody") == []
    assert graph.shortest_path(friends, "Judy", "Judy") == ["Judy"]


def test_directed_search_with_parents(random_graph):
    pairs, edges = random_graph
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
    want = distances(out, 0)
    got = {r["node"]: (r["parent"], r["distance"]) for r in graph.bfs(edges, 0).collect()}
    assert {n: d for n, (_, d) in got.items()} == want
    for n, (p, d) in got.items():
        if d:
            assert p == min(u for u in want if n in out.get(u, ()) and want[u] == d - 1)


def test_distance_histogram(spark, random_graph, friends):
    pairs, edges = random_graph
    near = neighbours(pairs)
    want = {}
    for s in near:
        for d in distances(near, s).values():
            want[d] = want.get(d, 0) + 1
    want.pop(0)
    assert {r["distance"]: r["n"] for r in graph.distance_histogram(edges).collect()} == want
    some = spark.createDataFrame([(0,), (500,), (12345,)], "id bigint")
    part = {r["distance"]: r["n"] for r in graph.distance_histogram(edges, some).collect()}
    assert sum(part.values()) == len(distances(near, 0)) - 1 + 2
    assert {r["distance"]: r["n"] for r in graph.distance_histogram(friends).collect()}[1] == 30


def test_paths_of_all_targets(spark, random_graph):
    _, edges = random_graph
    have = set(rows(edges))
    found = graph.path_table(graph.cut_lineage(graph.bfs(edges, 0))).collect()
    tree = {r["node"]: r["parent"] for r in graph.bfs(edges, 0).collect()}
    assert {r["node"] for r in found} == set(tree)
    for r in found:
        path = r["path"]
        assert path[0] == 0 and path[-1] == r["node"] and len(path) == r["distance"] + 1
        assert all(tree[b] == a and (a, b) in have for a, b in zip(path, path[1:]))

    parents = spark.range(201).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.col("id").cast("int").alias("distance"))

    assert all(r["path"] == list(range(r["node"] + 1)) for r in graph.path_table(parents).collect())


def test_distance_sketch_is_within_its_error(spark, random_graph, friends):
    for edges in (random_graph[1], friends):
        exact = {r["distance"]: r["n"] for r in graph.distance_histogram(edges).collect()}
        got = {r["distance"]: r for r in graph.distance_sketch(edges).collect()}
        pairs = sum(exact.values())
        for d, r in got.items():
            within = sum(n for k, n in exact.items() if k <= d)
            assert abs(r["within"] - within) <= 5 * r["error"] * (within + pairs / len(exact))
        assert set(got) <= set(exact)
    empty = spark.createDataFrame([], "src bigint, dst bigint")
    assert graph.distance_sketch(empty).count() == 0


def test_distance_sketch_by_registers(spark, monkeypatch):
    """Many edges: registers go between blocks in parts, a row for each block and part, and give what exact counts give."""
    rng = random.Random(9)
    pairs = [(0, i) for i in range(1, 40)] + [(rng.randint(1, 300), rng.randint(1, 300)) for _ in range(500)] + [(500, 501), (501, 502), (502, 500)]
    near, exact = neighbours(pairs), {}
    for v in near:
        for d in distances(near, v).values():
            exact[d] = exact.get(d, 0) + 1
    exact.pop(0)
    monkeypatch.setattr(graph, "FEW_WAYS", 10)
    monkeypatch.setattr(graph, "_sketch_rounds", None)
    monkeypatch.setattr(graph, "REGISTER_BYTES", 1 << 14)
    monkeypatch.setattr(graph, "lay_tiles", lambda edges, tile: edge_tiles.lay_tiles(edges, block=150, tile=400))
    got = {r["distance"]: r for r in graph.distance_sketch(spark.createDataFrame(pairs, "src bigint, dst bigint")).collect()}
    assert set(got) <= set(exact) and min(got) == 1
    for d, r in got.items():
        within = sum(n for k, n in exact.items() if k <= d)
        assert r["n"] > 0 and abs(r["within"] - within) <= 5 * r["error"] * (within + len(near))


def test_largest_over_edges(monkeypatch):
    """Hubs and others; a vertex that nothing leads to, and rows of zeros that are not sent."""
    monkeypatch.setattr(edge_tiles, "AT_ONCE", 64)
    rng = np.random.default_rng(2)
    values = rng.integers(0, 9, (50, 8)).astype(np.uint8) * (np.arange(50) % 3 > 0)[:, None].astype(np.uint8)
    dst = np.sort(np.concatenate([np.full(700, 7), rng.integers(0, 40, 300)])).astype("<i4")
    src = rng.integers(0, 50, len(dst)).astype("<i4")
    want = np.zeros((50, 8), np.uint8)
    np.maximum.at(want, dst, values[src])
    assert (edge_tiles.largest(src, dst, 50, values) == want).all()
    assert not edge_tiles.largest(src[:0], dst[:0], 50, values).any()


def test_cardinality_of_registers():
    rng = np.random.default_rng(3)
    for n in (0, 1, 20, 3000, 200_000):
        hashed = rng.integers(0, 1 << 52, n)
        registers = np.zeros((1, 4096), np.uint8)
        np.maximum.at(registers[0], rng.integers(0, 4096, n), (np.log2((hashed & -hashed) + (hashed == 0)) + 1).astype(np.uint8))
        terms, zeros = edge_tiles.register_terms(registers)
        assert edge_tiles.cardinality(terms, zeros, 4096) == pytest.approx(n, rel=0.08, abs=0.5)


def test_components(random_graph):
    pairs, edges = random_graph
    near = neighbours(pairs)
    want = {(v, min(distances(near, v))) for v in near}
    assert set(rows(graph.connected_components(edges))) == want
    kept = {v for r in graph.largest_component(edges).collect() for v in r}
    assert kept == set(distances(near, 0))


def power_ranks(pairs, rounds=400):
    ids = sorted({v for p in pairs for v in p})
    out = {v: {b for a, b in pairs if a == v} for v in ids}
    rank = dict.fromkeys(ids, 1 / len(ids))
    for _ in range(rounds):
        lost = sum(rank[v] for v in ids if not out[v])
        rank = {v: 0.15 / len(ids) + 0.85 * (lost / len(ids) + sum(rank[u] / len(out[u]) for u in ids if v in out[u])) for v in ids}
    return rank


def test_pagerank_sums_to_one_with_dead_ends(spark, friends):
    ranks = {r["id"]: r["rank"] for r in graph.pagerank(graph.both_ways(friends), tolerance=1e-4).collect()}
    assert sum(ranks.values()) == pytest.approx(1.0, abs=1e-3) and max(ranks, key=ranks.get) in ("DavidF", "Mary")
    line = spark.createDataFrame([(1, 2), (2, 3)], "src bigint, dst bigint")
    dead = {r["id"]: r["rank"] for r in graph.pagerank(line, tolerance=1e-3).collect()}
    assert sum(dead.values()) == pytest.approx(1.0, abs=1e-2) and dead[3] > dead[2] > dead[1]
    two = spark.createDataFrame([(1, 2), (2, 1), (3, 4), (4, 5), (5, 3), (5, 5), (6, 1)], "src bigint, dst bigint")
    for df in (two,):
        got = {r["id"]: r["rank"] for r in graph.pagerank(df, tolerance=1e-2).collect()}
        assert sum(abs(got[v] - x) for v, x in power_ranks(rows(df)).items()) <= 1e-2 / 0.15
    loose = {r["id"]: r["rank"] for r in graph.pagerank(two, tolerance=1e-3).collect()}
    assert sum(abs(loose[v] - x) for v, x in power_ranks(rows(two)).items()) <= 1e-3 / 0.15
    assert graph.pagerank(line.where("false")).count() == 0


def test_betweenness(random_graph, friends):
    for pairs, edges in ((rows(friends), friends), random_graph):
        want = brute_betweenness(neighbours(pairs))
        vertex, edge = graph.betweenness(edges, block=4 if edges is friends else None)
        got = {r["id"]: r["score"] for r in vertex.collect()}
        assert got == pytest.approx(want)
        if edges is friends:
            for asked in (10.0, 0.0):  # one block is enough, all sources are needed
                sampled = graph.betweenness_sampled(edges, error=asked, block=5).collect()
                assert all(abs(r["score"] - want[r["id"]]) <= r["error"] + 1e-9 for r in sampled)
                assert (max(r["n_sources"] for r in sampled) < len(want)) == (asked > 0)
        assert edge.count() == graph.simple_undirected(edges).count()


def test_betweenness_on_one_tile_and_by_joins(friends, monkeypatch):
    """A graph of one tile is searched without a join for each round, and gives what the joins give, look for look."""

    def found():
        vertex, edge = graph.betweenness(friends, block=5)
        sampled = [{r["id"]: (r["score"], r["error"], r["n_sources"]) for r in graph.betweenness_sampled(friends, error=e, block=3).collect()} for e in (20.0, 0.0)]
        return {r["id"]: r["score"] for r in vertex.collect()}, {(r["a"], r["b"]): r["score"] for r in edge.collect()}, *sampled

    monkeypatch.setattr(brandes, "CHUNK", 4)  # sums in several chunks
    with monkeypatch.context() as patched:
        patched.setattr(graph, "_dependencies", None)
        tile = found()
    monkeypatch.setattr(graph, "lay_tiles", lambda edges: edge_tiles.lay_tiles(edges, block=4))
    joins = found()
    assert len(tile[0]) == 10 and len(tile[1]) == 15
    for a, b in zip(tile, joins):
        assert a.keys() == b.keys() and all(x == pytest.approx(b[k]) for k, x in a.items())


def test_betweenness_over_several_blocks_without_joins(spark, monkeypatch):
    """Edges of many tiles that fit a task: the same as by joins, and the same look is the first that is close enough."""
    rng = random.Random(4)
    pairs = [(0, i) for i in range(1, 25)] + [(rng.randint(1, 50), rng.randint(1, 50)) for _ in range(60)] + [(100, 101)]
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")

    def found():
        vertex, edge = graph.betweenness(edges, block=30)
        sampled = [{r["id"]: (r["score"], r["error"], r["n_sources"]) for r in graph.betweenness_sampled(edges, error=e, block=5).collect()} for e in (1.2, 0.9)]
        return {r["id"]: r["score"] for r in vertex.collect()}, {(r["a"], r["b"]): r["score"] for r in edge.collect()}, *sampled

    monkeypatch.setattr(graph, "lay_tiles", lambda edges: edge_tiles.lay_tiles(edges, block=20, tile=30))
    monkeypatch.setattr(graph, "APART_BYTES", 1)  # one look at a time
    monkeypatch.setattr(graph, "LOOKS", 4)
    with monkeypatch.context() as patched:
        patched.setattr(graph, "_dependencies", None)
        whole = found()
    monkeypatch.setattr(lanes, "WAYS", 10)
    joins = found()
    used = [max(x[2] for x in some.values()) for some in whole[2:]]
    assert 5 < used[0] < used[1] < len(whole[0])
    for a, b in zip(whole, joins):
        assert a.keys() == b.keys() and all(x == pytest.approx(b[k]) for k, x in a.items())


def test_dependencies_of_long_and_parted_graphs():
    """More levels than a byte counts, a part that the source does not reach, and a hub."""
    pairs = [(i, i + 1) for i in range(300)] + [(0, i) for i in range(301, 340)] + [(400, 401)]
    ways = sorted({(b, a) for p in pairs for a, b in (p, p[::-1])})
    dst, src = (np.array(x, "<i4").tobytes() for x in zip(*ways))
    near, edges = brandes.Neighbours(src, dst, 402), np.zeros(len(ways))
    found = near.dependencies(150, edges)
    assert found[149] == 149 + 39 and found[0] == 39 and found[299] == 1 and found[150] == found[400] == 0
    assert edges.sum() == sum(distances(neighbours(pairs), 150).values())


def test_filter_and_influencers(friends):
    ranks = graph.pagerank(graph.both_ways(friends))
    assert graph.filter_vertices(friends, ranks.where("rank < 0.09")).count() < friends.count()
    found = rows(graph.influencers(friends, 0.12, 0.05))
    assert found and "DavidF" not in {r[0] for r in found}


@pytest.fixture
def small_tiles(monkeypatch):
    """Several blocks of vertices and parts of sources on small graphs."""
    monkeypatch.setattr(graph, "lay_tiles", lambda edges: edge_tiles.lay_tiles(edges, block=30, tile=40))
    monkeypatch.setattr(graph, "WORDS", 1)


def test_ranks_over_tiles(spark, small_tiles):
    rng = random.Random(5)
    pairs = [("hub", f"v{i}") for i in range(40)] + [(f"v{rng.randint(0, 39)}", f"v{rng.randint(0, 39)}") for _ in range(60)]
    edges = spark.createDataFrame(pairs + [("v1", None)], "src string, dst string")
    both = rows(graph.both_ways(edges))
    with graph.lay_tiles(graph.both_ways(edges)) as laid:
        assert laid.blocks > 1
        degrees = graph._degrees(laid)
        got = {r["id"]: r["rank"] for r in graph._settle(laid, degrees, 0.85, 1e-6).collect()}
        some = degrees.where("id <> 'hub'").join(graph.degrees(edges.where("src <> 'hub'")), "id").select("id", F.col("degree").alias("out"))
        inner = {r["id"]: r["rank"] for r in graph._settle(laid, some, 0.85, 1e-6).collect()}
        # a round moves rows of blocks, however many edges there are
        states = laid.sizes.select("block", F.lit(0).alias("part"), F.lit(b"x").alias("state"), F.lit(b"y").alias("message"))
        moved = laid.carry(states, lambda src, dst, size, message: message, lambda state, parts: (state, None, len(list(parts))), "n bigint").collect()
        assert len(moved) == laid.blocks and all(r["n"] <= laid.blocks for r in moved)
    want = power_ranks(both, 100)
    assert set(got) == set(want) and sum(abs(got[v] - x) for v, x in want.items()) <= 1e-6 / 0.15
    want = power_ranks([p for p in both if "hub" not in p], 100)
    assert set(inner) == set(want) and sum(abs(inner[v] - x) for v, x in want.items()) <= 1e-6 / 0.15


def test_distances_over_tiles(spark, small_tiles):
    rng = random.Random(6)
    pairs = [(0, i) for i in range(1, 60)] + [(rng.randint(50, 130), rng.randint(50, 130)) for _ in range(120)] + [(500, 501)]
    want = {}
    near = neighbours(pairs)
    for s in near:
        for d in distances(near, s).values():
            want[d] = want.get(d, 0) + 1
    want.pop(0)
    got = graph.distance_histogram(spark.createDataFrame(pairs, "src bigint, dst bigint"))
    assert {r["distance"]: r["n"] for r in got.collect()} == want
    assert graph.distance_histogram(spark.createDataFrame([(1, 1)], "src bigint, dst bigint")).count() == 0


@pytest.mark.parametrize("whole", [True, False])
def test_distances_without_and_with_rounds_of_tiles(spark, small_tiles, monkeypatch, whole):
    """Edges that fit a task are searched by lanes without a round of all states; more go through tiles a few parts at a time."""
    rng = random.Random(8)
    pairs = [(0, i) for i in range(1, 70)] + [(rng.randint(50, 160), rng.randint(50, 160)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(12)]
    near, want = neighbours(pairs), {}
    for s in near:
        for d in distances(near, s).values():
            want[d] = want.get(d, 0) + 1
    want.pop(0)
    waves, plain = [], graph._distances
    if whole:
        monkeypatch.setattr(edge_tiles.EdgeTiles, "carry", None)
    else:
        monkeypatch.setattr(lanes, "WAYS", 10)
        monkeypatch.setattr(graph, "WAVE_BYTES", 1)
        monkeypatch.setattr(graph, "_distances", lambda *a: waves.append(1) or plain(*a))
    got = graph.distance_histogram(spark.createDataFrame(pairs, "src bigint, dst bigint"))
    assert {r["distance"]: r["n"] for r in got.collect()} == want
    assert len(waves) == (0 if whole else -(-len(near) // 64))


def test_distance_sketch_by_lanes(spark, monkeypatch):
    """Edges that fit a task: lanes follow parts of the registers to the end, and give what rounds between blocks give."""
    rng = random.Random(12)
    pairs = [(0, i) for i in range(1, 40)] + [(rng.randint(1, 300), rng.randint(1, 300)) for _ in range(500)] + [(500 + i, 501 + i) for i in range(9)]
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    for name, value in (("FEW_WAYS", 10), ("_sketch_rounds", None), ("lay_tiles", lambda edges, tile: edge_tiles.lay_tiles(edges, block=150, tile=400))):
        monkeypatch.setattr(graph, name, value)
    monkeypatch.setattr(lanes, "CHUNK", 100)
    monkeypatch.setattr(lanes, "STATE_BYTES", 1 << 15)
    with monkeypatch.context() as patched:
        patched.setattr(edge_tiles.EdgeTiles, "carry", None)
        whole = graph.distance_sketch(edges).collect()
    monkeypatch.setattr(lanes, "WAYS", 10)
    assert len(whole) > 5 and whole == graph.distance_sketch(edges).collect()


def in_two_blocks(pairs, n):
    """``lanes.Packed`` of a graph of vertices 0 to n - 1 from four tiles."""
    near, half, tiles = neighbours(pairs), n // 3, {}
    for i, (a, b) in enumerate(((0, half), (half, n))):
        for j, (c, d) in enumerate(((0, half), (half, n))):
            own = [sorted(u - a for u in near.get(v, ()) if a <= u < b) for v in range(c, d)]
            tiles[i, j] = np.array(sum(own, []), "<i4").tobytes(), np.array([len(x) for x in own], "<i4").tobytes()
    return lanes.Packed(tiles)


@pytest.mark.parametrize("few", [0, 1, 1 << 40])
def test_rounds_over_a_whole_graph(monkeypatch, few):
    """Hubs, parts that don't meet and vertices without edges, by following what changed and by looking at all."""
    for name, value in (("ROWS", 8), ("HUB", 20), ("FEW", few)):
        monkeypatch.setattr(lanes, name, value)
    rng = random.Random(3)
    pairs = [(0, i) for i in range(1, 60)] + [(7, i) for i in range(20, 50)] + [(rng.randint(40, 99), rng.randint(40, 99)) for _ in range(60)]
    pairs += [(100 + i, 101 + i) for i in range(15)]
    near = neighbours(pairs)
    laid = lanes.Rounds(in_two_blocks(pairs, 120))
    assert laid.hubs == 2
    state = np.zeros((120, 2), np.uint64)
    bit = np.arange(120)
    state[laid.row, bit // 64] = np.left_shift(np.uint64(1), (bit % 64).astype(np.uint64))
    told = []
    found = [sum(told) for _ in laid.run(state, np.arange(120), np.bitwise_or, lambda rows, old, new: told.append(int(np.bitwise_count(old ^ new).sum())))]
    far = [d for s in near for d in distances(near, s).values() if d]
    assert found == [sum(d <= k for d in far) for k in range(1, max(far) + 1)]
    values = np.arange(120, dtype=np.uint8)[:, None][laid.order].repeat(4, axis=1)
    last = values.copy()

    def keep(rows, old, new):
        assert (last[rows] == old).all() and (new != old).any(axis=1).all()
        last[rows] = new

    for _ in laid.run(values, np.arange(120), np.maximum, keep):
        pass
    assert all((last[laid.row[v]] == max(distances(near, v))).all() for v in near)
