import colorsys
import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tidemark.functions import colour
from tidemark.functions.geometry import box_iou
from tidemark.operators import causal, explain, features, metrics, models, pages, skew, trees
from tidemark.plans import learning, standins as si
from tidemark.sources import writers

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

# A worked example of encoding and scaling five connections.
CONNECTIONS = [(0, "http", "udt", 4.0), (1, "http", "udf", 5.0), (2, "http", "tcp", 5.0), (3, "ftp", "icmp", 1.0), (4, "http", "tcp", 4.0)]
SCALED = [0.12171612389003701, 0.7302967433402214, 0.7302967433402214, -1.704025734460517, 0.12171612389003701]


def test_one_hot_and_standardise(spark):
    df = spark.createDataFrame(CONNECTIONS, "id int, service string, proto string, n double")
    hot = features.one_hot(df, ["service", "proto"], "id").orderBy("id").collect()
    assert tuple(hot[0]) == (0, 1, 0, 1, 0, 0, 0, 4.0)
    assert tuple(hot[3]) == (3, 0, 1, 0, 0, 0, 1, 1.0)
    scaled = [r["n"] for r in features.standardise(df, ["n"]).orderBy("id").collect()]
    assert scaled == pytest.approx(SCALED)


def test_cluster_score(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (3, 1), (4, 0)], "id int, c int")
    assert [r["id"] for r in features.cluster_size_score(df, "c").where("score >= 0.9").collect()] == [3]
    even = features.cluster_size_score(df.where("id > 2"), "c").collect()
    assert [r["score"] for r in even] == [None, None]


def test_detect_on_the_worked_example(spark):
    df = spark.createDataFrame(CONNECTIONS, "id int, service string, proto string, n double")
    assert [r["id"] for r in models.detect(df, ["service", "proto"], ["n"], "id", k=2, threshold=0.9).collect()] == [3]


def test_sparse_features_hold_the_same_flags(spark):
    """The wide encoding and the vectors agree, a null category sets no flag, copies and hot values included."""
    data = [(i, None if i % 7 == 0 else f"s{i % 3}", None if i % 2 else "p" * (i % 5), float(i)) for i in range(40)]
    df = spark.createDataFrame(data, "id int, service string, proto string, n double")
    wide = {r["id"]: [float(v) for v in r[1:]] for r in features.one_hot(df, ["service", "proto"], "id").collect()}
    for bound in (100_000, 0):  # broadcast, and joined by salts
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(features, "broadcast_if_small", lambda x, b=bound: skew.broadcast_if_small(x, b))
            got = {r["id"]: list(r["features"].toArray()) for r in features.sparse_features(df, ["service", "proto"], ["n"], "id").collect()}
        assert got == wide


def test_fifty_thousand_categories(spark):
    """No bound on categories: three odd rows among many are found, every category has its own flag."""
    df = spark.range(60_000).select(
        "id", F.when(F.col("id") < 50_000, F.concat(F.lit("c"), F.col("id").cast("string"))).otherwise("hot").alias("c"),
        F.when(F.col("id") % 20_000 == 7, 1000.0).otherwise(F.col("id") % 10).alias("n"),
    )
    vectors = features.sparse_features(df, ["c"], ["n"], "id").where("id in (0, 49999, 55555)").collect()
    assert {r["id"]: (r["features"].size, int(r["features"].indices[0])) for r in vectors} == {0: (50_002, 0), 49_999: (50_002, 49_999), 55_555: (50_002, 50_000)}
    found = {r["id"] for r in models.detect(df, ["c"], ["n"], "id", k=8, threshold=0.97).collect()}
    assert {7, 20_007, 40_007} <= found and len(found) < 20


def test_otsu_splits_two_heaps(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 4 == 0, F.col("id") % 10 + 100).otherwise(F.col("id") % 10).alias("v"))
    row = features.otsu_threshold(df, "v").first()
    assert 9 < row["threshold"] < 100 and row["n_above"] == 250


def test_synthesise_depth_two(spark):
    users = spark.createDataFrame([(1,), (2,)], "u int")
    orders = spark.createDataFrame([(10, 1, "a"), (11, 1, "b"), (12, 1, "b")], "o int, u int, kind string")
    lines = spark.createDataFrame([(10, 2.0), (10, 4.0), (11, 3.0)], "o int, q double")
    es = features.EntitySet({"users": users, "orders": orders, "lines": lines}, {"users": "u", "orders": "o"}, [("users", "orders", "u"), ("orders", "lines", "o")])
    got = {r["u"]: r for r in features.synthesise(es, "users").collect()}
    assert got[1]["count_orders"] == 3 and got[1]["mode_orders_kind"] == "b" and got[1]["n_unique_orders_kind"] == 2
    assert got[1]["sum_orders_sum_lines_q"] == 9.0 and got[1]["median_orders_sum_lines_q"] == 4.5
    assert got[2]["count_orders"] is None


@QUICK
@given(st.lists(st.tuples(*[st.integers(0, 255)] * 3), min_size=1, max_size=20))
def test_colours(spark, triples):
    df = spark.createDataFrame(triples, "R int, G int, B int").withColumn("id", F.monotonically_increasing_id())
    for r in colour.rgb_to_hsv(df).collect():
        want = colorsys.rgb_to_hsv(r["R"] / 255, r["G"] / 255, r["B"] / 255)
        assert (r["S"], r["V"]) == pytest.approx(want[1:])
        assert min(abs(r["H"] - want[0]), 1 - abs(r["H"] - want[0])) < 1e-9
    lab = colour.rgb_to_lab(df)
    for r in lab.collect():
        assert -1e-6 <= r["labL"] <= 100.001 and abs(r["labA"]) < 129 and abs(r["labB"]) < 129
    back = colour.lab_to_rgb(lab.select(F.col("R").alias("r0"), F.col("G").alias("g0"), F.col("B").alias("b0"), "labL", "labA", "labB"), keep=("r0", "g0", "b0"))
    for r in back.collect():
        assert (r["R"], r["G"], r["B"]) == pytest.approx((r["r0"], r["g0"], r["b0"]), abs=0.1)


def test_known_lab_values(spark):
    df = spark.createDataFrame([(255, 255, 255), (255, 0, 0), (0, 0, 0)], "R int, G int, B int")
    got = [(round(r["labL"], 1), round(r["labA"], 1), round(r["labB"], 1)) for r in colour.rgb_to_lab(df).orderBy("G", "R").collect()]
    assert got == [(0.0, 0.0, 0.0), (53.2, 80.1, 67.2), (100.0, -0.0, 0.0)]


def test_boxes(spark):
    names = ["x", "y", "w", "h"]
    data = [((0, 0, 2, 2), (5, 5, 1, 1), 0.0), ((1, 1, 3, 3), (1, 1, 3, 3), 1.0), ((0, 0, 2, 2), (1, 1, 2, 2), 1 / 7)]
    for p, t, want in data:
        for a, b in ((p, t), (t, p)):
            df = spark.createDataFrame([tuple(map(float, a + b))], ", ".join(f"{s}_{n} double" for s in "pt" for n in names))
            assert df.select(box_iou().alias("v")).first()["v"] == pytest.approx(want)


def test_page_parts(spark):
    html = ('<html><head><title> A &amp; B\n</title><script>var x="<a href=\\"/no\\">";</script></head><body><!-- <a href="/no2"> -->'
            '<h1>Head</h1><a class=x HREF = "/in">i</a><a href="http://o/p">o</a><table><tr><th>k</th><td>1987</td></tr></table></body></html>')
    df = spark.createDataFrame([(1, "http://h.example/p?q=1", html)], "page_id bigint, url string, html string")
    row = pages.page_fields(df).first()
    assert (row["title"], row["heading"], row["n_links"], row["text"]) == ("A & B", "Head", 2, "Head i o k 1987")
    assert rows(pages.page_links(df).select("url")) == [("http://h.example/in",), ("http://o/p",)]
    assert rows(pages.table_rows(df)) == [(1, 0, 0, "k"), (1, 0, 1, "1987")]
    assert tuple(pages.earliest_year(df, 2019).first()) == (1, 1987, 32)


# -- effects -----------------------------------------------------------------------------------------


def brute_nearest(people, dims, radius, strict):
    total, gains = 0, []
    for c in (p for p in people if p[1] == 0):
        total += 1
        best = None
        for t in (p for p in people if p[1] == 1):
            d = sum((c[3 + i] - t[3 + i]) ** 2 for i in range(dims)) ** 0.5
            if (d < radius if strict else d <= radius) and (best is None or (d, t[0]) < best[:2]):
                best = (d, t[0], t[2])
        if best:
            gains.append(best[2] - c[2])
    return len(gains), 100 * len(gains) / total, sum(gains) / len(gains)


@pytest.mark.parametrize("dims,radius,strict", [(1, 0.5, False), (3, 30.0, True), (2, 5.0, True)])
def test_nearest_match_equals_brute_force(spark, dims, radius, strict):
    rng = random.Random(dims)
    people = []
    for i in range(260):
        spot = (3.0, 3.0, 3.0) if i % 3 == 0 else tuple(rng.gauss(0, 40) if i % 3 == 1 else rng.gauss(100, 2) for _ in range(3))
        people.append((i, int(rng.random() < 0.3), float(rng.randint(0, 100)), *spot))
    df = spark.createDataFrame(people, "id int, treat int, outcome double, a double, b double, c double")
    row = causal.nearest_match_effect(df, "treat", "outcome", ["a", "b", "c"][:dims], "id", radius, strict).first()
    assert tuple(row) == pytest.approx(brute_nearest(people, dims, radius, strict))


def test_nearest_match_where_the_widest_columns_are_shared(spark):
    """Most points agree in the three widest of five columns; leaves stay small and nothing is missed."""
    rng = random.Random(9)
    people = []
    for i in range(700):
        far = (0.0, 500.0, -500.0) if i % 10 else tuple(rng.uniform(-4000, 4000) for _ in range(3))
        people.append((i, i % 2, float(rng.randint(0, 100)), *far, float(rng.randint(0, 30)), rng.gauss(0, 3)))
    df = spark.createDataFrame(people, "id int, treat int, outcome double, a double, b double, c double, d double, e double")
    for radius in (1.5, 300.0):
        row = causal.nearest_match_effect(df, "treat", "outcome", list("abcde"), "id", radius).first()
        assert tuple(row) == pytest.approx(brute_nearest(people, 5, radius, True))
    treated = df.where("treat = 1").select(F.struct("id").alias("m"), *"abcde")
    levels, leaves = causal._partition(treated, list("abcde"))
    sizes = [r["n"] for r in leaves.groupBy("_node").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 350 and max(sizes) <= causal.LEAF and len(levels) > 1


def test_nearest_match_of_odd_rows(spark):
    people = [(1, 0, 1.0, 0.0, 0.0), (2, 1, 5.0, 0.0, 3.0), (3, 0, 2.0, None, 0.0), (4, 1, 9.0, float("inf"), 0.0), (5, 0, 3.0, float("nan"), 3.0)]
    df = spark.createDataFrame(people, "id int, treat int, outcome double, a double, b double")
    assert tuple(causal.nearest_match_effect(df, "treat", "outcome", ["a", "b"], "id", 10.0).first()) == (1, pytest.approx(100 / 3), 4.0)
    assert causal.nearest_match_effect(df.where("treat = 0"), "treat", "outcome", ["a", "b"], "id", 10.0).first()["n_matched"] == 0


def test_effect_models_recover_a_known_effect(spark):
    df = spark.range(800).select(
        "id", (F.hash("id") % 2 == 0).cast("int").alias("treat"), (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z")
    ).withColumn("y", F.col("treat") * 3.0 + F.col("x") * 2.0 - F.col("z"))
    assert causal.two_model_effect(df, "treat", "y", ["x", "z"]).first()["effect"] == pytest.approx(3.0, abs=1e-3)
    assert causal.adjusted_effect(df, "treat", "y", ["x", "z"]).first()["effect"] == pytest.approx(3.0, abs=1e-3)
    scores = causal.propensity_scores(df, "treat", ["x", "z"])
    assert scores.where("score < 0 or score > 1").count() == 0
    assert causal.exact_match_effect(df, "treat", "y", ["x", "z"], "id").first()["effect"] == pytest.approx(3.0)


# -- models and metrics ----------------------------------------------------------------------------------


def test_metrics_match_mllib(tables):
    df = si.predictions(tables).persist()
    got = {r["metric"]: r["value"] for r in metrics.regression_metrics(df, "label", "prediction").collect()}
    for name in ("r2", "rmse", "mse"):
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))
    classes = df.select(F.col("class_label").cast("double").alias("label"), F.col("class_prediction").cast("double").alias("prediction"))
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(classes)
    assert metrics.weighted_f1(classes, "label", "prediction").first()["value"] == pytest.approx(want)
    sure = df.sparkSession.createDataFrame([(1, 0.0), (0, 0.0)], "y int, p double")
    assert metrics.log_loss(sure, "y", "p").first()["value"] == pytest.approx(-np.log(1e-15) / 2)


def test_forecast_is_saved_and_scores_two_rows(spark, tables, tmp_path):
    from tidemark.operators.relational import with_previous_day

    pairs = with_previous_day(si.daily_max(tables))
    for yesterday in (True, False):
        model = models.train_forecast(pairs, yesterday)
        writers.save_model(model, str(tmp_path / str(yesterday)))
        again = writers.load_model(str(tmp_path / str(yesterday)))
        two = spark.createDataFrame(
            [("x", dt.date(2018, 11, 12), 49.2, -122.9, 330.0, 12.0, 0.0), ("x", dt.date(2018, 11, 13), 49.2, -122.9, 330.0, 0.0, 12.0)],
            "station string, date date, latitude double, longitude double, elevation double, tmax double, yesterday_tmax double",
        )
        assert [r["prediction"] for r in models.score(again, two).collect()] == [r["prediction"] for r in models.score(model, two).collect()]


@pytest.fixture(scope="module")
def explained(tables):
    data = learning.rows(tables).persist()
    return data, learning.black(data)


def test_shapley_shares_sum_to_the_prediction(explained):
    data, model = explained
    some = data.where("id < 40")
    shares = explain.shapley(model, some, data, learning.NAMES, samples=4)
    sums = shares.groupBy("id").agg((F.sum("share") + F.first("base")).alias("s"))
    both = sums.join(explain.probability(model, some), "id").collect()
    assert len(both) == 40 and all(r["s"] == pytest.approx(r["p"], abs=1e-9) for r in both)
    assert shares.count() == 40 * len(learning.NAMES)


def expected(node, by_place, x, known):
    """What a tree gives on average when only some features of a row are known."""
    if node.feature is None:
        return node.value
    left, right = by_place[node.tree, node.left], by_place[node.tree, node.right]
    if node.feature in known:
        goes = x[node.feature] <= node.threshold if node.categories is None else x[node.feature] in node.categories
        return expected(left if goes else right, by_place, x, known)
    return sum(c.cover / node.cover * expected(c, by_place, x, known) for c in (left, right))


def brute_shares(nodes, x):
    d, by_place = len(x), {(n.tree, n.node): n for n in nodes}
    roots = [n for n in nodes if n.node == 0]
    worth = {s: sum(expected(r, by_place, x, s) for r in roots) for k in range(d + 1) for s in map(frozenset, itertools.combinations(range(d), k))}
    weight = lambda k: math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
    return [sum(weight(len(s)) * (worth[s | {j}] - worth[s]) for s in worth if j not in s) for j in range(d)], worth[frozenset()]


@pytest.mark.parametrize("kind", ["gbt", "forest", "categories"])
def test_tree_shares_equal_the_sum_over_subsets(spark, kind):
    from pyspark.ml.feature import VectorIndexer
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    rng = np.random.default_rng(6)
    data = [(i, float(float(a * b > 0) + 0.2 * c + (d == 2)), [float(a), float(b), float(c), float(d)]) for i, (a, b, c, d) in enumerate(zip(*rng.normal(size=(3, 400)), rng.integers(0, 4, 400)))]
    df = spark.createDataFrame(data, "id long, label double, x array<double>")
    vectors = explain.with_vector(df)
    if kind == "categories":
        vectors = VectorIndexer(inputCol="features", outputCol="f2", maxCategories=4).fit(vectors).transform(vectors).drop("features").withColumnRenamed("f2", "features")
    learner = RandomForestRegressor(numTrees=5, maxDepth=6, seed=1) if kind == "forest" else GBTRegressor(maxIter=5, maxDepth=4, seed=1)
    model = learner.fit(vectors)
    nodes = trees.model_nodes(model)
    assert any(n.categories is not None for n in nodes) == (kind == "categories")
    assert sorted(map(repr, trees.nodes_of_table(trees.node_table(nodes, spark)))) == sorted(map(repr, nodes))
    got = trees.tree_shapley(nodes, df, list("abcd")).collect()
    assert len(got) == 4 * len(data)
    shares = {(r["id"], r["feature"]): (r["share"], r["base"]) for r in got}
    said = {r["id"]: r["prediction"] for r in model.transform(vectors).collect()}
    for i, _, x in data:
        assert sum(shares[i, f][0] for f in "abcd") + shares[i, "a"][1] == pytest.approx(said[i], abs=1e-9)
    for i, _, x in data[:25]:
        want, base = brute_shares(nodes, x)
        assert [shares[i, f][0] for f in "abcd"] == pytest.approx(want, abs=1e-9) and shares[i, "a"][1] == pytest.approx(base)


def test_tree_shares_of_odd_rows(spark):
    nodes = learning.fixed_nodes()
    df = spark.createDataFrame([(1, [float("nan")] * 3), (1, [10.0, 3.0, 0.0]), (None, [1e300, -1e300, 5.0]), (2, None), (3, [1.0])], "id long, x array<double>")
    got = trees.tree_shapley(nodes, df, list("abc")).collect()
    assert len(got) == 9 and trees.tree_shapley(nodes, df.where("false"), list("abc")).count() == 0
    nan = [r["share"] for r in got if r["id"] == 1][:3]
    assert nan == pytest.approx(brute_shares(nodes, [math.nan] * 3)[0])


def test_margin_of_all_columns_is_shared_out(explained):
    data, model = explained
    from pyspark.ml.functions import vector_to_array

    shares = trees.tree_shapley(trees.model_nodes(model), data, learning.NAMES)
    sums = shares.groupBy("id").agg((F.sum("share") + F.first("base")).alias("s"))
    raw = model.transform(explain.with_vector(data)).select("id", vector_to_array("rawPrediction")[1].alias("m"))
    assert all(r["s"] == pytest.approx(r["m"], abs=1e-9) for r in sums.join(raw, "id").collect())


def test_shuffling_a_useless_feature_changes_nothing(spark, explained):
    data, _ = explained
    useless = data.withColumn("x", F.array(F.col("label") + F.col("x")[0] * 0.01, F.lit(1.0)))
    model = learning.black(useless, "logistic")
    got = {r["feature"]: r["importance"] for r in explain.permutation_importance(model, useless, ["good", "flat"]).collect()}
    assert got["flat"] == pytest.approx(0.0, abs=1e-9) and got["good"] > 0.1


def test_partial_dependence_and_surrogates(explained):
    data, model = explained
    dependence = explain.partial_dependence(model, data, learning.NAMES, ["e0", "e3"], 5)
    assert dependence.count() == 10 and dependence.where("mean_p < 0 or mean_p > 1").count() == 0
    table, same = explain.surrogate(model, data, learning.NAMES)
    assert table.count() == len(learning.NAMES) and 0.5 <= same.first()[0] <= 1
    logistic = learning.black(data, "logistic")
    weights = {r["feature"]: r["coefficient"] for r in explain.coefficients(logistic, learning.NAMES, data.sparkSession).collect()}
    local = explain.local_surrogate(logistic, data.where("id = 3"), data, learning.NAMES, n=400)
    assert local.count() == len(learning.NAMES)
    strongest = max(weights, key=lambda n: abs(weights[n]))
    assert weights[strongest] * local.where(F.col("feature") == strongest).first()["weight"] > 0


def test_local_surrogate_of_one_row_equals_that_in_the_table(explained):
    data, _ = explained
    logistic = learning.black(data, "logistic")
    one = explain.local_surrogate(logistic, data.where("id = 3"), data, learning.NAMES, n=200).collect()
    two = explain.local_surrogate(logistic, data.where("id in (3, 4)"), data, learning.NAMES, n=200).where("id = 3").collect()
    assert {r["feature"]: round(r["weight"], 9) for r in one} == {r["feature"]: round(r["weight"], 9) for r in two}


def test_links_in_every_quoting(spark):
    html = "<a href=\"/p\">x</a><a class='b' href='/q'>y</a><A title=\"a>b\" HREF=/r>z</a><a name=t>n</a>"
    df = spark.createDataFrame([(1, "https://h.org/d/e?x=1#f", html)], "page_id long, url string, html string")
    assert rows(pages.page_links(df)) == [(1, "/p", "https://h.org/p"), (1, "/q", "https://h.org/q"), (1, "/r", "https://h.org/r")]
    assert pages.page_fields(df).first()["n_links"] == 3


def brute_match(rows, radius):
    """Controls with the nearest treated score; ties by the smaller id."""
    treated = {}
    for i, t, y, s in sorted(r for r in rows if r[1] == 1):
        treated.setdefault(s, (i, y))
    out = []
    for _, t, y, s in rows:
        if t == 0 and treated:
            d, m = min((abs(x - s), m) for x, m in treated.items())
            if d <= radius:
                out.append(m[1] - y)
    return len(out), (sum(out) / len(out) if out else None)


@pytest.mark.parametrize("radius", [0.004, 1e9])
def test_sorted_match_equals_all_pairs(spark, radius):
    rng = random.Random(8)
    rows = [(i, rng.randint(0, 1), float(rng.randint(0, 50)), rng.choice([0.5, round(rng.random(), 3)])) for i in range(600)]
    rows += [(1000 + i, 0, 1.0, 5.0 + i) for i in range(40)] + [(2000, 1, 9.0, 100.0)]  # a stretch without treated points
    df = spark.createDataFrame(rows, "id long, treat int, outcome double, score double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = causal.propensity_match_effect(df, "treat", "outcome", "score", "id", radius).first()
        n, effect = brute_match(rows, radius)
        assert got["n_matched"] == n and got["effect"] == pytest.approx(effect)
        assert causal.propensity_match_effect(df.where("treat = 0"), "treat", "outcome", "score", "id", radius).first()["n_matched"] == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_fitted_score_match_equals_all_pairs_of_the_written_scores(spark, tables):
    df = si.programme(tables)
    confounders = ["nation", "n_orders"]
    scored = causal.propensity_scores(df, "treat", confounders).select("id", "treat", "outcome", "score").collect()
    n, effect = brute_match([tuple(r) for r in scored], 0.01)
    got = causal.propensity_effect(df, "treat", "outcome", confounders, "id", 0.01).first()
    assert got["n_matched"] == n and got["effect"] == pytest.approx(effect)


def test_one_split_is_trained_and_explained_over_many_tasks(spark, tables, explained, monkeypatch):
    """A small file is one split; the rows worked on are spread from there, and come to the same result."""
    seen = []

    def trained(df, *rest):
        seen.append(df.rdd.getNumPartitions())
        raise StopIteration

    monkeypatch.setattr(learning, "TRAINED_AT_ONCE", 30)
    for name, build in (("train_value_bands", learning.value_band_model), ("train_colours", learning.colour_model)):
        monkeypatch.setattr(learning.models, name, trained)
        with pytest.raises(StopIteration):
            build(tables)
    assert min(seen) >= 3

    data, logistic = explained[0].where("id < 40").coalesce(1), explained[1]
    plain = explain.probability
    monkeypatch.setattr(explain, "probability", lambda model, rows, *a: seen.append(rows.rdd.getNumPartitions()) or plain(model, rows, *a))
    weights = []
    for at_once in (1000, 5):
        monkeypatch.setattr(explain, "EXPLAINED_AT_ONCE", at_once)
        found = explain.local_surrogate(logistic, data, data, learning.NAMES, n=70)
        weights.append({(r["id"], r["feature"]): r["weight"] for r in found.collect()})
    assert seen[-2:] == [1, min(spark.sparkContext.defaultParallelism, data.count() // 5)]
    assert weights[1] == pytest.approx(weights[0], rel=1e-6, abs=1e-9)


def test_categories_are_counted_in_two_shuffles(spark):
    rows = [(1, "a", "x"), (1, "b", "x"), (1, "b", None), (1, "a", "y"), (2, None, "z"), (3, None, None), (None, "q", None)]
    found = features._group_categories(spark.createDataFrame(rows, "k int, c string, d string"), "k", ["c", "d"], "t", ("mode", "n_unique"))
    assert {r["k"]: tuple(r)[1:] for r in found.collect()} == {1: ("a", 2, "x", 2), 2: (None, 0, "z", 1), None: ("q", 1, None, 0)}
    assert found._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") + found._jdf.queryExecution().sparkPlan().toString().count("SortAggregate") <= 4
