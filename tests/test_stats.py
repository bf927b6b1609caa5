import collections
import hashlib
import math
import time

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import draws, profile, ranks, resample, stats

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many equal values, some nulls."""
    rng = np.random.default_rng(4)
    key = np.where(np.arange(3000) % 3 == 0, 0, rng.integers(1, 40, 3000))
    value = rng.integers(0, 200, 3000) / 4.0
    frame = pd.DataFrame({"id": np.arange(3000), "k": key, "v": value, "w": value * 2 + rng.normal(size=3000)})
    frame.loc[::17, "v"] = np.nan
    df = spark.createDataFrame(frame, "id bigint, k bigint, v double, w double")
    return frame, df.withColumn("v", F.nanvl("v", F.lit(None))).persist()


@pytest.mark.parametrize("fits", [1, 3, 150, 10_000])
def test_group_quantiles(skewed, fits):
    """With a small ``fits`` ranges are narrowed, some keys at once and others over rounds."""
    frame, df = skewed
    got = {r["k"]: (r["a"], r["b"]) for r in ranks.exact_quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.9}, fits=fits, fan=4).collect()}
    for k, part in frame.groupby("k")["v"]:
        assert np.allclose(got[k], part.quantile([0.25, 0.9]))


def test_quantiles_of_any_double(spark):
    """Every sign and size, values a bit apart, infinities, zeros, many copies and a weight; narrowed or not the same."""
    base = [0.0, -0.0, 5e-324, -5e-324, 1e-300, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 1.5, 1e308, -1e308, float("inf"), float("-inf")]
    values = [v for i, v in enumerate(base) for _ in range(i % 3 + 1)] + [1.0 + i * 2.0**-50 for i in range(40)] + [7.0] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    probs = {f"p{i}": i / 16 for i in range(17)}
    want = ranks.exact_quantiles(df, [], "v", probs).first().asDict()
    place = {n: p * (len(values) - 1) for n, p in probs.items()}
    ordered = sorted(values)
    for n, at in place.items():
        lo, hi = ordered[math.floor(at)], ordered[math.ceil(at)]
        if lo == hi or math.isfinite(lo) and math.isfinite(hi) and math.isfinite(hi - lo):
            assert want[n] == (lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)))
    for fan in (2, 256):
        assert repr(ranks.exact_quantiles(df, [], "v", probs, fits=1, fan=fan).first().asDict()) == repr(want)
    halves = df.groupBy("v").agg(F.count("*").alias("n"))
    assert repr(ranks.exact_quantiles(halves, [], "v", probs, weight="n", fits=5).first().asDict()) == repr(want)


def test_quantiles_of_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("b", None)], "k string, v double")
    assert rows(ranks.exact_quantiles(df.fillna({"k": "z"}), ["k"], "v", {"m": 0.5})) == [("a", 5.0), ("z", 2.0)]
    assert {r["k"]: r["m"] for r in ranks.exact_quantiles(df, ["k"], "v", {"m": 0.5}, fits=1).collect()} == {None: 2.0, "a": 5.0}
    assert ranks.exact_quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0


def test_a_hot_key_covers_many_ranges(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 4 > 0, F.lit(None)).otherwise(F.col("id") % 3).alias("k"), "id")
    got = ranks.running_totals(df, ["k"], ["id"], "id").toPandas()
    for _, part in got.groupby("k", dropna=False):
        part = part.sort_values("id")
        assert (part["before"] == part["id"].cumsum() - part["id"]).all()
    assert len(got) == 20_000


def test_row_numbers_and_running_totals(skewed):
    _, df = skewed
    numbered = ranks.row_numbers(df.select("id").where("id % 7 <> 3"), "id")
    got = [r["rn"] for r in numbered.orderBy("id").collect()]
    assert got == list(range(len(got)))


def test_text_row_numbers_with_a_common_prefix(spark):
    words = ["", "a", "ab", "é", "z", *(f"https://host.example.org/{i:05d}" for i in range(20_000))]
    df = spark.createDataFrame([(w,) for w in reversed(words)], "w string")
    got = {r["w"]: r["rn"] for r in ranks.text_row_numbers(df, "w").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words, key=str.encode))}


def test_spearman_with_ties(skewed):
    frame, df = skewed
    both = frame.dropna()
    want = np.corrcoef(both["v"].rank(), both["k"].rank())[0, 1]
    assert stats.spearman(df, "v", ["k"]).first()["r"] == pytest.approx(want, abs=1e-9)


@QUICK
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=3, max_size=30))
def test_spearman_small(spark, points):
    got = stats.spearman(spark.createDataFrame(points, "x int, y int"), "x", ["y"]).collect()
    frame = pd.DataFrame(points, columns=["x", "y"]).rank()
    if frame["x"].nunique() == 1 or frame["y"].nunique() == 1:
        assert got[0]["r"] is None
    else:
        assert got[0]["r"] == pytest.approx(np.corrcoef(frame["x"], frame["y"])[0, 1], abs=1e-9)


def test_constant_column_has_no_correlation(spark):
    row = stats.correlate(spark.range(5).withColumn("c", F.lit(1)), "id", "c").first()
    assert row["n"] == 5 and row["r"] is None


def test_corr_matrix_drops_nulls_by_pair(skewed):
    frame, df = skewed
    got = {(r["a"], r["b"]): r["r"] for r in stats.corr_matrix(df, ["k", "v", "w"], 6).collect()}
    want = frame[["k", "v", "w"]].corr()
    assert len(got) == 9
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-6)


def test_chi_squared_counts_empty_cells(spark):
    data = [("a", "x")] * 3 + [("b", "y")] * 5
    row = stats.chi_squared(spark.createDataFrame(data, "a string, b string"), "a", "b").first()
    assert row["chi2"] == pytest.approx(8.0) and row["dof"] == 1


def test_histogram_last_bin_closed(spark):
    got = profile.histogram(spark.range(11), "id", 5).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 2, 2, 2, 3]
    same = profile.histogram(spark.range(4).select(F.lit(2).alias("c")), "c", 3).orderBy("bin").collect()
    assert [r["n"] for r in same] == [4, 0, 0]


def test_describe_matches_pandas(skewed):
    frame, df = skewed
    got = {r["column"]: r for r in profile.describe(df, ["v", "w"]).collect()}
    want = frame[["v", "w"]].describe()
    for c in ("v", "w"):
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][mine] == pytest.approx(want.loc[theirs, c])


def uniform(*parts):
    digest = hashlib.md5("-".join(map(str, parts)).encode()).hexdigest()
    return (int(digest[:15], 16) >> 8) / 2**52


def gamma_by_hand(shape, seed, part, rep):
    d = shape - 1 / 3
    c = 1 / math.sqrt(9 * d)
    for j in range(draws.GAMMA_TRIES):
        u1, u2, u3 = (uniform(seed, part + str(k), rep, j) for k in (1, 2, 3))
        x = math.sqrt(-2 * math.log(1 - u1)) * math.cos(2 * math.pi * u2)
        v = (1 + c * x) ** 3
        if v > 0 and math.log(1 - u3) < x * x / 2 + d - d * v + d * math.log(v):
            return d * v


@pytest.mark.parametrize("n,prob", [(301, 0.5), (300, 0.5), (40, 0.9), (7, 1.0), (1, 0.5)])
def test_bootstrap_against_plain_python(spark, n, prob):
    values = np.round(np.random.default_rng(n).exponential(size=n), 1)  # many ties
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = resample.bootstrap_ci(df, "v", reps=200, seed=9, prob=prob).first()
    ordered, at = np.sort(values), (n - 1) * prob
    lo, hi = int(at), min(int(at) + 1, n - 1)
    stats = []
    for rep in range(200):
        a, b = gamma_by_hand(lo + 1, 9, "a", rep), gamma_by_hand(n - lo, 9, "b", rep)
        u = a / (a + b)
        w = 1 - (1 - u) * (1 - uniform(9, "next", rep)) ** (1 / (n - lo - 1)) if hi > lo else u
        low, high = (ordered[min(n - 1, math.floor(x * n))] for x in (u, w))
        stats.append(low + (high - low) * (at - lo))
    diffs = np.array(stats) - np.quantile(values, prob)
    assert got["stat"] == pytest.approx(np.quantile(values, prob))
    assert got["lo"] == pytest.approx(got["stat"] - np.quantile(diffs, 0.975))
    assert got["hi"] == pytest.approx(got["stat"] - np.quantile(diffs, 0.025))


def test_order_statistics_follow_real_resampling(spark):
    n, reps = 60, 6000
    got = draws.order_statistics(spark.range(reps).withColumnRenamed("id", "rep"), "rep", n, 29, 30, 3).toPandas()
    real = np.sort(np.random.default_rng(1).integers(0, n, (reps, n)), axis=1)
    for name, rank in (("lo", 29), ("hi", 30)):
        assert abs(got[name].mean() - real[:, rank].mean()) < 5 * real[:, rank].std() / math.sqrt(reps / 2)
        assert abs(got[name].std() / real[:, rank].std() - 1) < 0.05
    assert (got["lo"] <= got["hi"]).all() and abs((got["hi"] - got["lo"]).mean() - (real[:, 30] - real[:, 29]).mean()) < 0.1


@pytest.mark.parametrize("total,left,drawn", [(10, 4, 5), (1000, 10, 500), (1000, 500, 3), (200, 190, 150), (5, 5, 3), (50, 1, 1), (7, 3, 0)])
def test_hypergeometric_follows_its_law(spark, total, left, drawn):
    reps = 5000
    df = spark.range(reps).select("id", F.lit(total).alias("n"), F.lit(left).alias("k"), F.lit(drawn).alias("c"))
    got = collections.Counter(r["x"] for r in draws.hypergeometric(df, "n", "k", "c", "x", 4, "id").collect())
    law = {x: math.comb(left, x) * math.comb(total - left, drawn - x) / math.comb(total, drawn) for x in range(max(0, drawn - total + left), min(left, drawn) + 1)}
    assert set(got) <= set(law) and sum(got.values()) == reps
    chi, cells, rest_p, rest_n = 0.0, 0, 0.0, 0
    for x, p in law.items():
        if p * reps >= 5:
            chi, cells = chi + (got[x] - p * reps) ** 2 / (p * reps), cells + 1
        else:
            rest_p, rest_n = rest_p + p, rest_n + got[x]
    assert chi <= cells + 5 * math.sqrt(2 * cells) and rest_n <= rest_p * reps + 5 * math.sqrt(rest_p * reps) + 3


def test_chosen_sums_follow_real_shuffles(spark):
    values = np.repeat([0.0, 1.0, 2.0, 5.0, 9.0], [40, 30, 20, 5, 5])
    df = spark.createDataFrame([(float(v), int(c)) for v, c in zip(*np.unique(values, return_counts=True))], "v double, n long")
    got = np.array([r["s"] for r in resample.chosen_sums(df, "v", 30, 4000, 2).collect()])
    rng = np.random.default_rng(5)
    real = np.array([rng.permutation(values)[:30].sum() for _ in range(4000)])
    assert len(got) == 4000 and abs(got.mean() - real.mean()) < 5 * real.std() / math.sqrt(2000) and abs(got.std() / real.std() - 1) < 0.06
    assert {r["s"] for r in resample.chosen_sums(df, "v", 100, 5, 2).collect()} == {values.sum()}


def test_permutation_finds_a_real_difference(spark):
    far = spark.range(400).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("g"), (F.col("id") % 2 * 10 + F.col("id") % 5).alias("v"))
    assert resample.permutation_test(far, "g", "v", reps=200).first()["p_value"] == 0.0
    none = spark.range(400).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("g"), (F.hash("id") % 100).alias("v"))
    assert resample.permutation_test(none, "g", "v", reps=200).first()["p_value"] > 0.01
    odd = none.unionByName(spark.createDataFrame([(None, 5), ("A", None)], "g string, v int"))
    assert resample.permutation_test(odd, "g", "v", reps=200).collect() == resample.permutation_test(none, "g", "v", reps=200).collect()
    assert resample.permutation_test(none.where("false"), "g", "v", reps=5).first()["n_above"] == 0


def test_replicates_never_meet_rows(spark):
    """No stage holds rows times replicates: the widest table is replicates times distinct values."""
    rows = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("g"), (F.col("id") % 7).alias("v"))
    start = time.time()
    assert resample.permutation_test(rows, "g", "v", reps=1000).first()["p_value"] <= 1
    assert resample.bootstrap_ci(rows, "v", reps=1000).first()["stat"] == 3
    assert time.time() - start < 60  # 400 million draws would take far longer


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = resample.hash_split(df.repartition(3), ["id"], 0.75, 5)
    b = resample.hash_split(df.coalesce(1), ["id"], 0.75, 5)
    assert rows(a) == rows(b)
    assert 700 < a.where("part = 'train'").count() < 800


def test_constant_over_many_partitions(spark):
    df = spark.range(0, 9999, 1, 37).select("id", F.lit(0.1).alias("c"), (F.col("id") % 3).alias("g"))
    row = df.agg(stats.pearson("c", "id").alias("a"), stats.pearson("id", "g").alias("b")).first()
    assert row["a"] is None and row["b"] is not None


def test_crosstab_tells_null_labels_from_totals(spark):
    df = spark.createDataFrame([("x", None), ("x", "y"), (None, "y")], "a string, b string")
    got = profile.crosstab(df, "a", "b").collect()
    assert len({(r["a"], r["b"], r["level"]) for r in got}) == len(got) == 8
    assert next(r["n"] for r in got if r["level"] == 3) == 3
