import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import relational as rel, sports
from tidemark.operators.skew import hot_hashes, salted_join
from tidemark.plans import standins as si


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("k"), "id")
    big = big.unionByName(spark.createDataFrame([(None, -1)], "k int, id bigint"))
    small = spark.createDataFrame([(7, "hot"), (8, "x"), (8, "y"), (99, "z")], "k bigint, v string")
    assert hot_hashes(big, ["k"], 0.1)
    got, want = salted_join(big, small, ["k"], ["id"], how, share=0.1), big.join(small, ["k"], how)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_broadcast_and_shuffle_forms_agree(spark, tables):
    views, notes, obs = si.pageviews(tables), si.comments(tables), si.observations(tables)
    assert rows(rel.popular_pages(views, broadcast=True)) == rows(rel.popular_pages(views, broadcast=False))
    assert rows(rel.relative_scores(notes)) == rows(rel.relative_scores(notes, broadcast=True))
    assert rows(rel.largest_range(obs)) == rows(rel.largest_range(obs, broadcast=True))


def test_repeated_readings_multiply(spark):
    obs = spark.createDataFrame([
        ("A", "d", "TMAX", 100, None), ("A", "d", "TMAX", 90, None), ("A", "d", "TMIN", 10, None),
        ("B", "d", "TMAX", 500, "X"), ("B", "d", "TMIN", 0, None), ("C", "d", "TMAX", 90, None), ("C", "d", "TMIN", 0, None),
    ], "station string, date string, observation string, value int, qflag string")
    assert rel.temp_ranges(obs).count() == 3
    assert rows(rel.largest_range(obs)) == [("d", "A", 9.0), ("d", "C", 9.0)]


def test_gap_drops_previous_day(spark):
    day = lambda d: dt.date(2020, 3, d)
    df = spark.createDataFrame(
        [("A", day(1), 0.0, 0.0, 0.0, 1.0), ("A", day(2), 0.0, 0.0, 0.0, 2.0), ("A", day(4), 0.0, 0.0, 0.0, 4.0)],
        "station string, date date, latitude double, longitude double, elevation double, tmax double",
    )
    got = rel.with_previous_day(df).collect()
    assert [(r["date"], r["dy"], r["yesterday_tmax"], r["tmax"]) for r in got] == [(day(2), 62, 1.0, 2.0)]


def test_dull_pages_and_ties(spark):
    views = spark.createDataFrame(
        [("h", "en", "Main_Page_x", 90), ("h", "en", "Special:a", 80), ("h", "de", "q", 70), ("h", "en", "a", 5), ("h", "en", "b", 5)],
        "hour string, language string, title string, views int",
    )
    assert rows(rel.top_page_per_hour(views)) == [("h", "b", 5)]
    assert rows(rel.popular_pages(views)) == [("h", "a", 5), ("h", "b", 5)]


def test_value_bands(spark):
    df = spark.createDataFrame([(v,) for v in (9999, 10000, 200000, 200001, 1000000, 1000001, None)], "v bigint")
    got = [r[0] for r in df.select(rel.first_band("v", sports.VALUE_BANDS)).collect()]
    assert got == [0, 1, 1, 2, 5, 0, 0]


def test_pair_quality(spark):
    ids = "id1 int, id2 int"
    truth = spark.createDataFrame([(i, i) for i in range(16)], ids)
    found = truth.where("id1 < 6")
    assert rows(rel.evaluate_pairs(found, truth)) == [(1.0, 0.375, 6 / 11)]
    assert rel.evaluate_pairs(found.limit(0), truth).first()["precision"] is None


def test_head_to_head_and_tally_agree(spark, tables):
    m = si.matches(tables)
    a, b = "N3", "N4"
    row = sports.head_to_head(m, a, b).first()
    met = m.where(f"(home = '{a}' and away = '{b}') or (home = '{b}' and away = '{a}')")
    assert sum(row) == met.count()
    tally = {(r["side"], r["outcome"]): r["n"] for r in sports.result_tally(met, [a]).collect()}
    assert tally.get(("home", "win"), 0) + tally.get(("away", "win"), 0) == row["team_a_wins"]


def test_recode_keeps_unknown_values(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    mapping = spark.createDataFrame([("a", "1")], "s string, t string")
    assert sorted(str(r[0]) for r in rel.recode(df, "c", mapping, "s", "t").collect()) == ["1", "None", "z"]


def test_drop_and_fill(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    assert rows(rel.drop_and_fill(df, ["a"], {"b": 0})) == [(1, 0)]
