"""Feature building, metrics, models and explanations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.colour import rgb_to_lab
from ..functions.hashing import hash_sql
from ..functions.numeric import rounded
from ..operators import explain, features, metrics, models, trees
from ..operators.relational import with_previous_day
from ..operators.resample import hash_split
from ..operators.skew import over_tasks
from ..session import cut_lineage
from . import standins as si
from .registry import query
from .tables import Tables

KINDS = ("kind", "hour")
TRAINED_AT_ONCE = 20_000  # rows of a network's training that are worth a task, read once per iteration


def flags_sql(column: str) -> str:
    """Flag columns need the value list; the list is made by the same rule in SQL."""
    return f"(select list(v order by f, v) from (select {column} as v, min(id) as f from connections group by 1))"


@query("one_hot", "select id, " + ", ".join(
    f"cast({c} = kv.{c}s[{i + 1}] as integer) as {c}_{i}" for c, n in (("kind", 5), ("hour", 24)) for i in range(n)
) + f", value from connections, (select {flags_sql('kind')} as kinds, {flags_sql('hour')} as hours) as kv", ("connections",))
def one_hot(t: Tables) -> DataFrame:
    return features.one_hot(si.connections(t), KINDS, "id")


@query("standardise", """
    select id, round((value - avg(value) over ()) / stddev_samp(value) over (), 6) + 0.0 as z from connections""", ("connections",))
def standardise(t: Tables) -> DataFrame:
    scaled = features.standardise(si.connections(t), ["value"])
    return scaled.select("id", rounded(F.col("value")).alias("z"))


@query("cluster_size_score", """
    , sizes as (select cluster, count(*) as n from cover group by 1)
    select id, round((select max(n) from sizes) - n, 6)::double / nullif((select max(n) - min(n) from sizes), 0) as score
    from cover join sizes using (cluster)""", ("cover",))
def cluster_size_score(t: Tables) -> DataFrame:
    return features.cluster_size_score(si.cover(t).select("id", "cluster"), "cluster").select("id", "score")


@query("anomalies")
def anomalies(t: Tables) -> DataFrame:
    return models.detect(si.connections(t), KINDS, ["value"], "id", k=8, threshold=0.97)


MIN_MAX_SQL = f"""
    , facts as (select {", ".join(f"min({c}) as lo_{c}, max({c}) as hi_{c}" for c in si.COVER)} from cover
                where ({hash_sql("'2'", "id")} >> 8)::double / (1::bigint << 52) < 0.8)
    select id, {", ".join(f"round(({c} - lo_{c}) / (hi_{c} - lo_{c}), 6) + 0.0 as {c}" for c in si.COVER)} from cover, facts"""


@query("min_max", MIN_MAX_SQL, ("cover",))
def min_max(t: Tables) -> DataFrame:
    """Ranges come from the training part, every row is scaled."""
    data = hash_split(si.cover(t), ["id"], 0.8, 2)
    scaled = features.min_max(data.where(F.col("part") == "train"), data, si.COVER)
    return scaled.select("id", *[rounded(F.col(c)).alias(c) for c in si.COVER])


@query("otsu", """
    with recursive ends as (select min(p_retailprice) as lo, max(p_retailprice) as hi from part),
    counts as (select least(256, floor((p_retailprice - lo) / ((hi - lo) / 256)) + 1)::integer as bin, count(*)::double as n from part, ends group by 1),
    every as (select b.bin::integer as bin, coalesce(n, 0) as n, lo + (hi - lo) / 256 * (b.bin - 0.5::double) as centre
              from ends, range(1, 257) as b(bin) left join counts on counts.bin = b.bin),
    sides as (select bin, centre, sum(n) over (order by bin) as w1, sum(n * centre) over (order by bin) as s1,
                     sum(n) over (order by bin rows between 1 following and unbounded following) as w2,
                     sum(n * centre) over (order by bin rows between 1 following and unbounded following) as s2 from every),
    best as (select centre from sides where w1 > 0 and w2 > 0 order by round(w1 * w2 * (s1 / w1 - s2 / w2) ** 2, 3) desc, bin limit 1)
    select round(centre, 6) as threshold, (select count(*) from part where p_retailprice >= centre) as n_above from best""")
def otsu(t: Tables) -> DataFrame:
    found = features.otsu_threshold(t.part, "p_retailprice")
    return found.withColumn("threshold", rounded(F.col("threshold")))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("dummies", "select c_custkey, c_acctbal, " + ", ".join(
    f"cast(c_mktsegment = '{s}' as integer) as \"c_mktsegment_{s}\"" for s in SEGMENTS) + " from customer")
def dummies(t: Tables) -> DataFrame:
    return features.dummies(t.customer, ["c_mktsegment"], ["c_custkey", "c_acctbal"])


# -- features over related tables ------------------------------------------------------------------

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")


def retail(t: Tables) -> features.EntitySet:
    users = t.customer.select("c_custkey", (F.col("c_mktsegment") == "BUILDING").cast("int").alias("label"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(
        t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    ).drop("p_partkey")
    return features.EntitySet(
        tables={"users": users, "orders": t.orders.select(*ORDER_COLUMNS), "lines": lines},
        keys={"users": "c_custkey", "orders": "o_orderkey"},
        links=[("users", "orders", "o_custkey"), ("orders", "lines", "l_orderkey")],
        categories={"lines": ["l_partkey"]},
    )


def group_sql(name: str, source: str, key: str, child: str, numbers: list[str], labels: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Named tables with all aggregates of ``source`` per key, and the columns they add."""
    nums, cats = [f"count_{child}"], []
    exprs = [f"count(*) as count_{child}"]
    means = ", ".join(f"avg({c}) over (partition by {key}) as m_{c}" for c in numbers)
    for c in numbers:
        skew = (f"case when count({c}) > 2 and sqrt(sum(({c} - m_{c}) ** 2)) > 1e-9 then count({c})::double / ((count({c}) - 1) * (count({c}) - 2))"
                f" * sum(({c} - m_{c}) ** 3) / power(sum(({c} - m_{c}) ** 2) / (count({c}) - 1), 1.5) end")
        for agg, sql in (("sum", f"sum({c})"), ("std", f"stddev_samp({c})"), ("skew", skew), ("median", f"quantile_cont({c}, 0.5)")):
            exprs.append(f"{sql} as {agg}_{child}_{c}")
            nums.append(f"{agg}_{child}_{c}")
    tables = [f"{name}_n as materialized (select {key}, {', '.join(exprs)} from (select *, {means} from {source}) group by {key})"]
    for c in labels:
        tables.append(f"""{name}_{c} as materialized (
            select {key}, cast(arg_min(v, (-n, v)) as varchar) as mode_{child}_{c}, count(*) as n_unique_{child}_{c}
            from (select {key}, cast({c} as varchar) as v, count(*) as n from {source} where {c} is not null group by all) group by {key})""")
        cats.append(f"mode_{child}_{c}")
        nums.append(f"n_unique_{child}_{c}")
    return tables, nums, cats


def deep_sql() -> tuple[str, list[str], list[str]]:
    t1, n1, c1 = group_sql("l", "lines", "l_orderkey", "lines", ["l_quantity"], ["l_partkey", "p_brand"])
    joins = " left join l_n on l_n.l_orderkey = o_orderkey " + " ".join(f"left join l_{c} on l_{c}.l_orderkey = o_orderkey" for c in ("l_partkey", "p_brand"))
    order_numbers = ["o_totalprice", *n1]
    order_labels = ["o_orderpriority", *c1, "day_o_orderdate", "minute_o_orderdate"]
    orders2 = (f"orders2 as materialized (select o_orderkey, o_custkey, o_totalprice, o_orderpriority, "
               f"cast(day(o_orderdate) as varchar) as day_o_orderdate, cast(minute(o_orderdate) as varchar) as minute_o_orderdate, "
               f"{', '.join([*n1, *c1])} from orders {joins})")
    t2, n2, c2 = group_sql("o", "orders2", "o_custkey", "orders", order_numbers, order_labels)
    joins2 = " left join o_n on o_n.o_custkey = c_custkey " + " ".join(f"left join o_{c} on o_{c}.o_custkey = c_custkey" for c in order_labels)
    lines = "lines as materialized (select l_orderkey, l_partkey, l_quantity, p_brand from lineitem join part on l_partkey = p_partkey)"
    head = f"with {lines}, {', '.join(t1)}, {orders2}, {', '.join(t2)}, deep as materialized (select c_custkey, case when c_mktsegment = 'BUILDING' then 1 else 0 end as label, {', '.join([*n2, *c2])} from customer {joins2}) "
    return head, n2, c2


DEEP_HEAD, DEEP_NUMBERS, DEEP_LABELS = deep_sql()
WHOLE = [c for c in DEEP_NUMBERS if c.startswith(("count_", "n_unique_"))]
REAL = [c for c in DEEP_NUMBERS if c not in WHOLE]


def digits(column: str) -> int:
    """Money sums are large and carry few exact decimals; skewness is near one.

    Both sides are scaled by 1 + 1e-9 first, so that exact halves round the same way.
    """
    return 7 if column.startswith("skew_") else 4


@query("deep_features", DEEP_HEAD + "select c_custkey, label, " + ", ".join(
    [f"round({c} * (1 + 1e-9::double), {digits(c)})::double + 0.0 as {c}" for c in REAL] + WHOLE + DEEP_LABELS) + " from deep")
def deep_features(t: Tables) -> DataFrame:
    found = features.synthesise(retail(t), "users")
    return found.select("c_custkey", "label", *[rounded(F.col(c).cast("double") * (1 + 1e-9), digits(c)).alias(c) for c in REAL], *WHOLE, *DEEP_LABELS)


@query("select_features", DEEP_HEAD + "select feature, round(r, 6) as r from (" + " union all ".join(
    f"select '{c}' as feature, case when min({c}) < max({c}) then corr({c}::double, label) end as r from deep" for c in DEEP_NUMBERS
) + ") where r is not null order by r desc, feature limit 10")
def select_features(t: Tables) -> DataFrame:
    found = features.select_by_correlation(features.synthesise(retail(t), "users"), "label", DEEP_NUMBERS)
    return found.withColumn("r", rounded(F.col("r")))


# -- metrics ------------------------------------------------------------------------------------


@query("regression_metrics", """
    , e as (select avg((label - prediction) ** 2) as mse, var_pop(label) as v from predictions)
    select 'r2' as metric, round(1 - mse / v, 6) as value from e union all select 'rmse', round(sqrt(mse), 4) from e
    union all select 'mse', round(mse, 0) from e""", ("predictions",))
def regression_metrics(t: Tables) -> DataFrame:
    found = metrics.regression_metrics(si.predictions(t), "label", "prediction")
    value = F.col("value")
    return found.withColumn(
        "value", F.when(F.col("metric") == "mse", rounded(value, 0)).when(F.col("metric") == "rmse", rounded(value, 4)).otherwise(rounded(value))
    )


@query("residuals", """
    select legal_type, round(avg(prediction - label), 4) as residual, count(*) as n
    from predictions join properties on pid = id group by 1""", ("predictions", "properties"))
def residuals(t: Tables) -> DataFrame:
    placed = si.predictions(t).join(si.properties(t), F.col("pid") == F.col("id"))
    return metrics.residuals(placed, ["legal_type"], "label", "prediction").withColumn("residual", rounded(F.col("residual"), 4))


@query("weighted_f1", """
    , classes as (select distinct class_label as c from predictions),
    f as (select c, count(*) filter (class_label = c) as real, count(*) filter (class_prediction = c) as said,
                 count(*) filter (class_label = c and class_prediction = c) as hit from predictions, classes group by c)
    select 'weighted_f1' as metric, round(sum(2 * hit::double / (real + said) * real) / sum(real), 6) as value from f""", ("predictions",))
def weighted_f1(t: Tables) -> DataFrame:
    return metrics.weighted_f1(si.predictions(t), "class_label", "class_prediction").withColumn("value", rounded(F.col("value")))


@query("log_loss", """
    select 'log_loss' as metric, round(avg(-(flag * ln(p) + (1 - flag) * ln(1 - p))), 6) as value
    from (select flag, least(greatest(probability, 1e-15::double), 1 - 1e-15::double) as p from predictions)""", ("predictions",))
def log_loss(t: Tables) -> DataFrame:
    return metrics.log_loss(si.predictions(t), "flag", "probability").withColumn("value", rounded(F.col("value")))


# -- models ------------------------------------------------------------------------------------


@query("forecast_model")
def forecast_model(t: Tables) -> DataFrame:
    pairs = cut_lineage(hash_split(with_previous_day(si.daily_max(t)), ["station", "date"], 0.75, 1))
    model = models.train_forecast(pairs.where(F.col("part") == "train"))
    scored = models.score(model, pairs.where(F.col("part") == "validation"))
    return scored.select("station", "date", "tmax", "prediction")


@query("forecast_place_only")
def forecast_place_only(t: Tables) -> DataFrame:
    """The forecast without the day before, from place and day of the year; days after a gap count too."""
    days = cut_lineage(hash_split(si.daily_max(t), ["station", "date"], 0.75, 1))
    model = models.train_forecast(days.where(F.col("part") == "train"), with_yesterday=False)
    return models.score(model, days.where(F.col("part") == "validation")).select("station", "date", "tmax", "prediction")


def words(t: Tables) -> DataFrame:
    r, g, b = F.col("R"), F.col("G"), F.col("B")
    word = F.when((r > g) & (r > b), "red").when((g > r) & (g > b), "green").when((b > r) & (b > g), "blue").otherwise("grey")
    return si.colours(t).withColumn("word", word)


@query("colour_model")
def colour_model(t: Tables) -> DataFrame:
    data = over_tasks(cut_lineage(hash_split(words(t), ["id"], 0.75, 1)), TRAINED_AT_ONCE)
    model = models.train_colours(data.where(F.col("part") == "train"), "lab")
    check = rgb_to_lab(data.where(F.col("part") == "validation"), keep=("id", "word"))
    return metrics.weighted_f1(models.score(model, check), "label", "prediction")


@query("predict_grid")
def predict_grid(t: Tables) -> DataFrame:
    return models.predict_grid(models.train_colours(words(t)), t.spark, resolution=256)


@query("value_band_model")
def value_band_model(t: Tables) -> DataFrame:
    data = over_tasks(cut_lineage(hash_split(models.band_table(si.players(t)), ["short_name"], 0.75, 1)), TRAINED_AT_ONCE)
    model = models.train_value_bands(data.where(F.col("part") == "train"))
    return metrics.weighted_f1(models.score(model, data.where(F.col("part") == "validation")), "value_range", "prediction")


def parts(t: Tables) -> DataFrame:
    """Parts with how often and how much of them was ordered."""
    sold = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    return t.part.join(sold, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("quantity", F.lit(0.0)).alias("quantity"), "p_retailprice",
    )


PART_FEATURES = ["p_size", "n_lines", "quantity"]


@query("forest_model")
def forest_model(t: Tables) -> DataFrame:
    data = cut_lineage(hash_split(parts(t), ["p_partkey"], 0.7, 1))
    model = models.train_forest(data.where(F.col("part") == "train"), PART_FEATURES, "p_retailprice")
    return metrics.regression_metrics(models.score(model, data.where(F.col("part") == "validation")), "p_retailprice", "prediction")


@query("importances")
def importances(t: Tables) -> DataFrame:
    model = models.train_forest(cut_lineage(parts(t)), PART_FEATURES, "p_retailprice")
    return models.feature_importances(model, PART_FEATURES, t.spark)


@query("cv_auc")
def cv_auc(t: Tables) -> DataFrame:
    data = cut_lineage(si.programme(t))
    return models.cv_auc(data, ["nation", "n_orders", "balance"], "treat", "id", folds=3)


# -- explanations: all numeric features of the cover table ---------------------------------------------

NAMES = list(si.COVER)
PLOTTED = NAMES[:10]  # the columns that partial dependence is asked for


def rows(t: Tables) -> DataFrame:
    return cut_lineage(explain.feature_rows(si.cover(t), "id", "label", NAMES))


def black(data: DataFrame, kind: str = "gbt"):
    return models.train_black_box(explain.with_vector(data), kind, len(NAMES))


@query("black_box")
def black_box(t: Tables) -> DataFrame:
    data = rows(t)
    forest, network = black(data), black(data, "mlp")
    both = explain.probability(network, explain.probability(forest, data, "p_gbt"), "p_mlp")
    return both.select("id", "label", "p_gbt", "p_mlp")


@query("coefficients")
def coefficients(t: Tables) -> DataFrame:
    return explain.coefficients(black(rows(t), "logistic"), NAMES, t.spark)


WEIGHTS = [round(0.5 - 0.1 * (i % 11), 1) for i in range(len(NAMES))]


@query("contributions", " union all ".join(
    f"select id, '{n}' as feature, round({n} * ({w})::double, 6) + 0.0 as effect from cover" for n, w in zip(NAMES, WEIGHTS)), ("cover",))
def contributions(t: Tables) -> DataFrame:
    found = explain.contributions(explain.feature_rows(si.cover(t), "id", "label", NAMES), NAMES, WEIGHTS)
    return found.withColumn("effect", rounded(F.col("effect")))


@query("permutation_importance")
def permutation_importance(t: Tables) -> DataFrame:
    data = rows(t)
    return explain.permutation_importance(black(data), data, NAMES).orderBy(F.col("importance").desc(), "feature").limit(5)


@query("partial_dependence")
def partial_dependence(t: Tables) -> DataFrame:
    data = rows(t)
    return explain.partial_dependence(black(data), data, NAMES, PLOTTED, 10)


@query("surrogate")
def surrogate(t: Tables) -> DataFrame:
    data = rows(t)
    table, same = explain.surrogate(black(data), data, NAMES)
    return table.withColumn("agreement", same.scalar())


@query("shapley")
def shapley(t: Tables) -> DataFrame:
    """Exact shares of all 64 columns in the raw margin of the boosted trees, for every row."""
    data = rows(t)
    return trees.tree_shapley(trees.model_nodes(black(data)), data, NAMES)


#: Two small trees: (feature, threshold, left, right, training rows) of a split, (value, training rows) of a leaf.
FIXED_TREES = (
    (0, 10.0, (1, 3.0, (2.0, 300), (-1.0, 100), 400), (0, 20.0, (0.5, 150), (4.0, 450), 600), 1000),
    (2, 0.0, (0.25, 200), (1, -2.0, (-3.0, 80), (2, 5.0, (1.5, 220), (-0.75, 500), 720), 800), 1000),
)
FIXED_NAMES = NAMES[:3]


def fixed_nodes() -> list[trees.Node]:
    found: list[trees.Node] = []

    def add(tree: int, shape: tuple, node: int, used: list[int]) -> None:
        if len(shape) == 2:
            found.append(trees.Node(tree, node, None, None, None, None, None, float(shape[1]), shape[0]))
            return
        feature, threshold, left, right, cover = shape
        a, b = used[0], used[0] + 1
        used[0] += 2
        found.append(trees.Node(tree, node, feature, threshold, None, a, b, float(cover), 0.0))
        add(tree, left, a, used)
        add(tree, right, b, used)

    for number, shape in enumerate(FIXED_TREES):
        add(number, shape, 0, [1])
    return found


def known_sql(shape: tuple, known: frozenset) -> str:
    """Expected value of a tree when only some features are known."""
    if len(shape) == 2:
        return f"({shape[0]})::double"
    feature, threshold, left, right, cover = shape
    a, b = known_sql(left, known), known_sql(right, known)
    if feature in known:
        return f"case when {FIXED_NAMES[feature]} <= {threshold} then {a} else {b} end"
    return f"({left[-1]} / {cover}::double * ({a}) + {right[-1]} / {cover}::double * ({b}))"


def attribution_sql(j: int) -> str:
    """Weighted gains over all sets of the other features."""
    parts, others = [], [k for k in range(3) if k != j]
    for size, weight in ((0, 1 / 3), (1, 1 / 6), (2, 1 / 3)):
        for chosen in combinations(others, size):
            for tree in FIXED_TREES:
                parts.append(f"({weight!r} * (({known_sql(tree, frozenset(chosen) | {j})}) - ({known_sql(tree, frozenset(chosen))})))")
    return " + ".join(parts)


@query("tree_attributions", " union all ".join(
    f"select id, '{n}' as feature, round({attribution_sql(j)}, 6) + 0.0 as share, round({' + '.join(known_sql(t, frozenset()) for t in FIXED_TREES)}, 6) as base from cover"
    for j, n in enumerate(FIXED_NAMES)), ("cover",))
def tree_attributions(t: Tables) -> DataFrame:
    found = trees.tree_shapley(fixed_nodes(), explain.feature_rows(si.cover(t), "id", "label", FIXED_NAMES), FIXED_NAMES)
    return found.withColumns({"share": rounded(F.col("share")), "base": rounded(F.col("base"))})


@query("local_surrogate")
def local_surrogate(t: Tables) -> DataFrame:
    data = rows(t)
    return explain.local_surrogate(black(data), data, data, NAMES, n=2 * len(NAMES))
