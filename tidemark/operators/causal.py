"""Treatment effects by matching and by outcome models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import euclidean, ratio
from ..session import cut_lineage
from .skew import salted_join

FAN, LEAF = 16, 32  # shares a box is cut into, points of the smallest boxes


def _effect(matched: DataFrame, controls: DataFrame) -> DataFrame:
    """``matched`` has one row per distinct control point: t (treated outcome), n and s (controls)."""
    total = controls.agg(F.count("*")).scalar()
    found = matched.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_matched"), F.sum(F.col("t") * F.col("n") - F.col("s")).alias("_d"))
    return found.select(
        "n_matched", ratio(F.col("n_matched") * 100.0, total).alias("pct"), ratio(F.col("_d"), F.col("n_matched")).alias("effect")
    )


def _points(df: DataFrame, treat: str, outcome: str, coords: Sequence[str], id: str) -> tuple[DataFrame, DataFrame]:
    """Distinct control points with count and outcome sum; distinct treated points with their first id.

    Both are combined before the shuffle, so many people with equal covariates cost one row.
    """
    controls = df.where(F.col(treat) == 0).groupBy(*coords).agg(F.count("*").alias("n"), F.sum(outcome).alias("s"))
    first = F.min(F.struct(F.col(id).alias("id"), F.col(outcome).alias("t")))
    treated = df.where(F.col(treat) == 1).groupBy(*coords).agg(first.alias("m"))
    return controls, treated


def exact_match_effect(df: DataFrame, treat: str, outcome: str, covariates: Sequence[str], id: str) -> DataFrame:
    """Controls matched to the first treated person with equal covariates: count, share, mean effect."""
    controls, treated = _points(df, treat, outcome, covariates, id)
    matched = controls.join(treated, list(covariates)).select(F.col("m.t").alias("t"), "n", "s")
    return _effect(matched, df.where(F.col(treat) == 0))


def _boxes(points: DataFrame, keys: Sequence[str], coords: Sequence[str]) -> DataFrame:
    """Bounding box of each node; a node of more than ``LEAF`` points also gets cuts along its longest side."""
    ends = [F.min(c).alias(f"_lo_{c}") for c in coords] + [F.max(c).alias(f"_hi_{c}") for c in coords]
    shares = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    cuts = [F.percentile_approx(c, shares, F.lit(8 * FAN)).alias(f"_q_{c}") for c in coords]
    found = points.groupBy(*keys).agg(F.count("*").alias("_n"), *ends, *cuts)
    sides = F.array_max(F.array(*[
        F.struct((F.col(f"_hi_{c}") - F.col(f"_lo_{c}")).alias("side"), F.lit(i).alias("axis"), F.array_distinct(f"_q_{c}").alias("cuts")) for i, c in enumerate(coords)
    ]))
    wide = (F.col("_n") > LEAF) & (sides["side"] > 0)
    return cut_lineage(found.withColumns({"_axis": F.when(wide, sides["axis"]), "_cuts": F.when(wide, sides["cuts"])}).drop("_n", *[f"_q_{c}" for c in coords]))


def _partition(points: DataFrame, coords: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """A balanced partition of distinct points: the boxes of each level from the root, and the points by leaf.

    A node is cut at approximate quantiles along its longest side. Points that lie on a cut become a
    part of their own, which has no length along that side any more, so equal coordinates are told
    apart by the other columns and every leaf ends up with at most ``LEAF`` points.
    """
    placed = cut_lineage(points.withColumn("_node", F.lit("")))
    levels, leaves = [_boxes(placed, ["_node"], coords).withColumn("_up", F.lit(None).cast("string"))], None
    while True:
        met = cut_lineage(salted_join(placed, levels[-1].select("_node", "_axis", "_cuts"), ["_node"], coords))
        ended = met.where("_cuts is null").drop("_axis", "_cuts", "_up")
        leaves = ended if leaves is None else leaves.unionByName(ended)
        if levels[-1].where("_cuts is not null").isEmpty():
            return levels, leaves
        at = F.element_at(F.array(*coords), F.col("_axis") + 1)
        part = 2 * F.size(F.filter("_cuts", lambda c: c < at)) + F.array_contains("_cuts", at).cast("int")
        split = met.where("_cuts is not null").withColumn("_up", F.col("_node"))
        placed = split.withColumn("_node", F.concat_ws("/", "_up", part.cast("string"))).drop("_axis", "_cuts")
        levels.append(_boxes(placed, ["_up", "_node"], coords))


def _reaches(boxes: DataFrame, coords: Sequence[str]) -> DataFrame:
    """Least and greatest squared distance of a left point to a box, in place of the box."""
    near, far = F.lit(0.0), F.lit(0.0)
    for c in coords:
        below, above = F.col(f"_lo_{c}") - F.col(c), F.col(c) - F.col(f"_hi_{c}")
        gap = F.greatest(below, above, F.lit(0.0))
        reach = F.greatest(F.abs(below), F.abs(above))
        near, far = near + gap * gap, far + reach * reach
    return boxes.select(*coords, "_node", F.col("_cuts").isNull().alias("_leaf"), near.alias("_near"), far.alias("_far"))


def _prune(pairs: DataFrame, coords: Sequence[str], radius: float) -> DataFrame:
    """Keep the boxes that can hold the nearest point of their left point.

    Some point of a box is no farther than the box's far corner, so boxes that begin beyond the
    least far corner, or beyond the radius, are out.
    """
    slack = 1 + 1e-9
    bound = F.min("_far").over(Window.partitionBy(*coords))  # few boxes per point
    near = F.col("_near")
    return cut_lineage(pairs.withColumn("_bound", bound).where((near <= F.col("_bound") * slack) & (near <= radius * radius * slack)).drop("_bound"))


def nearest_within(left: DataFrame, right: DataFrame, coords: Sequence[str], radius: float, strict: bool) -> DataFrame:
    """For each left point the nearest right point within a radius; ties take the smallest id.

    ``left`` and ``right`` hold distinct points, ``right`` with a struct ``m`` that starts with the
    id. Right points are cut into nested boxes over all columns, down to leaves of at most ``LEAF``
    points. Left points descend and follow only boxes that can still hold their nearest point, so
    crowded regions on either side never meet pair by pair, and no pair is missed. Boxes many left
    points go through are spread by ``salted_join``. Points with a null or non-finite coordinate have no nearest.
    """
    coords = list(coords)
    doubles = [F.col(c).cast("double").alias(c) for c in coords]
    finite = " and ".join(f"abs(`{c}`) < double('infinity')" for c in coords)
    levels, leaves = _partition(right.select("m", *doubles).where(finite), coords)
    points = left.select(*doubles).where(finite).distinct()
    root = points.withColumn("_node", F.lit("")).join(F.broadcast(levels[0]), "_node")  # one box
    pairs = _prune(_reaches(root, coords), coords, radius)
    for boxes in levels[1:]:
        below = salted_join(pairs.where("not _leaf").select(*coords, F.col("_node").alias("_up")), boxes, ["_up"], coords)
        pairs = _prune(pairs.where("_leaf").unionByName(_reaches(below, coords)), coords, radius)

    targets = leaves.withColumnsRenamed({c: f"_r_{c}" for c in coords})
    met = salted_join(pairs.select(*coords, "_node"), targets, ["_node"], coords).withColumn("distance", euclidean(coords, [f"_r_{c}" for c in coords]))
    near = F.col("distance") < radius if strict else F.col("distance") <= radius
    best = met.where(near).groupBy(*coords).agg(F.min(F.struct("distance", "m")).alias("_b"))
    return left.join(best.select(*coords, F.col("_b.m").alias("m"), F.col("_b.distance").alias("distance")), coords)


def nearest_sorted(left: DataFrame, right: DataFrame, coord: str, radius: float, strict: bool) -> DataFrame:
    """``nearest_within`` along one coordinate: both sides are sorted together and look to their neighbours.

    The points are cut into ranges of the coordinate. The nearest right point is the last one before or the first one
    after, in the same range or, at its borders, in the next range that has one: one row a range is exchanged.
    """
    x = F.col(coord).cast("double").alias("_x")
    kind = dict(right.dtypes)["m"]
    held = F.struct("_x", "m")
    mine, theirs = left.select(x, F.lit(None).cast(kind).alias("m")), right.select(x, "m")
    both = mine.distinct().unionByName(theirs).where("_x is not null")
    placed = cut_lineage(both.repartitionByRange("_x").withColumn("_p", F.spark_partition_id()))
    point = F.when(F.col("m").isNotNull(), held)
    # both frames take in points at the same place
    before = F.last(point, ignorenulls=True).over(Window.partitionBy("_p").orderBy("_x").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.last(point, ignorenulls=True).over(Window.partitionBy("_p").orderBy(F.desc("_x")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ends = placed.groupBy("_p").agg(F.max_by(point, F.when(F.col("m").isNotNull(), F.col("_x"))).alias("last"), F.min_by(point, F.when(F.col("m").isNotNull(), F.col("_x"))).alias("first"))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    later = Window.orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, -1)
    borders = ends.select("_p", F.last("last", ignorenulls=True).over(earlier).alias("_l"), F.last("first", ignorenulls=True).over(later).alias("_f"))
    seen = placed.select("_p", "_x", "m", before.alias("_b"), after.alias("_a")).where("m is null").join(F.broadcast(borders), "_p")
    sides = F.array(F.coalesce("_b", "_l"), F.coalesce("_a", "_f"))
    measured = F.transform(F.filter(sides, lambda c: c.isNotNull()), lambda c: F.struct(F.abs(c["_x"] - F.col("_x")).alias("distance"), c["m"].alias("m")))
    near = F.filter(measured, lambda c: c["distance"] < radius if strict else c["distance"] <= radius)
    best = seen.select("_x", F.array_min(near).alias("_n")).where("_n is not null").select("_x", F.col("_n.m").alias("m"), F.col("_n.distance").alias("distance"))
    return left.withColumn("_x", F.col(coord).cast("double")).join(best, "_x").drop("_x")


def nearest_match_effect(
    df: DataFrame, treat: str, outcome: str, covariates: Sequence[str], id: str, threshold: float = 1000.0, strict: bool = True
) -> DataFrame:
    """Controls matched to the nearest treated person closer than a threshold."""
    measured = df.withColumns({c: F.col(c).cast("double") for c in covariates})
    controls, treated = (cut_lineage(points) for points in _points(measured, treat, outcome, covariates, id))
    if len(covariates) == 1:
        matched = nearest_sorted(controls, treated, covariates[0], threshold, strict)
    else:
        matched = nearest_within(controls, treated, covariates, threshold, strict)
    return _effect(matched.select(F.col("m.t").alias("t"), "n", "s"), df.where(F.col(treat) == 0))


def propensity_match_effect(
    df: DataFrame, treat: str, outcome: str, score: str, id: str, threshold: float = 0.01
) -> DataFrame:
    """Controls matched to the treated person with the closest score, at most a threshold away."""
    return nearest_match_effect(df, treat, outcome, [score], id, threshold, strict=False)


def propensity_effect(
    df: DataFrame, treat: str, outcome: str, confounders: Sequence[str], id: str, threshold: float = 0.01
) -> DataFrame:
    """Effect by matching on the probability of treatment, fitted on the named confounders."""
    scored = propensity_scores(df.select(id, treat, outcome, *confounders), treat, confounders, "_score")
    return propensity_match_effect(cut_lineage(scored), treat, outcome, "_score", id, threshold)


def propensity_scores(df: DataFrame, treat: str, covariates: Sequence[str], name: str = "score") -> DataFrame:
    """Probability of treatment given the covariates, by logistic regression."""
    stages = [
        VectorAssembler(inputCols=list(covariates), outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=treat, probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_pred"),
    ]
    scored = Pipeline(stages=stages).fit(df).transform(df)
    return scored.withColumn(name, vector_to_array("_p")[1]).drop("_features", "_p", "_raw", "_pred")


def _linear(df: DataFrame, label: str, columns: Sequence[str], prediction: str):
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol=f"_f_{prediction}"),
        LinearRegression(featuresCol=f"_f_{prediction}", labelCol=label, predictionCol=prediction),
    ]
    return Pipeline(stages=stages).fit(df)


def two_model_effect(df: DataFrame, treat: str, outcome: str, covariates: Sequence[str]) -> DataFrame:
    """Mean of predicted minus observed outcome, each group predicted by the other group's model."""
    with_treatment = _linear(df.where(F.col(treat) == 1), outcome, covariates, "_y1")
    without = _linear(df.where(F.col(treat) == 0), outcome, covariates, "_y0")
    both = without.transform(with_treatment.transform(df))
    gain = F.when(F.col(treat) == 1, F.col(outcome) - F.col("_y0")).otherwise(F.col("_y1") - F.col(outcome))
    return both.agg(F.count("*").alias("n"), F.avg(gain).alias("effect"))


def adjusted_effect(df: DataFrame, treat: str, outcome: str, confounders: Sequence[str]) -> DataFrame:
    """Coefficient of the treatment in a linear model with the confounders."""
    model = _linear(df, outcome, [treat, *confounders], "_y").stages[-1]
    return df.sparkSession.createDataFrame([(treat, float(model.coefficients[0]))], "term string, effect double")
