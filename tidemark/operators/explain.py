"""Explaining fitted classifiers with batch scoring.

Rows are ``(id, label, x)`` with ``x`` an array of feature values; all altered copies of the
rows are scored in one ``transform``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash, seeded_uniform
from ..session import cut_lineage
from .metrics import row_log_loss
from .models import train_black_box
from .ranks import row_numbers, running_totals
from .skew import over_tasks

EXPLAINED_AT_ONCE = 50  # rows of which one task makes, scores and fits all copies


def feature_rows(df: DataFrame, id: str, label: str, names: Sequence[str]) -> DataFrame:
    """Named columns as one array, the layout the functions here work on."""
    return df.select(
        F.col(id).alias("id"), F.col(label).cast("double").alias("label"), F.array(*[F.col(n).cast("double") for n in names]).alias("x")
    )


def with_vector(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector("x"))


def probability(model, rows: DataFrame, name: str = "p") -> DataFrame:
    """Add the predicted probability of class 1."""
    scored = model.transform(with_vector(rows)).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*rows.columns, name)


def coefficients(model, names: Sequence[str], spark) -> DataFrame:
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray(), strict=True)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def contributions(rows: DataFrame, names: Sequence[str], weights: Sequence[float]) -> DataFrame:
    """Coefficient times value for every row and feature."""
    cells = F.array(*[
        F.struct(F.lit(n).alias("feature"), (F.col("x")[i] * F.lit(float(w))).alias("effect"))
        for i, (n, w) in enumerate(zip(names, weights, strict=True))
    ])
    return rows.select("id", F.explode(cells).alias("_c")).select("id", "_c.*")


def _replaced(index: Column, value: Column) -> Column:
    return F.transform("x", lambda v, i: F.when(i == index, value).otherwise(v))


def permutation_importance(model, rows: DataFrame, names: Sequence[str], seed: int = 1) -> DataFrame:
    """Increase of the log-loss after shuffling each feature.

    The value of the row at position i of the key order moves to the row at position i of a
    hash order, separately per feature.
    """
    rows = cut_lineage(rows)
    numbered = row_numbers(rows, "id", name="position")
    cells = rows.select("id", F.posexplode("x").alias("feature", "value")).withColumn("h", seeded_hash(seed, "feature", "id"))
    shuffled = running_totals(cells, ["feature"], ["h", "id"], F.lit(1).cast("bigint"), "position")
    altered = numbered.join(shuffled.select("feature", "position", "value"), "position").select(
        "id", "label", _replaced(F.col("feature"), F.col("value")).alias("x"), "feature"
    )
    plain = probability(model, rows).agg(F.avg(row_log_loss("label", "p"))).scalar()
    losses = probability(model, altered).groupBy("feature").agg(F.avg(row_log_loss("label", "p")).alias("_l"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("feature") + 1)
    return losses.select(name.alias("feature"), (F.col("_l") - plain).alias("importance"))


def partial_dependence(model, rows: DataFrame, names: Sequence[str], wanted: Sequence[str], points: int = 10) -> DataFrame:
    """Mean prediction with a feature set to each of evenly spaced values between its ends."""
    index = {n: i for i, n in enumerate(names)}
    ends = rows.agg(*[
        f(F.col("x")[index[n]]).alias(f"{side}_{n}") for n in wanted for side, f in (("lo", F.min), ("hi", F.max))
    ]).first()
    settings = F.array(*[
        F.struct(F.lit(n).alias("feature"), F.lit(index[n]).alias("i"),
                 F.lit(ends[f"lo_{n}"] + (ends[f"hi_{n}"] - ends[f"lo_{n}"]) * k / (points - 1)).alias("value"))
        for n in wanted for k in range(points)
    ])
    each = rows.select("id", "label", "x", F.explode(settings).alias("_s")).select(
        "id", "label", _replaced(F.col("_s.i"), F.col("_s.value")).alias("x"), "_s.feature", "_s.value"
    )
    return probability(model, each).groupBy("feature", "value").agg(F.avg("p").alias("mean_p"))


def surrogate(model, rows: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Logistic regression fitted to the model's own decisions: coefficients and agreement."""
    said = cut_lineage(model.transform(with_vector(rows)).select("features", F.col("prediction").alias("label")))
    simple = train_black_box(said, "logistic")
    same = simple.transform(said).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("agreement"))
    return coefficients(simple, names, rows.sparkSession), same


def shapley(model, rows: DataFrame, background: DataFrame, names: Sequence[str], samples: int = 10, seed: int = 1) -> DataFrame:
    """Additive attribution per row and feature from sampled feature orders.

    For each sample a hash picks a background row and an order of the features; features move
    one by one from the background row to the explained row and the change in the prediction is
    the feature's share. Shares of a row sum to its prediction minus ``base``.
    """
    d = len(names)
    pool = cut_lineage(row_numbers(background.select("id", "x"), "id", name="position").select("position", F.col("x").alias("b")))
    size = pool.count()
    draws = rows.select("id", "label", "x", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("k")).withColumn(
        "position", seeded_hash(seed, F.lit("row"), "id", "k") % size
    )
    order = F.transform(
        F.array_sort(F.array(*[F.struct(seeded_hash(seed, F.lit(i), "id", "k").alias("h"), F.lit(i).alias("i")) for i in range(d)])),
        lambda s: s["i"],
    )
    mixed = draws.join(pool, "position").withColumn("order", order).select(
        "id", "label", "k", "order", "x", "b", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("step")
    ).select(
        "id", "label", "order", "step",
        F.transform("x", lambda v, i: F.when(F.array_position(F.col("order"), i) <= F.col("step"), v).otherwise(F.get(F.col("b"), i))).alias("x"),
    )
    scored = probability(model, mixed)
    # the feature that arrives at this step gains the prediction, the next one gives it away
    signed = F.array(
        F.struct(F.when(F.col("step") > 0, F.get("order", F.col("step") - 1)).alias("i"), F.col("p").alias("v"), F.lit(0.0).alias("base")),
        F.struct(F.when(F.col("step") < d, F.get("order", F.col("step"))).alias("i"), (-F.col("p")).alias("v"), F.lit(0.0).alias("base")),
    )
    shares = (
        scored.select("id", F.explode(signed).alias("_s")).select("id", "_s.i", "_s.v").where(F.col("i").isNotNull())
        .groupBy("id", "i").agg((F.sum("v") / samples).alias("share"))
    )
    bases = scored.where("step = 0").groupBy("id").agg(F.avg("p").alias("base"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    return shares.join(bases, "id").select("id", name.alias("feature"), "share", "base")


def local_surrogate(
    model, rows: DataFrame, background: DataFrame, names: Sequence[str], n: int = 100, width: float = 0.75, seed: int = 1
) -> DataFrame:
    """Linear model around each row: weights of the features in a neighbourhood of it.

    Each row gets ``n`` copies moved by normal noise in units of the feature's deviation over
    ``background``, so a single row can be explained; copies are weighted by closeness. The solver
    sees one row's ``n`` copies at a time.
    """
    d = len(names)
    deviations = background.agg(*[F.stddev_samp(F.col("x")[i]) for i in range(d)]).first()
    facts = F.array(*[F.lit(float(v or 0.0)) for v in deviations])

    def normal(i: int) -> Column:
        u = F.lit(1.0) - seeded_uniform(seed, F.lit(f"u{i}"), "id", "k")
        v = seeded_uniform(seed, F.lit(f"v{i}"), "id", "k")
        return F.sqrt(F.log(u) * -2.0) * F.cos(v * (2 * np.pi))

    # dealt before copying, by the key that copies are grouped by later
    dealt = over_tasks(cut_lineage(rows), EXPLAINED_AT_ONCE, "id")
    copies = dealt.select("id", "label", F.col("x").alias("x0"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k")).withColumn(
        "z", F.array(*[normal(i) for i in range(d)])
    ).withColumn("x", F.transform("x0", lambda v, i: v + F.get(F.col("z"), i) * F.get(facts, i))).select("id", "label", "z", "x")
    spread = float(width * np.sqrt(d))
    scored = probability(model, copies).select(
        "id", "z", "p", F.exp(F.aggregate("z", F.lit(0.0), lambda a, v: a + v * v) / (-spread * spread)).alias("w")
    )
    labels = list(names)

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        z = np.column_stack([np.ones(len(part)), np.vstack(part["z"].to_numpy())])
        root = np.sqrt(part["w"].to_numpy())
        fit = np.linalg.lstsq(z * root[:, None], part["p"].to_numpy() * root, rcond=None)[0]
        return pd.DataFrame({"id": part["id"].iloc[0], "feature": labels, "weight": fit[1:], "intercept": fit[0]})

    kind = dict(rows.dtypes)["id"]
    return scored.groupBy("id").applyInPandas(solve, f"id {kind}, feature string, weight double, intercept double")
