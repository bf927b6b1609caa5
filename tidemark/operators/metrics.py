"""Quality of predictions from plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .profile import unpivot

CLIP = 1e-15


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """r2, rmse and mse in long form."""
    error = F.col(label) - F.col(prediction)
    sums = df.agg(F.avg(error * error).alias("mse"), F.var_pop(label).alias("_v"))
    row = sums.select((F.lit(1.0) - ratio(F.col("mse"), F.col("_v"))).alias("r2"), F.sqrt("mse").alias("rmse"), "mse")
    return unpivot(row, ["r2", "rmse", "mse"], "double").withColumnRenamed("column", "metric")


def residuals(df: DataFrame, keys: list[str], label: str, prediction: str) -> DataFrame:
    """Mean residual and row count per location."""
    return df.groupBy(*keys).agg(F.avg(F.col(prediction) - F.col(label)).alias("residual"), F.count("*").alias("n"))


def weighted_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1 of every class weighted by how often the class truly occurs."""
    cells = df.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")).agg(F.count("*").alias("n"))
    sides = F.array(
        F.struct(F.col("l").alias("c"), F.col("n").alias("real"), F.lit(0).cast("bigint").alias("said"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("real"), F.col("n").alias("said"), F.lit(0).cast("bigint").alias("hit")),
    )
    per_class = cells.select(F.explode(sides).alias("_s")).select("_s.*").groupBy("c").agg(F.sum("real").alias("real"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    f1 = ratio(F.col("hit") * 2, F.col("real") + F.col("said"))
    return per_class.agg(ratio(F.sum(f1 * F.col("real")), F.sum("real")).alias("value")).select(F.lit("weighted_f1").alias("metric"), "value")


def row_log_loss(label: str, probability: str):
    p = F.least(F.greatest(F.col(probability), F.lit(CLIP)), F.lit(1 - CLIP))
    y = F.col(label).cast("double")
    return -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))


def log_loss(df: DataFrame, label: str, probability: str) -> DataFrame:
    return df.agg(F.avg(row_log_loss(label, probability)).alias("value")).select(F.lit("log_loss").alias("metric"), "value")
