"""Writers: text, CSV, JSON, connector tables, split outputs and fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, single: bool = False) -> None:
    """One string column as text; ``single`` is for outputs known to be small."""
    (df.coalesce(1) if single else df).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.mode("overwrite").option("compression", compression).csv(path)


def write_json(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.mode("overwrite").option("compression", compression).json(path)


def split_write(df: DataFrame, predicate: Column, path_true: str, path_false: str) -> None:
    """Rows that satisfy the predicate to one folder, all others (null included) to another.

    Two filtered scans: caching the input would cost more than reading it twice.
    """
    flag = F.coalesce(predicate, F.lit(False))
    df.where(flag).write.mode("overwrite").json(path_true)
    df.where(~flag).write.mode("overwrite").json(path_false)


def write_table(df: DataFrame, fmt: str, partitions: int, path: str | None = None, **options: str) -> None:
    """Append to a connector's table through a fixed number of writers."""
    writer = df.repartition(partitions).write.format(fmt).mode("append").options(**options)
    writer.save(path) if path else writer.save()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
