"""Lazy access to the given tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``tables.orders`` reads ``orders.parquet`` of the folder; columns are pruned by the plan."""

    NAMES = frozenset(
        "region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations".split()
    )

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"
