"""Readers: files with a fixed schema, connector tables, views and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: str | StructType, **options: str) -> DataFrame:
    """Delimited text; pass ``sep=' '`` and ``quote=''`` for space-separated page counts."""
    return spark.read.schema(schema).options(**options).csv(path)


def with_source_file(df: DataFrame, name: str = "filename") -> DataFrame:
    """Add the path of the file each row came from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_table(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """A connector's table; the format name is passed through (parquet, cassandra, mongo, ...)."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def register_view(spark: SparkSession, name: str, fmt: str, options: dict[str, str]) -> DataFrame:
    """Register a connector's table as a SQL view and return it."""
    read_table(spark, fmt, **options).createOrReplaceTempView(name)
    return spark.table(name)


def read_stream(
    spark: SparkSession, fmt: str, path: str | None = None, schema: str | None = None, **options: str
) -> DataFrame:
    """Unbounded input; a binary ``value`` column is cast to text, as message queues deliver it."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    if dict(stream.dtypes).get("value") == "binary":
        stream = stream.withColumn("value", F.col("value").cast("string"))
    return stream


def grid(spark: SparkSession, axes: dict[str, tuple[float, float, int]]) -> DataFrame:
    """Every combination of evenly spaced axis values, ends included.

    One distributed range is decomposed into axis positions, so no cross join is planned.
    """
    total = reduce(lambda a, b: a * b, (n for _, _, n in axes.values()), 1)
    rest, columns = F.col("id"), []
    for name, (lo, hi, n) in reversed(axes.items()):
        step = (hi - lo) / (n - 1) if n > 1 else 0.0
        columns.append((F.lit(float(lo)) + F.pmod(rest, F.lit(n)) * F.lit(step)).alias(name))
        rest = F.floor(rest / F.lit(n))
    return spark.range(total).select(*reversed(columns))
