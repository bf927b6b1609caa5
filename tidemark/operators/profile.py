"""Column profiles: counts, bins, quantiles and summaries behind exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import equal_bin
from .ranks import exact_quantiles


def unpivot(df: DataFrame, columns: Sequence[str], to: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long form: one ``(column, value)`` row per kept row and column."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(to).alias("value")) for c in columns]
    return df.select(*keep, F.explode(F.array(*cells)).alias("_c")).select(*keep, "_c.*")


def year_counts(df: DataFrame, year: str, lo: int, hi: int, inclusive: bool = True) -> DataFrame:
    """Rows per year within a range, its ends counted or not."""
    y = F.col(year)
    inside = y.between(lo, hi) if inclusive else (y > lo) & (y < hi)
    return df.where(inside).groupBy(year).agg(F.count("*").alias("n"))


def busy(counts: DataFrame, more_than: int) -> DataFrame:
    return counts.where(F.col("n") > more_than)


def missing_pct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of null values per column in percent, from one pass."""
    shares = [F.round(F.avg(F.col(c).isNull().cast("int")) * 100, 2).alias(c) for c in columns]
    return unpivot(df.agg(*shares), columns, "double").withColumnRenamed("value", "missing_pct")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count of each value of each column, stacked."""
    return unpivot(df, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    cells = unpivot(df, columns, "double")
    basics = cells.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(cells, ["column"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return basics.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def group_percentiles(df: DataFrame, key: str, value: str, percents: Sequence[int] = (25, 50, 75)) -> DataFrame:
    """Linearly interpolated percentiles of a value per group, side by side."""
    return exact_quantiles(df, [key], value, {f"p{p}": p / 100 for p in percents})


def median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = unpivot(df, columns, "double")
    return exact_quantiles(cells, ["column"], "value", {"median": 0.5})


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal bins from minimum to maximum, empty bins included."""
    ends = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    counts = df.groupBy(equal_bin(F.col(column).cast("double"), lo, hi, bins).alias("bin")).agg(F.count("*").alias("_n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(bins)
    return every.join(counts.where("bin is not null"), "bin", "left").select(
        "bin", (lo + width * (F.col("bin") - 1)).alias("lo"), (lo + width * F.col("bin")).alias("hi"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def bin2d(df: DataFrame, x: str, y: str, nx: int, ny: int) -> DataFrame:
    """Counts in a grid of equal cells; empty cells are left out."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y))
    e = both.agg(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))).scalar()
    return both.groupBy(
        equal_bin(x, e["x0"], e["x1"], nx).alias("bx"), equal_bin(y, e["y0"], e["y1"], ny).alias("by")
    ).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two-way counts with totals. ``level`` tells totals from null labels: 1 sums over ``b``, 2 over ``a``, 3 over both."""
    return df.cube(a, b).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))
