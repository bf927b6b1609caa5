"""Correlations and test statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import cut_lineage
from .ranks import average_ranks
from .skew import salted_join


def pearson(x: str, y: str) -> Column:
    """Correlation aggregate; null when a column is constant. Rows with a null count for neither.

    Constancy is decided by the ends: merged deviations of equal values need not be exactly zero.
    """
    a = F.when(F.col(y).isNotNull(), F.col(x).cast("double"))
    b = F.when(F.col(x).isNotNull(), F.col(y).cast("double"))
    varied = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when(varied, ratio(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b)))


def correlate(df: DataFrame, x: str, y: str) -> DataFrame:
    """Number of points, Pearson r and its square."""
    return df.agg(F.count("*").alias("n"), pearson(x, y).alias("r")).select("n", "r", (F.col("r") * F.col("r")).alias("r2"))


def spearman(df: DataFrame, x: str, others: Sequence[str]) -> DataFrame:
    """Rank correlation of ``x`` with each other column, average ranks for ties.

    Points shrink to distinct pairs with a count; ranks are computed per distinct value, for
    all columns in one pass, and joined on with hot values spread out.
    """
    cells = [
        F.struct(F.lit(y).alias("column"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
        for y in others
    ]
    each = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*").where("_x is not null and _y is not null")
    pairs = cut_lineage(each.groupBy("column", "_x", "_y").agg(F.count("*").alias("_n")))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("_x").alias("value")), F.struct(F.lit(1).alias("side"), F.col("_y").alias("value"))
    )
    values = pairs.select("column", "_n", F.explode(sides).alias("_s")).select("column", "_n", "_s.*")
    ranks = average_ranks(values, ["column", "side"], "value", "_n")
    rx = ranks.where("side = 0").select("column", F.col("value").alias("_x"), F.col("rank").alias("_rx"))
    ry = ranks.where("side = 1").select("column", F.col("value").alias("_y"), F.col("rank").alias("_ry"))
    ranked = salted_join(salted_join(pairs, rx, ["column", "_x"], ["_y"]), ry, ["column", "_y"], ["_x"])
    sizes = pairs.groupBy("column").agg(((F.sum("_n") + 1) / 2.0).alias("_m"))  # one row per column
    dx, dy, n = F.col("_rx") - F.col("_m"), F.col("_ry") - F.col("_m"), F.col("_n")
    return ranked.join(sizes, "column").groupBy("column").agg(
        ratio(F.sum(n * dx * dy), F.sqrt(F.sum(n * dx * dx)) * F.sqrt(F.sum(n * dy * dy))).alias("r")
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Correlation of every pair of columns in long form; nulls drop out pair by pair.

    Each row yields one entry per pair, combined map-side into one line per pair, so the
    aggregate stays small enough for code generation however many columns there are.
    """
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        for a, b in combinations_with_replacement(columns, 2)
    ]
    each = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
    upper = each.groupBy("a", "b").agg((F.round(pearson("x", "y"), digits) + F.lit(0.0)).alias("r"))
    lower = upper.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return upper.unionByName(lower)


def mean_difference(df: DataFrame, group: str, value: str, a: str = "A", b: str = "B") -> DataFrame:
    """Means of two groups and the size of their difference."""
    mean = lambda g: F.avg(F.when(F.col(group) == g, F.col(value)))
    return df.agg(mean(a).alias("mean_a"), mean(b).alias("mean_b")).select(
        "mean_a", "mean_b", F.abs(F.col("mean_a") - F.col("mean_b")).alias("difference")
    )


def chi_squared(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-squared statistic and degrees of freedom of a two-way table.

    Expected counts sum to n, so empty cells are accounted for by ``sum(o*o/e) - n``.
    """
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("_o"))
    rows = cells.groupBy(a).agg(F.sum("_o").alias("_r"))
    cols = cells.groupBy(b).agg(F.sum("_o").alias("_c"))
    total = cells.agg(F.sum("_o")).scalar().cast("double")
    share = F.col("_o").cast("double") * F.col("_o") / (F.col("_r").cast("double") * F.col("_c"))
    found = cells.join(rows, a).join(cols, b).agg(F.sum(share).alias("_s"))
    r, c = rows.agg(F.count("*")).scalar(), cols.agg(F.count("*")).scalar()
    return found.select((total * (F.col("_s") - 1)).alias("chi2"), ((r - 1) * (c - 1)).alias("dof"))
