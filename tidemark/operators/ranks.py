"""Exact ranks, row numbers and quantiles without one task per group.

A window over a whole group would put a hot group into one task. Ranks are taken inside ranges of
the order, whose totals supply the offsets. Quantiles are selected by narrowing value ranges: exact
counts tell which part of a range holds a wanted row, and only that part is looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import salted_join

FITS = 4096  # distinct values of a range that is searched directly
FAN = 256  # equal parts of a range that is narrowed


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str | Column, name: str = "before") -> DataFrame:
    """Add the sum of ``weight`` over all rows that come earlier in the key's order.

    ``order`` must be unique within a key. Rows are dealt by ranges of key and order together, so
    a hot key covers many ranges; each range is summed in its own task and adds what the ranges
    before it hold of the key, one number per key and range.
    """
    keys, order = list(keys), list(order)
    weight = F.col(weight) if isinstance(weight, str) else weight
    ranged = df.withColumn("_w", weight).repartitionByRange(*keys, *order)
    placed = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy(*keys, "_range").agg(F.sum("_w").alias("_t"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_t").over(earlier), F.lit(0))).drop("_t")
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    offsets = offsets.withColumnsRenamed({k: f"_k_{k}" for k in keys} | {"_range": "_r"})
    return (
        placed.withColumn("_in", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
        .join(offsets, (F.col("_range") == F.col("_r")) & same)
        .withColumn(name, F.col("_offset") + F.col("_in"))
        .drop("_range", "_r", "_w", "_in", "_offset", *[f"_k_{k}" for k in keys])
    )


def value_counts_before(df: DataFrame, keys: Sequence[str], value: str, weight: str | Column | None = None) -> DataFrame:
    """Per key and distinct value: ``n`` rows and ``before``, the rows with a smaller value."""
    weight = F.lit(1).cast("bigint") if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("n"))
    return running_totals(counts, keys, [value], "n")


def row_numbers(df: DataFrame, order: str, keys: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Zero-based row number along a unique ``order`` column."""
    return running_totals(df, keys, [order], F.lit(1).cast("bigint"), name)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Distinct values per key with their one-based average rank (ties share the mean rank)."""
    ranked = value_counts_before(df, keys, value, weight)
    return ranked.select(*keys, value, "n", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))


def text_row_numbers(df: DataFrame, order: str, name: str = "rn") -> DataFrame:
    """Zero-based row number along a unique text column, by ranges of the full values.

    Each range is sorted in its own task and adds the rows of the ranges before it, one number a range.
    """
    ranged = df.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    placed = cut_lineage(ranged.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    counts = placed.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = counts.select("_p", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_p")
    return numbered.withColumn(name, F.col("_i") - F.col("_first") + F.col("_before")).drop("_p", "_i", "_first", "_before")


def _magnitude(v: Column) -> Column:
    """Sign and power of two of a double as one number that does not fall as the value rises."""
    power = lambda x: F.floor(F.log2(x)) + 4000  # positive for every double
    return (
        F.when(F.isnan(v), 9000).when(v == float("inf"), 8000).when(v == float("-inf"), -8000)
        .when(v > 0, power(v)).when(v < 0, -power(-v)).otherwise(0).cast("int")
    )


def _part(v: Column, lo: Column, hi: Column, fan: int) -> Column:
    """Which of ``fan`` equal parts of a finite range of one sign a value is in; its ends are never in one part."""
    return F.least(F.lit(fan - 1), F.floor((v - lo) / (hi - lo) * fan)).cast("int")


def _narrowed(points: DataFrame, ranges: DataFrame, cut: list[str], part: Column, fits: int) -> tuple[DataFrame, DataFrame]:
    """Points of the parts that hold a wanted row, and those parts as the new ranges.

    A range is named by its smallest value. Its parts are at most some thousands, whatever it holds.
    """
    parted = points.withColumn("_part", part).select(*cut, "_part", "_v", "_n")
    parts = parted.groupBy(*cut, "_part").agg(
        F.sum("_n").alias("_rows"), (F.count("*") > fits).alias("_wide"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    earlier = Window.partitionBy(*cut).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.join(ranges.select(*cut, "_before", "_wanted"), cut).withColumn(
        "_before", F.col("_before") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    )
    inside = F.filter("_wanted", lambda w: (w >= F.col("_before")) & (w < F.col("_before") + F.col("_rows")))
    kept = cut_lineage(placed.withColumn("_wanted", inside).where(F.size("_wanted") > 0))
    found = salted_join(parted, kept.select(*cut, "_part", "_wide", "_lo", "_hi"), [*cut, "_part"], ["_v"])
    renamed = lambda df: df.withColumn("_range", F.col("_lo")).drop("_part")
    return cut_lineage(renamed(found)), renamed(kept)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], weight: str | Column | None = None,
    fits: int = FITS, fan: int = FAN,
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column per name in ``probs``; keys without a value are left out.

    Selection by narrowing: the table shrinks to distinct values with counts. A range of more than
    ``fits`` of them is cut, first by sign and power of two and then into ``fan`` equal parts, and
    exact counts tell which parts hold the rows wanted. Only these are kept for the next round. A power of
    two holds 2**52 doubles, so with the usual ``fan`` seven more rounds end it for any table. Ranges
    that fit are then searched in order, none of them larger than ``fits``.
    """
    amount = F.lit(1).cast("bigint") if weight is None else (F.col(weight) if isinstance(weight, str) else weight).cast("bigint")
    # keys are held in structs, so that a null key equals itself
    names = {f"_key{i}": F.struct(F.col(k).alias("k")) for i, k in enumerate(keys)} or {"_key": F.struct(F.lit(0).alias("k"))}
    rows = df.where(F.col(value).isNotNull()).select(*[c.alias(n) for n, c in names.items()], F.col(value).cast("double").alias("_v"), amount.alias("_n"))
    points = cut_lineage(rows.groupBy(*names, "_v").agg(F.sum("_n").alias("_n")).where("_n > 0"))
    sizes = cut_lineage(points.groupBy(*names).agg(F.sum("_n").alias("_size"), (F.count("*") > fits).alias("_wide")))
    places = {n: (F.col("_size") - 1) * F.lit(float(p)) for n, p in probs.items()}
    ends = [e(p).cast("bigint") for p in places.values() for e in (F.floor, F.ceil)]

    cut, first = [*names, "_range"], F.lit(0.0)  # to begin with, a key is one range
    ranges = sizes.select(*names, first.alias("_range"), "_wide", F.lit(0).cast("bigint").alias("_before"), F.array_distinct(F.array(*ends)).alias("_wanted"))
    points, part, settled = points.withColumn("_range", first), _magnitude(F.col("_v")), []
    if not sizes.where("_wide").isEmpty():
        points = cut_lineage(salted_join(points, sizes.select(*names, "_wide"), list(names), ["_v"]))
        while not ranges.where("_wide").isEmpty():
            settled.append((points.where("not _wide"), ranges.where("not _wide")))
            points, ranges = _narrowed(points.where("_wide"), ranges.where("_wide"), cut, part, fits)
            part = F.when(F.col("_hi") > F.col("_lo"), _part(F.col("_v"), F.col("_lo"), F.col("_hi"), fan)).otherwise(0)
    settled.append((points, ranges))

    order = Window.partitionBy(*cut).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)  # at most ``fits`` rows
    hits = None
    for found, where in settled:
        numbered = found.select(*cut, "_v", "_n").withColumn("_in", F.coalesce(F.sum("_n").over(order), F.lit(0)))
        start = F.col("_before") + F.col("_in")
        inside = F.filter("_wanted", lambda w: (w >= start) & (w < start + F.col("_n")))
        one = numbered.join(where.select(*cut, "_before", "_wanted"), cut).select(*names, "_v", F.explode(inside).alias("_at"))
        hits = one if hits is None else hits.unionByName(one)
    # per key only the values at the wanted rows
    at = hits.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("_at", "_v"))).alias("_values")).join(sizes, list(names))
    picks = []
    for n, place in places.items():
        lo, hi = (F.try_element_at("_values", e(place).cast("bigint")) for e in (F.floor, F.ceil))
        picks.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place - F.floor(place))).alias(n))
    return at.select(*[F.col(n)["k"].alias(k) for n, k in zip(names, keys)], *picks)
