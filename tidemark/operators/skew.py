"""Joins and broadcasts that stay safe when one key holds much of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20
SALTS = 32


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only after rows and their size as text are seen to be within both bounds.

    Beyond them the plain frame is returned, so the join shuffles instead. The look stops after
    ``max_rows``, but ``df`` should be a stored table or a checkpoint, not a long computation.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).cast("string")
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(F.octet_length(row))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


def widen(df: DataFrame) -> DataFrame:
    """Spread a stored table of fewer splits than the cluster has slots before heavy row work.

    For plain scans only: counting the partitions of anything else would run it.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def over_tasks(df: DataFrame, rows_per_task: int, *keys: str) -> DataFrame:
    """Stored rows over as many tasks as their work asks for, up to the cluster's slots; few rows stay as they are.

    A small file is one split however many rows it holds, and what is computed from it would stay in one task.
    ``keys`` bring rows of a key together, so that grouping by it moves nothing again.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(slots, df.count() // rows_per_task)
    return df.repartition(wanted, *keys) if wanted > df.rdd.getNumPartitions() else df


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> list[int]:
    """Hashes of all keys that hold at least ``share`` of the rows, at most ``1/share`` numbers.

    One pass with a fixed-size summary and no shuffle. Rarer keys may be among them, which
    only costs a few extra copies in a join.
    """
    hashed = df.select(F.xxhash64(*keys).alias("h"))
    return sorted(hashed.stat.freqItems(["h"], share).first()[0] or [])


def salt_of(keys: Sequence[str], hot: list[int], spread: Sequence[str | Column], salts: int = SALTS) -> Column:
    """Salt of a row on the large side: a hash of ``spread`` for hot keys, else 0."""
    zero = F.lit(0).cast("bigint")
    if not hot:
        return zero
    return F.when(F.xxhash64(*keys).isin(hot), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(zero)


def all_salts(keys: Sequence[str], hot: list[int], salts: int = SALTS) -> Column:
    """Array of the salts a row on the small side is needed under."""
    zero, last = F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")
    if not hot:
        return F.array(zero)
    return F.when(F.xxhash64(*keys).isin(hot), F.sequence(zero, last)).otherwise(F.array(zero))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: Sequence[str | Column],
    how: str = "inner",
    salts: int = SALTS,
    share: float = 0.01,
) -> DataFrame:
    """Equi-join that spreads the hot keys of ``big`` over ``salts`` tasks.

    Rows of ``big`` with a hot key get a salt from a hash of ``spread``; matching rows of
    ``small`` are repeated once per salt. ``big`` is read twice, so it should be a stored table
    or a checkpoint. Supports inner, left, left_semi and left_anti.
    """
    on = list(on)
    hot = hot_hashes(big, on, share)
    if not hot:
        return big.join(small, on, how)
    kinds = dict(big.dtypes)
    same = small.withColumns({k: F.col(k).cast(kinds[k]) for k in on})
    left = big.withColumn("_salt", salt_of(on, hot, spread, salts))
    right = same.withColumn("_salt", F.explode(all_salts(on, hot, salts)))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
