"""Bootstrap intervals and permutation tests by counts.

A replicate is drawn from the law of what it needs: two order statistics for a quantile, counts per
distinct value for a mean. No stage holds rows times replicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash, seeded_uniform
from ..functions.numeric import ratio
from ..session import cut_lineage
from .draws import hypergeometric, order_statistics
from .ranks import row_numbers, value_counts_before

PICK_BUCKETS = 4096
BROADCAST_VALUES = 100_000
CUT_EVERY = 4  # levels of splitting between checkpoints


def hash_split(df: DataFrame, keys: list[str], share: float, seed: int, name: str = "part") -> DataFrame:
    """Mark each row ``train`` or ``validation`` by a hash of its key; stable under repartitioning."""
    return df.withColumn(name, F.when(seeded_uniform(seed, *keys) < share, "train").otherwise("validation"))


def hash_folds(df: DataFrame, keys: list[str], folds: int, seed: int, name: str = "fold") -> DataFrame:
    return df.withColumn(name, (seeded_hash(seed, *keys) % folds).cast("int"))


def _at_positions(ranked: DataFrame, value: str, picks: DataFrame, n: int) -> DataFrame:
    """Picks ``(rep, which, position)`` with the value that stands at their position of the sorted rows.

    ``ranked`` holds distinct values with their rows ``n`` and the rows ``before`` them. Both sides are cut
    into ranges of positions, so they meet on equal keys; a value meets each range it spans once.
    """
    bucket = lambda c: F.floor(c.cast("double") * F.lit(PICK_BUCKETS / n)).cast("int")
    spans = ranked.withColumn("_b", F.explode(F.sequence(bucket(F.col("before")), bucket(F.col("before") + F.col("n") - 1))))
    wanted = F.broadcast(picks.withColumn("_b", bucket(F.col("position"))))  # two rows a replicate
    met = spans.join(wanted, "_b").where((F.col("position") >= F.col("before")) & (F.col("position") < F.col("before") + F.col("n")))
    return met.select("rep", "which", F.col(value).cast("double").alias("v"))


def bootstrap_ci(
    df: DataFrame, value: str, reps: int = 1000, confidence: float = 0.95, seed: int = 1, prob: float = 0.5
) -> DataFrame:
    """Quantile of a column with its basic bootstrap interval.

    A replicate's quantile lies between two neighbouring order statistics of n draws. Their positions come
    from the law of order statistics, so the work is ``reps`` draws and one ranking of the distinct values.
    """
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias(value))
    n = known.count()
    if n == 0:
        raise ValueError(f"{value} has no values to resample")
    at = (n - 1) * prob
    lo, hi = int(at), min(int(at) + 1, n - 1)
    spark = df.sparkSession
    drawn = order_statistics(spark.range(reps).select(F.col("id").alias("rep")), "rep", n, lo, hi, seed)
    # replicate -1 is the sample itself
    own = spark.range(1).select(F.lit(-1).cast("bigint").alias("rep"), F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi"))
    picks = cut_lineage(drawn.unionByName(own)).select("rep", F.explode(F.array(
        F.struct(F.lit("lo").alias("which"), F.col("lo").alias("position")), F.struct(F.lit("hi").alias("which"), F.col("hi").alias("position"))
    )).alias("_p")).select("rep", "_p.*")
    values = _at_positions(value_counts_before(known, [], value), value, picks, n)
    ends = values.groupBy("rep").agg(F.max(F.when(F.col("which") == "lo", F.col("v"))).alias("a"), F.max(F.when(F.col("which") == "hi", F.col("v"))).alias("b"))
    stats = cut_lineage(ends.select("rep", (F.col("a") + (F.col("b") - F.col("a")) * (at - lo)).alias("stat")))
    observed = F.lit(stats.where("rep = -1").first()["stat"])
    tail = (1 - confidence) / 2
    # one number per replicate
    ends = stats.where("rep >= 0").agg(F.percentile(F.col("stat") - observed, F.array(F.lit(tail), F.lit(1 - tail))).alias("d"))
    return ends.select(observed.alias("stat"), (observed - F.col("d")[1]).alias("lo"), (observed - F.col("d")[0]).alias("hi"))


def chosen_sums(counts: DataFrame, value: str, size: int, reps: int, seed: int) -> DataFrame:
    """``(rep, s)``: sums of ``size`` rows chosen without replacement from distinct values with counts ``n``.

    The number chosen is split down a binary tree over the ordered values: at each node a hypergeometric draw says
    how many fall to the left. Work is ``reps`` times distinct values at most; nodes that get nothing end there.
    """
    spark = counts.sparkSession
    numbered = cut_lineage(row_numbers(counts.select(value, "n"), value, name="i"))
    n_values = numbered.count()
    height = max(0, n_values - 1).bit_length()
    # three numbers a value: at most a few MB go to every task, larger trees are joined by shuffle
    sent = F.broadcast if n_values <= BROADCAST_VALUES else lambda sizes: sizes
    level = spark.range(reps).select(F.col("id").alias("rep"), F.lit(0).cast("bigint").alias("j"), F.lit(size).cast("bigint").alias("c"))
    for h in range(height, 0, -1):
        sizes = numbered.groupBy(F.shiftright("i", h).alias("j")).agg(
            F.sum("n").alias("total"), F.sum(F.when(F.shiftright("i", h - 1) % 2 == 0, F.col("n")).otherwise(0)).alias("left")
        )
        split = hypergeometric(level.join(sent(sizes), "j"), "total", "left", "c", "got", seed, "rep", F.lit(h), "j")
        sides = F.array(
            F.struct((F.col("j") * 2).alias("j"), F.col("got").alias("c")), F.struct((F.col("j") * 2 + 1).alias("j"), (F.col("c") - F.col("got")).alias("c"))
        )
        level = split.select("rep", F.explode(sides).alias("_s")).select("rep", "_s.*").where("c > 0")
        if h % CUT_EVERY == 1:
            level = cut_lineage(level)
    leaves = level.join(sent(numbered.select(F.col("i").alias("j"), F.col(value).alias("v"))), "j")
    return leaves.groupBy("rep").agg(F.sum(F.col("c") * F.col("v")).alias("s"))


def permutation_test(df: DataFrame, group: str, value: str, reps: int = 10_000, seed: int = 1, a: str = "A") -> DataFrame:
    """Share of random relabellings whose mean difference exceeds the observed one in size.

    A relabelling's mean depends only on how many rows of each distinct value form group A, and these counts
    are drawn (``chosen_sums``). Rows with a null value or group count for neither group.
    """
    rows = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select((F.col(group) == a).alias("_a"), F.col(value).cast("double").alias("v"))
    counts = cut_lineage(rows.groupBy("v").agg(F.count("*").alias("n"), F.count_if("_a").alias("n_a")))
    size = counts.agg(
        F.sum("n_a").alias("na"), F.sum(F.col("n") - F.col("n_a")).alias("nb"), F.sum(F.col("v") * F.col("n")).alias("total"),
        F.sum(F.col("v") * F.col("n_a")).alias("sum_a"),
    ).first()
    na, nb, total = size["na"] or 0, size["nb"] or 0, size["total"] or 0.0
    # |mean_a - mean_b| * na * nb, exact for whole numbers
    spread = lambda s: F.abs(s * F.lit(float(nb)) - (F.lit(total) - s) * F.lit(float(na)))
    observed = spread(F.lit(size["sum_a"] or 0.0))
    sums = chosen_sums(counts, "v", na, reps, seed)
    return sums.agg(F.count_if(spread(F.col("s")) > observed).alias("n_above")).select(
        ratio(observed, F.lit(float(na) * nb)).alias("observed"), "n_above",
        (F.col("n_above") / F.lit(float(reps))).alias("p_value"),
    )
