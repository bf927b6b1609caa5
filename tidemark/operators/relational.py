"""Filters, joins and group results on logs, comments, weather, page views and orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numeric import ratio
from ..session import cut_lineage
from .skew import broadcast_if_small, salted_join

# Weather observation kinds and the page titles that do not count.
TMAX, TMIN = "TMAX", "TMIN"
DULL_TITLES = ("Main_Page", "Special:")


# -- parsing -----------------------------------------------------------------------------


def parse_access_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Web log lines as host, datetime, path, bytes; lines of another form vanish."""
    fields = text.extract_groups(value, text.ACCESS_LOG, ["host", "_time", "path", "_bytes"])
    return (
        lines.where(F.col(value).rlike(text.ACCESS_LOG))
        .select(*fields)
        .select("host", text.parse_log_time("_time").alias("datetime"), "path", F.col("_bytes").cast("bigint").alias("bytes"))
    )


def parse_pageviews(lines: DataFrame, value: str = "value") -> DataFrame:
    """Space-separated ``hour language title views bytes`` lines."""
    part = F.split(F.col(value), " ")
    return lines.select(
        F.try_element_at(part, F.lit(1)).alias("hour"),
        F.try_element_at(part, F.lit(2)).alias("language"),
        F.try_element_at(part, F.lit(3)).alias("title"),
        F.try_element_at(part, F.lit(4)).try_cast("int").alias("views"),
    )


def parse_json(df: DataFrame, column: str, schema: str, keep: Sequence[str]) -> DataFrame:
    """Typed fields of a JSON text column next to the kept columns."""
    return df.select(*keep, F.from_json(F.col(column), schema).alias("_j")).select(*keep, "_j.*")


def word_count(lines: DataFrame, value: str = "value") -> DataFrame:
    """Occurrences of every lower-case word, sorted by word."""
    each = lines.select(F.explode(text.words(value)).alias("word")).where(F.col("word") != "")
    return each.groupBy("word").agg(F.count("*").alias("n")).orderBy("word")


# -- projections ---------------------------------------------------------------------------


def cast_columns(df: DataFrame, columns: Sequence[str], to: str = "int") -> DataFrame:
    """Cast text columns; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns})


def drop_and_fill(df: DataFrame, required: Sequence[str], fill: Mapping[str, object]) -> DataFrame:
    """Drop rows lacking a required column and fill the nulls of others."""
    return df.dropna(subset=list(required)).fillna(dict(fill))


def recode(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Replace values through a two-column mapping table; unmapped values are kept."""
    pairs = mapping.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    joined = df.join(broadcast_if_small(pairs), F.col(column) == F.col("_from"), "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def first_band(value: str | Column, edges: Sequence[tuple[float, float]]) -> Column:
    """One-based number of the first closed range holding the value, else 0."""
    column = F.col(value) if isinstance(value, str) else value
    bands = [F.when(column.between(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(edges, 1)]
    return F.coalesce(*bands, F.lit(0))


def with_uuid(df: DataFrame, name: str = "id") -> DataFrame:
    """Add a random unique identifier."""
    return df.withColumn(name, F.uuid())


def head_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, score: str, tie: str, k: int, ascending: bool = False) -> DataFrame:
    """k best rows by score, ties by the smaller key."""
    return df.orderBy(F.col(score).asc() if ascending else F.col(score).desc(), F.col(tie).asc()).limit(k)


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def enrich(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Inner join with a lookup table, broadcast when it is seen to be small."""
    return df.join(broadcast_if_small(dim), F.col(key) == F.col(dim_key)).drop(dim_key)


# -- groups -----------------------------------------------------------------------------------


def group_avg(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


def argmax_ties(df: DataFrame, keys: Sequence[str], value: str, broadcast: bool = False) -> DataFrame:
    """Rows that reach their group's maximum, all ties kept.

    The maxima are combined before the shuffle and joined back on keys and value, so rows of a
    hot group spread over the join by their values; no task sees a whole group.
    """
    keys = list(keys)
    best = df.groupBy(*keys).agg(F.max(value).alias(value))
    if broadcast:
        best = broadcast_if_small(cut_lineage(best))
    return df.join(best, [*keys, value])


def argmax_ties_sql(df: DataFrame, keys: Sequence[str], value: str, max_bytes: int = 8 << 20) -> DataFrame:
    """``argmax_ties`` as a SQL statement; the broadcast hint stands in it only where the maxima are seen to be small.

    A group's row is taken as 64 bytes and its keys' text.
    """
    spark, names = df.sparkSession, ", ".join(f"`{k}`" for k in keys)
    best = cut_lineage(spark.sql(f"SELECT {names}, max(`{value}`) AS `{value}` FROM {{rows}} GROUP BY {names}", rows=df))
    wide = F.sum(F.lit(64) + F.coalesce(F.octet_length(F.concat_ws("", *[F.col(k).cast("string") for k in keys])), F.lit(0)))
    small = (best.agg(wide).first()[0] or 0) <= max_bytes
    hint = "/*+ BROADCAST(best) */ " if small else ""
    return spark.sql(f"SELECT {hint}r.* FROM {{rows}} AS r JOIN {{best}} AS best USING ({names}, `{value}`)", rows=df, best=best).select(*df.columns)


def requests_per_host(log: DataFrame) -> DataFrame:
    return log.groupBy("host").agg(F.count("*").alias("n_requests"), F.sum("bytes").alias("sum_bytes"))


def not_dull(title: str | Column) -> Column:
    column = F.col(title) if isinstance(title, str) else title
    keep = F.lit(True)
    for prefix in DULL_TITLES:
        keep = keep & ~column.startswith(prefix)
    return keep


def popular_pages(views: DataFrame, language: str = "en", broadcast: bool = True) -> DataFrame:
    """Most viewed titles of each hour, ties kept."""
    wanted = views.where((F.col("language") == language) & not_dull("title")).select("hour", "title", "views")
    return argmax_ties(wanted, ["hour"], "views", broadcast).select("hour", "title", F.col("views").alias("max_views"))


def top_page_per_hour(views: DataFrame, language: str = "en") -> DataFrame:
    """One most viewed title per hour; the greatest title wins a tie."""
    wanted = views.where((F.col("language") == language) & not_dull("title"))
    best = wanted.groupBy("hour").agg(F.max(F.struct("views", "title")).alias("_b"))
    return best.select("hour", F.col("_b.title").alias("title"), F.col("_b.views").alias("views")).orderBy("hour")


def relative_scores(comments: DataFrame, broadcast: bool = False) -> DataFrame:
    """Best score of each author relative to the average of the group it was written in.

    Only groups with a positive average count, so the best ratio in a group comes from the
    author's best score there: comments shrink to one row per (group, author) before the join.
    """
    averages = group_avg(comments, "subreddit", "score", "_avg").where(F.col("_avg") > 0)
    best = comments.groupBy("subreddit", "author").agg(F.max("score").alias("score"))
    if broadcast:
        joined = best.join(broadcast_if_small(cut_lineage(averages)), "subreddit")
    else:
        joined = salted_join(cut_lineage(best), averages, ["subreddit"], ["author"])
    scores = joined.select("author", (F.col("score") / F.col("_avg")).alias("_r"))
    return scores.groupBy("author").agg(F.max("_r").alias("max_rel_score"))


def split_comments(comments: DataFrame, part: str = "e") -> DataFrame:
    """Comments of groups whose name holds ``part``, marked by the sign of their score."""
    sign = F.when(F.col("score") > 0, "positive").otherwise("negative")
    return comments.where(F.col("subreddit").contains(part)).select("subreddit", "score", "author", sign.alias("sign"))


# -- weather ----------------------------------------------------------------------------------


def weather_etl(observations: DataFrame, prefix: str) -> DataFrame:
    """Good daily maxima of stations with a prefix, in degrees."""
    good = observations.where(
        F.col("qflag").isNull() & F.col("station").startswith(prefix) & (F.col("observation") == TMAX)
    )
    return good.select("station", "date", (F.col("value") / 10.0).alias("tmax"))


def temp_ranges(observations: DataFrame) -> DataFrame:
    """Station and day with high minus low in tenths; repeated readings multiply."""
    good = observations.where(F.col("qflag").isNull())
    high = good.where(F.col("observation") == TMAX).select("station", "date", F.col("value").alias("_hi"))
    low = good.where(F.col("observation") == TMIN).select("station", "date", F.col("value").alias("_lo"))
    return high.join(low, ["station", "date"]).select("date", "station", (F.col("_hi") - F.col("_lo")).alias("_range"))


def largest_range(observations: DataFrame, broadcast: bool = False) -> DataFrame:
    """Per day the stations with the largest range, ties kept.

    Gives the rows of the largest ``temp_ranges`` without pairing repeated readings: a station's
    largest range is its highest minus its lowest reading, once per repeat of either.
    """
    good = observations.where(F.col("qflag").isNull() & F.col("observation").isin(TMAX, TMIN) & F.col("value").isNotNull())
    counts = good.groupBy("station", "date", "observation", "value").agg(F.count("*").alias("_n"))
    reading = F.struct("value", "_n")
    ends = counts.groupBy("station", "date").agg(
        F.max(F.when(F.col("observation") == TMAX, reading)).alias("_hi"), F.min(F.when(F.col("observation") == TMIN, reading)).alias("_lo")
    ).where("_hi is not null and _lo is not null")
    ranges = ends.select(
        "date", "station", (F.col("_hi.value") - F.col("_lo.value")).alias("_range"), (F.col("_hi._n") * F.col("_lo._n")).alias("_n")
    )
    best = argmax_ties(ranges, ["date"], "_range", broadcast)
    best = best.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return best.select("date", "station", F.round(F.col("_range") / 10.0, 2).alias("range")).orderBy("date", "station")


def with_previous_day(daily: DataFrame) -> DataFrame:
    """Each station day with its maximum and that of the day before; gaps drop the row."""
    before = daily.select("station", F.date_add("date", 1).alias("date"), F.col("tmax").alias("yesterday_tmax"))
    return daily.join(before, ["station", "date"]).select(
        "station", "date", "latitude", "longitude", "elevation",
        F.dayofyear("date").cast("bigint").alias("dy"), "yesterday_tmax", "tmax",
    )


def station_period(daily: DataFrame, period: str = "month") -> DataFrame:
    """Repeated readings of a station within a period: highest and mean maximum."""
    start = F.date_trunc(period, F.col("date")).cast("date")
    return daily.groupBy("station", start.alias(period)).agg(
        F.max("tmax").alias("max_tmax"), F.avg("tmax").alias("avg_tmax")
    )


# -- orders ------------------------------------------------------------------------------------


def part_names(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Distinct part names of each order as one sorted, joined text."""
    lines = lineitem.select("l_orderkey", "l_partkey")
    named = lines.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return named.groupBy("l_orderkey").agg(text.join_sorted(F.collect_set("p_name")).alias("part_names"))


def orders_parts(
    orders: DataFrame, lineitem: DataFrame, part: DataFrame, keys: Sequence[int] | None = None,
    columns: Sequence[str] = ("o_orderkey", "o_totalprice"),
) -> DataFrame:
    """Orders with the names of their parts; ``keys`` limits the orders through an IN list."""
    if keys is not None:
        orders = orders.where(F.col("o_orderkey").isin(list(keys)))
        lineitem = lineitem.where(F.col("l_orderkey").isin(list(keys)))
    names = part_names(lineitem, part)
    return orders.select(*columns).join(names, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


def orders_lines(orders_with_parts: DataFrame) -> DataFrame:
    return orders_with_parts.select(text.order_line("o_orderkey", "o_totalprice", "part_names").alias("line"))


# -- pair sets -----------------------------------------------------------------------------------


def evaluate_pairs(result: DataFrame, truth: DataFrame, on: Sequence[str] = ("id1", "id2"), weight: str | None = None) -> DataFrame:
    """Precision, recall and F of one set of pairs against another; null where undefined.

    ``weight`` names a column with the number of record pairs a row stands for.
    """
    on = list(on)
    mine = result.groupBy(*on).agg((F.max(weight) if weight else F.lit(1).cast("bigint")).alias("_f"))
    real = truth.groupBy(*on).agg((F.max(weight) if weight else F.lit(1).cast("bigint")).alias("_t"))
    sums = mine.join(real, on, "full").agg(
        F.sum(F.when(F.col("_f").isNotNull() & F.col("_t").isNotNull(), F.least("_f", "_t"))).alias("_both"),
        F.sum("_f").alias("_found"),
        F.sum("_t").alias("_true"),
    ).select(*[F.coalesce(c, F.lit(0)).alias(c) for c in ("_both", "_found", "_true")])
    precision, recall = ratio(F.col("_both"), F.col("_found")), ratio(F.col("_both"), F.col("_true"))
    return sums.select(precision.alias("precision"), recall.alias("recall")).select(
        "precision", "recall",
        ratio(F.col("precision") * F.col("recall") * 2, F.col("precision") + F.col("recall")).alias("fmeasure"),
    )
