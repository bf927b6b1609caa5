"""Queries on orders, logs, comments, weather, page views and text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, text
from ..functions.numeric import rounded
from ..operators import relational as rel
from ..operators.skew import widen
from . import standins as si
from .registry import query
from .tables import Tables

PARTS_SQL = """
    select l_orderkey, string_agg(distinct p_name, ', ' order by p_name) as part_names
    from lineitem join part on l_partkey = p_partkey group by l_orderkey"""


@query("orders_parts", f"""
    select o_orderkey, o_totalprice, part_names from orders join ({PARTS_SQL}) on l_orderkey = o_orderkey""")
def orders_parts(t: Tables) -> DataFrame:
    return rel.orders_parts(t.orders, t.lineitem, t.part)


@query("orders_lines", f"""
    select printf('Order #%d $%.2f: %s', o_orderkey, o_totalprice, part_names) as line
    from orders join ({PARTS_SQL}) on l_orderkey = o_orderkey""")
def orders_lines(t: Tables) -> DataFrame:
    return rel.orders_lines(rel.orders_parts(t.orders, t.lineitem, t.part))


@query("orders_denorm", f"""
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, part_names
    from orders join ({PARTS_SQL}) on l_orderkey = o_orderkey""")
def orders_denorm(t: Tables) -> DataFrame:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return rel.orders_parts(t.orders, t.lineitem, t.part, columns=columns)


@query("word_count", r"""
    select word, count(*) as n
    from (select unnest(regexp_split_to_array(lower(text), '[!-/:-@\[-`{-~\s]+')) as word from documents)
    where word <> '' group by word""")
def word_count(t: Tables) -> DataFrame:
    return rel.word_count(widen(t.documents.select("text")), "text")


@query("parse_logs", "select host, datetime, path, bytes from access_log", ("access_log",))
def parse_logs(t: Tables) -> DataFrame:
    return rel.parse_access_log(si.log_lines(t))


@query("requests_per_host", """
    select host, count(*) as n_requests, sum(bytes)::bigint as sum_bytes from access_log group by host""", ("access_log",))
def requests_per_host(t: Tables) -> DataFrame:
    return rel.requests_per_host(rel.parse_access_log(si.log_lines(t)))


@query("pageviews_parse", "select hour, language, title, views from pageviews", ("pageviews",))
def pageviews_parse(t: Tables) -> DataFrame:
    lines = si.pageviews(t).select(F.concat_ws(" ", "hour", "language", "title", "views", F.lit("0")).alias("value"))
    return rel.parse_pageviews(lines)


@query("top_page", """
    select hour, max(title) as title, max(views) as views
    from (select *, max(views) over (partition by hour) as m from pageviews where language = 'en')
    where views = m group by hour""", ("pageviews",))
def top_page(t: Tables) -> DataFrame:
    return rel.top_page_per_hour(si.pageviews(t))


@query("popular_pages", """
    select hour, title, views as max_views
    from (select *, max(views) over (partition by hour) as m from pageviews where language = 'en')
    where views = m""", ("pageviews",))
def popular_pages(t: Tables) -> DataFrame:
    return rel.popular_pages(si.pageviews(t))


@query("average_score", """
    select subreddit, round(avg(score), 6) as average_score from comments group by subreddit""", ("comments",))
def average_score(t: Tables) -> DataFrame:
    means = rel.group_avg(si.comments(t), "subreddit", "score", "average_score")
    return means.select("subreddit", rounded(F.col("average_score")).alias("average_score"))


@query("comment_split", """
    select subreddit, score, author, case when score > 0 then 'positive' else 'negative' end as sign
    from comments where contains(subreddit, 'e')""", ("comments",))
def comment_split(t: Tables) -> DataFrame:
    return rel.split_comments(si.comments(t))


RELATIVE_SQL = """
    select author, round(max(score / average), 6) as max_rel_score
    from comments join (select subreddit as s, avg(score) as average from comments group by 1 having avg(score) > 0)
         on s = subreddit group by author"""


@query("relative_score", RELATIVE_SQL, ("comments",))
def relative_score(t: Tables) -> DataFrame:
    scores = rel.relative_scores(si.comments(t))
    return scores.select("author", rounded(F.col("max_rel_score")).alias("max_rel_score"))


@query("relative_score_bcast", RELATIVE_SQL, ("comments",))
def relative_score_bcast(t: Tables) -> DataFrame:
    scores = rel.relative_scores(si.comments(t), broadcast=True)
    return scores.select("author", rounded(F.col("max_rel_score")).alias("max_rel_score"))


@query("props_parse", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def props_parse(t: Tables) -> DataFrame:
    return rel.parse_json(t.events, "props", "k bigint", ["event_id"])


@query("weather_etl", """
    select station, date, value / 10.0::double as tmax from observations
    where qflag is null and observation = 'TMAX' and starts_with(station, '1')""", ("observations",))
def weather_etl(t: Tables) -> DataFrame:
    return rel.weather_etl(si.observations(t), "1")


@query("temp_range", """
    select date, station, round(r / 10.0::double, 2) as range
    from (select h.date, h.station, h.value - l.value as r, max(h.value - l.value) over (partition by h.date) as m
          from observations h join observations l using (station, date)
          where h.observation = 'TMAX' and l.observation = 'TMIN' and h.qflag is null and l.qflag is null)
    where r = m""", ("observations",))
def temp_range(t: Tables) -> DataFrame:
    return rel.largest_range(si.observations(t))


@query("previous_day", """
    select a.station, a.date, a.latitude, a.longitude, a.elevation, dayofyear(a.date) as dy,
           b.tmax as yesterday_tmax, a.tmax
    from daily_max a join daily_max b on a.station = b.station and b.date = a.date - 1""", ("daily_max",))
def previous_day(t: Tables) -> DataFrame:
    return rel.with_previous_day(si.daily_max(t))


@query("station_period", """
    select station, cast(date_trunc('month', date) as date) as month, max(tmax) as max_tmax, round(avg(tmax), 6) as avg_tmax
    from daily_max group by 1, 2""", ("daily_max",))
def station_period(t: Tables) -> DataFrame:
    months = rel.station_period(si.daily_max(t))
    return months.withColumn("avg_tmax", rounded(F.col("avg_tmax")))


@query("with_uuid")
def with_uuid(t: Tables) -> DataFrame:
    return rel.with_uuid(rel.parse_access_log(si.log_lines(t)))


#: The orders asked for, as a user passes them.
WANTED_ORDERS = (1, 2, 3, 5, 32, 34, 65, 100, 640, 1001, 9_999, 14_000, 10**9)


@query("orders_in_list", f"""
    select o_orderkey, o_totalprice, part_names from orders join ({PARTS_SQL}) on l_orderkey = o_orderkey
    where o_orderkey in {WANTED_ORDERS}""")
def orders_in_list(t: Tables) -> DataFrame:
    return rel.orders_parts(t.orders, t.lineitem, t.part, keys=WANTED_ORDERS)


@query("temp_ranges", """
    select h.date, h.station, h.value - l.value as range
    from observations h join observations l using (station, date)
    where h.observation = 'TMAX' and l.observation = 'TMIN' and h.qflag is null and l.qflag is null""", ("observations",))
def temp_ranges(t: Tables) -> DataFrame:
    return rel.temp_ranges(si.observations(t)).withColumnRenamed("_range", "range")


@query("temp_range_hint", """
    select date, station, r as range
    from (select h.date, h.station, h.value - l.value as r, max(h.value - l.value) over (partition by h.date) as m
          from observations h join observations l using (station, date)
          where h.observation = 'TMAX' and l.observation = 'TMIN' and h.qflag is null and l.qflag is null)
    where r = m""", ("observations",))
def temp_range_hint(t: Tables) -> DataFrame:
    return rel.argmax_ties_sql(rel.temp_ranges(si.observations(t)).withColumnRenamed("_range", "range"), ["date"], "range")


@query("union_bag", "select c_nationkey as nation from customer union all select s_nationkey from supplier")
def union_bag(t: Tables) -> DataFrame:
    return rel.union_rows(t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation")))


@query("min_numbers", r"""
    select doc_id, list_min(list_transform(regexp_extract_all(text, '\d+'), lambda d: try_cast(d as bigint))) as n from documents""")
def min_numbers(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.min_number("text").alias("n"))


@query("clean_names", r"""
    select p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as name,
           nullif(split_part(p_type, ' ', 2), '') as kind from part""")
def clean_names(t: Tables) -> DataFrame:
    spaced = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" \t ")), F.lit(" "))
    return t.part.select("p_partkey", text.clean_text(spaced).alias("name"), text.list_item("p_type", " ", 2).alias("kind"))


@query("hour_labels", "select strftime(ts, '%Y%m%d-%H%M') as hour, count(*) as n from events group by 1")
def hour_labels(t: Tables) -> DataFrame:
    path = F.concat(F.lit("/counts/pagecounts-"), F.date_format("ts", "yyyyMMdd-HHmmss"), F.lit(".gz"))
    return t.events.select(text.hour_label(path).alias("hour")).groupBy("hour").agg(F.count("*").alias("n"))


@query("row_totals", "select l_orderkey, l_linenumber, round((l_quantity + l_extendedprice + l_tax) / 1000, 6) as thousands from lineitem")
def row_totals(t: Tables) -> DataFrame:
    total = numeric.total(["l_quantity", "l_extendedprice", "l_tax"], 1000.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", rounded(total).alias("thousands"))


@query("turn_similarity", """
    with w as (select conv_id, turn, list_distinct(string_split(text, ' ')) as words from conversations)
    select a.conv_id, a.turn, round(len(list_intersect(a.words, b.words)) / len(list_distinct(list_concat(a.words, b.words)))::double, 6) as jaccard
    from w a join w b on a.conv_id = b.conv_id and b.turn = a.turn + 1""")
def turn_similarity(t: Tables) -> DataFrame:
    words = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("words"))
    after = words.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("words").alias("after"))
    return words.join(after, ["conv_id", "turn"]).select("conv_id", "turn", rounded(numeric.jaccard("words", "after")).alias("jaccard"))


@query("list_items", "select unnest(string_split(p_name, ' ')) as item, count(*) as n from part group by 1")
def list_items(t: Tables) -> DataFrame:
    listed = F.concat(F.lit("["), F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit("]"))
    return t.part.select(F.explode(text.parse_list(listed)).alias("item")).groupBy("item").agg(F.count("*").alias("n"))
