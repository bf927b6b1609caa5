"""Stand-in inputs derived from the given tables, each as a DataFrame and as SQL text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables

SQL: dict[str, str] = {}


def with_clause(needs: tuple[str, ...], body: str) -> str:
    """Prefix a query with the stand-ins it needs and those they need in turn."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in SQL:
            if other != name and re.search(rf"\b{other}\b", SQL[name]):
                visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    heads = ", ".join(f"{n} as ({SQL[n]})" for n in ordered)
    # a body may start with ", name as (...)" to go on with the list of named tables
    return f"with recursive {heads} {body}"


SQL["comments"] = """
    select event_type as subreddit, 'u' || user_id as author,
           cast(round(value * 100) as bigint) - 4950 as score from events"""


def comments(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_type").alias("subreddit"),
        F.concat(F.lit("u"), F.col("user_id")).alias("author"),
        (F.round(F.col("value") * 100).cast("bigint") - 4950).alias("score"),
    )


SQL["log_lines"] = """
    select 'h' || user_id || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0700] "GET /' || event_type
           || ' HTTP/1.0" 200 ' || case when event_type = 'error' then '-'
              else cast(cast(round(value * 100) as bigint) as varchar) end as value
    from events"""


def log_lines(t: Tables) -> DataFrame:
    size = F.when(F.col("event_type") == "error", "-").otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
    return t.events.select(
        F.concat(
            F.lit("h"), F.col("user_id"), F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
            F.lit(' -0700] "GET /'), F.col("event_type"), F.lit(' HTTP/1.0" 200 '), size,
        ).alias("value")
    )


SQL["access_log"] = """
    select regexp_extract(value, '^(\\S+)', 1) as host,
           strptime(regexp_extract(value, '\\[(\\S+) ', 1), '%d/%b/%Y:%H:%M:%S') as datetime,
           regexp_extract(value, '"[A-Z]+ (\\S+) HTTP', 1) as path,
           cast(regexp_extract(value, ' (\\d+)$', 1) as bigint) as bytes
    from log_lines
    where regexp_matches(value, '^(\\S+) - - \\[(\\S+) [+-]\\d+\\] "[A-Z]+ (\\S+) HTTP/\\d\\.\\d" \\d+ (\\d+)$')"""

SQL["observations"] = """
    select cast(user_id as varchar) as station, day as date, o as observation,
           case when o = 'TMAX' then hi else lo end as value, qflag
    from (select user_id, cast(ts as date) as day, cast(max(round(value * 10)) as bigint) as hi,
                 cast(min(round(value * 10)) as bigint) as lo,
                 case when count(*) % 7 = 0 then 'X' end as qflag
          from events group by 1, 2), (values ('TMAX'), ('TMIN')) as kinds(o)"""


def observations(t: Tables) -> DataFrame:
    tenths = F.round(F.col("value") * 10).cast("bigint")
    days = t.events.groupBy("user_id", F.col("ts").cast("date").alias("date")).agg(
        F.max(tenths).alias("hi"), F.min(tenths).alias("lo"), F.count("*").alias("n")
    )
    kinds = F.array(
        F.struct(F.lit("TMAX").alias("observation"), F.col("hi").alias("value")),
        F.struct(F.lit("TMIN").alias("observation"), F.col("lo").alias("value")),
    )
    return days.select(
        F.col("user_id").cast("string").alias("station"), "date",
        F.when(F.col("n") % 7 == 0, "X").alias("qflag"), F.explode(kinds).alias("_k"),
    ).select("station", "date", "_k.observation", "_k.value", "qflag")


SQL["daily_max"] = """
    select station, date, cast(cast(station as bigint) % 90 as double) as latitude,
           cast(cast(station as bigint) % 180 as double) as longitude,
           cast(cast(station as bigint) * 7 % 1000 as double) as elevation, value / 10.0::double as tmax
    from observations where observation = 'TMAX' and qflag is null"""


def daily_max(t: Tables) -> DataFrame:
    station = F.col("station").cast("bigint")
    return observations(t).where((F.col("observation") == "TMAX") & F.col("qflag").isNull()).select(
        "station", "date",
        (station % 90).cast("double").alias("latitude"),
        (station % 180).cast("double").alias("longitude"),
        (station * 7 % 1000).cast("double").alias("elevation"),
        (F.col("value") / 10.0).alias("tmax"),
    )


SQL["pageviews"] = """
    select strftime(l_shipdate, '%Y%m%d-%H') as hour, case when p_size % 5 = 0 then 'de' else 'en' end as language,
           replace(p_name, ' ', '_') as title, cast(l_quantity as integer) as views
    from lineitem join part on l_partkey = p_partkey"""


def pageviews(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.date_format("l_shipdate", "yyyyMMdd-HH").alias("hour"),
        F.when(F.col("p_size") % 5 == 0, "de").otherwise("en").alias("language"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("title"),
        F.col("l_quantity").cast("int").alias("views"),
    )


SQL["edges"] = """
    select o_custkey as src, (o_orderkey * 7919) % (select count(*) from customer) as dst from orders"""


def edges(t: Tables) -> DataFrame:
    size = t.customer.agg(F.count("*")).scalar()
    return t.orders.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") * 7919 % size).alias("dst"))


SQL["colours"] = """
    select p_partkey as id, cast(p_partkey % 256 as integer) as "R", cast(p_partkey * 7 % 256 as integer) as "G",
           cast(p_size * 5 % 256 as integer) as "B" from part"""


def colours(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") % 256).cast("int").alias("R"),
        (F.col("p_partkey") * 7 % 256).cast("int").alias("G"),
        (F.col("p_size") * 5 % 256).cast("int").alias("B"),
    )


SQL["matches"] = """
    select 'N' || s_nationkey as home, 'N' || c_nationkey as away, cast(year(o_orderdate) as integer) as season,
           cast(l_quantity as bigint) % 5 as home_goals, cast(l_linenumber % 4 as bigint) as away_goals,
           r_name as league
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
         join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
         join region on n_regionkey = r_regionkey
    where s_nationkey <> c_nationkey"""


def matches(t: Tables) -> DataFrame:
    leagues = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey")
    sellers = t.supplier.join(leagues, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "r_name")
    joined = (
        t.lineitem.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .where(F.col("s_nationkey") != F.col("c_nationkey"))
    )
    return joined.select(
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("home"),
        F.concat(F.lit("N"), F.col("c_nationkey")).alias("away"),
        F.year("o_orderdate").alias("season"),
        (F.col("l_quantity").cast("bigint") % 5).alias("home_goals"),
        (F.col("l_linenumber") % 4).cast("bigint").alias("away_goals"),
        F.col("r_name").alias("league"),
    )


SQL["league_stats"] = """
    select r_name as league, s_name as team, s_suppkey * 7 % 90 as goals, s_suppkey * 3 % 100 as possession,
           s_suppkey * 5 % 8 as red_cards, s_suppkey * 11 % 23 as shots, s_suppkey * 13 % 95 as yellow_cards,
           s_suppkey * 17 % 31 as aerials_won, s_suppkey * 19 % 60 as out_of_box, s_suppkey * 23 % 80 as penalty_area,
           s_suppkey * 29 % 20 as six_yard_box
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


def league_stats(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.select(
        F.col("r_name").alias("league"), F.col("s_name").alias("team"),
        (key * 7 % 90).alias("goals"), (key * 3 % 100).alias("possession"), (key * 5 % 8).alias("red_cards"),
        (key * 11 % 23).alias("shots"), (key * 13 % 95).alias("yellow_cards"), (key * 17 % 31).alias("aerials_won"),
        (key * 19 % 60).alias("out_of_box"), (key * 23 % 80).alias("penalty_area"), (key * 29 % 20).alias("six_yard_box"),
    )


SKILLS = ("pace", "physic", "agility", "stamina", "aggression", "passing", "shooting", "defending", "dribbling")

SQL["players"] = """
    select c_name as short_name, 'N' || c_nationkey as club, 'N' || c_nationkey as nationality, 'N' || c_nationkey as team,
           case when c_custkey % 50 = 0 then 'N/A' else cast(17 + c_custkey % 23 as varchar) end as age,
           cast(50 + c_custkey % 60 as bigint) as weight_kg, c_mktsegment as position,
           40 + c_custkey * 3 % 60 as overall, 50 + c_custkey * 7 % 50 as potential,
           cast(round(abs(c_acctbal) * 100) as bigint) as value_eur,
           case c_custkey % 4 when 0 then 'Lean' when 1 then 'Normal' when 2 then 'Stocky' else 'Other' end as body_type,
           case c_custkey % 4 when 0 then 'High' when 1 then 'Medium' when 2 then 'Low' else 'N/A' end as attack_rate,
           case c_custkey % 3 when 0 then 'High' when 1 then 'Low' else 'N/A' end as defence_rate, """ + ", ".join(
    f"cast(c_custkey * {k} % 100 as varchar) as {name}" for name, k in zip(SKILLS, (3, 7, 11, 13, 17, 19, 23, 29, 31))
) + " from customer"


def players(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    nation = F.concat(F.lit("N"), F.col("c_nationkey"))

    def pick(n: int, *labels: str):
        column = F.when(key % n == 0, labels[0])
        for i, label in enumerate(labels[1:-1], 1):
            column = column.when(key % n == i, label)
        return column.otherwise(labels[-1])

    return t.customer.select(
        F.col("c_name").alias("short_name"), nation.alias("club"), nation.alias("nationality"), nation.alias("team"),
        F.when(key % 50 == 0, "N/A").otherwise((key % 23 + 17).cast("string")).alias("age"),
        (key % 60 + 50).alias("weight_kg"), F.col("c_mktsegment").alias("position"),
        (key * 3 % 60 + 40).alias("overall"), (key * 7 % 50 + 50).alias("potential"),
        F.round(F.abs("c_acctbal") * 100).cast("bigint").alias("value_eur"),
        pick(4, "Lean", "Normal", "Stocky", "Other").alias("body_type"),
        pick(4, "High", "Medium", "Low", "N/A").alias("attack_rate"),
        pick(3, "High", "Low", "N/A").alias("defence_rate"),
        *[(key * k % 100).cast("string").alias(n) for n, k in zip(SKILLS, (3, 7, 11, 13, 17, 19, 23, 29, 31))],
    )


SQL["countries"] = """
    select 'N' || n_nationkey as country, r_name as continent from nation join region on n_regionkey = r_regionkey"""


def countries(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("country"), F.col("r_name").alias("continent")
    )


SQL["properties"] = """
    select o_orderkey as pid, case when o_orderkey % 20 = 0 then null else cast(1890 + o_custkey % 130 as integer) end as year_built,
           o_totalprice as current, o_orderstatus as legal_type, 'V' || (o_custkey % 9) as postcode from orders"""


def properties(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("pid"),
        F.when(F.col("o_orderkey") % 20 != 0, (F.col("o_custkey") % 130 + 1890).cast("int")).alias("year_built"),
        F.col("o_totalprice").alias("current"),
        F.col("o_orderstatus").alias("legal_type"),
        F.concat(F.lit("V"), F.col("o_custkey") % 9).alias("postcode"),
    )


SQL["search_log"] = """
    select user_id, case when user_id % 2 = 0 then 'A' else 'B' end as search_ui,
           count(*) filter (event_type = 'click') as search_count, user_id % 5 = 0 as is_instructor
    from events group by user_id"""


def search_log(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("search_count")).select(
        "user_id", F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("search_ui"), "search_count",
        (F.col("user_id") % 5 == 0).alias("is_instructor"),
    )


SQL["programme"] = """
    select c_custkey as id, case when c_mktsegment = 'BUILDING' then 1 else 0 end as treat,
           cast(c_nationkey as double) as nation, cast(coalesce(n, 0) as double) as n_orders, c_acctbal as balance,
           coalesce(cents, 0) / 100.0::double as outcome
    from customer left join (
        select o_custkey, count(*) as n,
               sum(case when o_orderdate >= timestamp '1998-01-01' then cast(round(o_totalprice * 100) as bigint) else 0 end)::bigint as cents
        from orders group by 1) on o_custkey = c_custkey"""


def programme(t: Tables) -> DataFrame:
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    spend = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"),
        F.sum(F.when(late, F.round(F.col("o_totalprice") * 100).cast("bigint")).otherwise(0)).alias("cents"),
    )
    return t.customer.join(spend, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("treat"),
        F.col("c_nationkey").cast("double").alias("nation"),
        F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("n_orders"),
        F.col("c_acctbal").alias("balance"),
        (F.coalesce(F.col("cents"), F.lit(0)) / 100.0).alias("outcome"),
    )


SQL["boxes"] = """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           cast(l_linenumber * 3 as double) as t_x, cast(l_quantity % 10 as double) as t_y,
           cast(5 + l_linenumber as double) as t_w, cast(4 + l_quantity % 7 as double) as t_h,
           cast(l_linenumber * 3 + l_partkey % 3 as double) as p_x, cast(l_quantity % 10 + l_suppkey % 4 as double) as p_y,
           cast(5 + l_linenumber as double) as p_w, cast(4 + l_quantity % 7 as double) as p_h
    from lineitem"""


def boxes(t: Tables) -> DataFrame:
    line, q = F.col("l_linenumber"), F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (line * 3).cast("double").alias("t_x"), (q % 10).cast("double").alias("t_y"),
        (line + 5).cast("double").alias("t_w"), (q % 7 + 4).cast("double").alias("t_h"),
        (line * 3 + F.col("l_partkey") % 3).cast("double").alias("p_x"),
        (q % 10 + F.col("l_suppkey") % 4).cast("double").alias("p_y"),
        (line + 5).cast("double").alias("p_w"), (q % 7 + 4).cast("double").alias("p_h"),
    )


SQL["connections"] = """
    select event_id as id, event_type as kind, 'h' || hour(ts) as hour, value from events"""


def connections(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"),
        F.concat(F.lit("h"), F.hour("ts")).alias("hour"), "value",
    )


COVER = tuple(f"e{i}" for i in range(64))
SQL["cover"] = "select vec_id as id, " + ", ".join(
    f"cast(embedding[{i + 1}] as double) as e{i}" for i in range(64)
) + ", label % 2 as label, label as cluster from embeddings"


def cover(t: Tables) -> DataFrame:
    return t.embeddings.select(
        F.col("vec_id").alias("id"),
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)],
        (F.col("label") % 2).alias("label"), F.col("label").alias("cluster"),
    )


SQL["predictions"] = """
    select o_orderkey as id, o_totalprice as label, 150000.0 + (o_custkey % 7) * 12500.0 as prediction,
           cast(o_orderkey % 3 as integer) as class_label, cast((o_orderkey + o_custkey) % 3 as integer) as class_prediction,
           case when o_orderstatus = 'F' then 1 else 0 end as flag, ((o_custkey % 101) / 100.0)::double as probability
    from orders"""


def predictions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("label"),
        (F.lit(150000.0) + (F.col("o_custkey") % 7) * 12500.0).alias("prediction"),
        (F.col("o_orderkey") % 3).cast("int").alias("class_label"),
        ((F.col("o_orderkey") + F.col("o_custkey")) % 3).cast("int").alias("class_prediction"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("flag"),
        (F.col("o_custkey") % 101 / 100.0).alias("probability"),
    )
