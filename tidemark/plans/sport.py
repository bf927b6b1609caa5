"""Queries on matches, league tables and players."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rounded
from ..operators import relational as rel
from ..operators import sports
from . import standins as si
from .registry import query
from .tables import Tables

TEAMS = ("N1", "N2")
METRICS = ("goals", "possession", "red_cards", "shots", "yellow_cards", "aerials_won")
SHOTS = ("out_of_box", "penalty_area", "six_yard_box")


@query("league_averages", "select league, count(team) as team_count, " + ", ".join(
    f"round(sum({m}) / count(team), 6) as average_{m}" for m in METRICS
) + " from league_stats group by league", ("league_stats",))
def league_averages(t: Tables) -> DataFrame:
    means = sports.group_averages(si.league_stats(t), "league", "team", {f"average_{m}": m for m in METRICS})
    return means.withColumns({f"average_{m}": rounded(F.col(f"average_{m}")) for m in METRICS})


@query("shot_placement", "select league as tournament, " + ", ".join(
    f"round(sum({m}) / count(team), 6) as average_{m}" for m in SHOTS
) + " from league_stats group by league", ("league_stats",))
def shot_placement(t: Tables) -> DataFrame:
    means = sports.group_averages(si.league_stats(t), "league", "team", {f"average_{m}": m for m in SHOTS})
    return means.select(F.col("league").alias("tournament"), *[rounded(F.col(f"average_{m}")).alias(f"average_{m}") for m in SHOTS])


@query("average_goals", """
    select league, season, round(sum(home_goals + away_goals) / any_value(teams), 6) as avg_goals
    from matches join (select league as l, count(distinct home) as teams from matches group by 1) on l = league
    group by league, season""", ("matches",))
def average_goals(t: Tables) -> DataFrame:
    goals = sports.average_goals(si.matches(t))
    return goals.withColumn("avg_goals", rounded(F.col("avg_goals")))


@query("match_results", """
    select home, away, season, case when away_goals > home_goals then 'away' when away_goals < home_goals then 'home'
           else 'draw' end as result, count(*) as n
    from matches group by all""", ("matches",))
def match_results(t: Tables) -> DataFrame:
    return sports.match_results(si.matches(t))


@query("result_tally", """
    select team, side, case when own > other then 'win' when own < other then 'lose' else 'draw' end as outcome, count(*) as n
    from (select home as team, 'home' as side, home_goals as own, away_goals as other from matches
          union all select away, 'away', away_goals, home_goals from matches)
    where team in ('N1', 'N2') group by all""", ("matches",))
def result_tally(t: Tables) -> DataFrame:
    return sports.result_tally(si.matches(t), TEAMS)


@query("team_goals", """
    select team, season, sum(h)::bigint as home_goals, sum(a)::bigint as away_goals
    from (select home as team, season, home_goals as h, 0 as a from matches
          union all select away, season, 0, away_goals from matches)
    where team in ('N1', 'N2') group by all""", ("matches",))
def team_goals(t: Tables) -> DataFrame:
    return sports.team_goals(si.matches(t), TEAMS)


@query("head_to_head", """
    select count(*) filter ((home = 'N1' and home_goals > away_goals) or (away = 'N1' and away_goals > home_goals)) as team_a_wins,
           count(*) filter ((home = 'N2' and home_goals > away_goals) or (away = 'N2' and away_goals > home_goals)) as team_b_wins,
           count(*) filter (home_goals = away_goals) as draws
    from matches where (home = 'N1' and away = 'N2') or (home = 'N2' and away = 'N1')""", ("matches",))
def head_to_head(t: Tables) -> DataFrame:
    return sports.head_to_head(si.matches(t), *TEAMS)


@query("squad_mix", """
    select club, band, n, round(n * 100.0::double / sum(n) over (partition by club), 6) as pct
    from (select club, case when try_cast(age as integer) <= (select avg(try_cast(age as integer)) from players)
                 then 'Y' else 'O' end as band, count(*) as n
          from players where try_cast(age as integer) is not null and club in (select home from matches) group by 1, 2)""",
    ("players", "matches"))
def squad_mix(t: Tables) -> DataFrame:
    mix = sports.squad_mix(si.players(t), si.matches(t))
    return mix.withColumn("pct", rounded(F.col("pct")))


@query("work_rate", """
    select team, 'attack' as kind, attack_rate as rate, count(*) as n from players
    where attack_rate <> 'N/A' and team in ('N1', 'N2') group by all
    union select team, 'defence', defence_rate, count(*) from players
    where defence_rate <> 'N/A' and team in ('N1', 'N2') group by all""", ("players",))
def work_rate(t: Tables) -> DataFrame:
    return sports.work_rate(si.players(t), TEAMS, {"attack": "attack_rate", "defence": "defence_rate"})


@query("player_replacement", """
    select p.short_name, try_cast(p.age as integer) as age, p.club, p.position, p.potential
    from players p, players q
    where q.short_name = 'Customer#000000007' and p.position = q.position
          and try_cast(p.age as integer) < try_cast(q.age as integer) and p.potential >= q.potential""", ("players",))
def player_replacement(t: Tables) -> DataFrame:
    return sports.replacements(si.players(t), "Customer#000000007")


@query("cast_players", "select short_name, try_cast(age as integer) as age, " + ", ".join(
    f"try_cast({s} as integer) as {s}" for s in si.SKILLS) + " from players", ("players",))
def cast_players(t: Tables) -> DataFrame:
    return rel.cast_columns(si.players(t), ["age", *si.SKILLS]).select("short_name", "age", *si.SKILLS)


@query("drop_fill_nulls", """
    select short_name, age, coalesce(attack, 0) as attack from (
        select short_name, try_cast(age as integer) as age, case when attack_rate <> 'N/A' then weight_kg end as attack from players)
    where age is not null""", ("players",))
def drop_fill_nulls(t: Tables) -> DataFrame:
    people = rel.cast_columns(si.players(t), ["age"])
    known = people.select("short_name", "age", F.when(F.col("attack_rate") != "N/A", F.col("weight_kg")).alias("attack"))
    return rel.drop_and_fill(known, ["age"], {"attack": 0})


@query("value_bands", """
    select case when value_eur between 10000 and 200000 then 1 when value_eur between 200000 and 400000 then 2
           when value_eur between 400000 and 600000 then 3 when value_eur between 600000 and 800000 then 4
           when value_eur between 800000 and 1000000 then 5 else 0 end as value_range, count(*) as n
    from players group by 1""", ("players",))
def value_bands(t: Tables) -> DataFrame:
    return sports.value_band_counts(si.players(t))


@query("continent_codes", """
    select country, continent, dense_rank() over (order by continent) as code from countries""", ("countries",))
def continent_codes(t: Tables) -> DataFrame:
    return sports.continent_codes(si.countries(t))


@query("recode_continents", """
    select short_name, coalesce(cast(code as varchar), nationality) as nationality
    from players left join (select country, dense_rank() over (order by continent) as code from countries)
         on country = nationality""", ("players", "countries"))
def recode_continents(t: Tables) -> DataFrame:
    codes = sports.continent_codes(si.countries(t)).withColumn("code", F.col("code").cast("string"))
    return rel.recode(si.players(t).select("short_name", "nationality"), "nationality", codes, "country", "code")


@query("continent_weight", """
    select continent, round(avg(weight_kg), 6) as average_weight
    from players join countries on country = nationality group by continent""", ("players", "countries"))
def continent_weight(t: Tables) -> DataFrame:
    means = sports.continent_weight(si.players(t), si.countries(t))
    return means.withColumn("average_weight", rounded(F.col("average_weight")))


@query("body_type_counts", """
    select continent, body_type, count(*) as n from players join countries on country = nationality
    where body_type in ('Lean', 'Normal', 'Stocky') group by all""", ("players", "countries"))
def body_type_counts(t: Tables) -> DataFrame:
    return sports.body_type_counts(si.players(t), si.countries(t))


@query("club_age", """
    select club, round(avg(try_cast(age as integer)), 6) as average_age from players group by club""", ("players",))
def club_age(t: Tables) -> DataFrame:
    return sports.club_age(si.players(t)).withColumn("average_age", rounded(F.col("average_age")))
