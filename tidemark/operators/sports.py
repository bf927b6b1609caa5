"""Match and player tables: group averages, tallies, squads and replacements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import enrich, first_band, union_distinct

# Player value bands in euro (closed ranges, first match wins) and body codes.
VALUE_BANDS = (
    (10_000, 200_000),
    (200_000, 400_000),
    (400_000, 600_000),
    (600_000, 800_000),
    (800_000, 1_000_000),
)
BODY_CODES = {"Lean": 3, "Normal": 2, "Stocky": 1}


def group_averages(df: DataFrame, key: str, entity: str, metrics: Mapping[str, str]) -> DataFrame:
    """Sum of each metric over the number of entities, per group; one aggregate for all metrics."""
    count = F.count(entity)
    return df.groupBy(key).agg(
        count.alias("team_count"), *[(F.sum(c) / count).alias(name) for name, c in metrics.items()]
    )


def average_goals(matches: DataFrame) -> DataFrame:
    """Goals per league and season over the number of teams the league ever had at home."""
    teams = matches.select("league", "home").distinct().groupBy("league").agg(F.count("*").alias("_teams"))
    goals = matches.where(F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull())
    sums = goals.groupBy("league", "season").agg(F.sum(F.col("home_goals") + F.col("away_goals")).alias("_goals"))
    return sums.join(teams, "league").select("league", "season", (F.col("_goals") / F.col("_teams")).alias("avg_goals"))


def result_of(home_goals: str = "home_goals", away_goals: str = "away_goals") -> Column:
    home, away = F.col(home_goals), F.col(away_goals)
    return F.when(away > home, "away").when(away < home, "home").otherwise("draw")


def match_results(matches: DataFrame) -> DataFrame:
    """How often each pairing of a season ended in each result."""
    return (
        matches.groupBy("home", "away", "season", result_of().alias("result")).agg(F.count("*").alias("n"))
    )


def result_tally(matches: DataFrame, teams: Sequence[str]) -> DataFrame:
    """Wins, losses and draws at home and away for the given teams, in one pass."""
    result = result_of()
    home_view = F.struct(
        F.col("home").alias("team"), F.lit("home").alias("side"),
        F.when(result == "home", "win").when(result == "away", "lose").otherwise("draw").alias("outcome"),
    )
    away_view = F.struct(
        F.col("away").alias("team"), F.lit("away").alias("side"),
        F.when(result == "away", "win").when(result == "home", "lose").otherwise("draw").alias("outcome"),
    )
    wanted = matches.where(F.col("home").isin(list(teams)) | F.col("away").isin(list(teams)))
    views = wanted.select(F.explode(F.array(home_view, away_view)).alias("_v")).select("_v.*")
    return views.where(F.col("team").isin(list(teams))).groupBy("team", "side", "outcome").agg(F.count("*").alias("n"))


def team_goals(matches: DataFrame, teams: Sequence[str]) -> DataFrame:
    """Goals scored at home and away, per team and season."""
    home_view = F.struct(F.col("home").alias("team"), F.col("home_goals").alias("h"), F.lit(None).cast("bigint").alias("a"))
    away_view = F.struct(F.col("away").alias("team"), F.lit(None).cast("bigint").alias("h"), F.col("away_goals").alias("a"))
    wanted = matches.where(F.col("home").isin(list(teams)) | F.col("away").isin(list(teams)))
    views = wanted.select("season", F.explode(F.array(home_view, away_view)).alias("_v"))
    return (
        views.where(F.col("_v.team").isin(list(teams)))
        .groupBy(F.col("_v.team").alias("team"), "season")
        .agg(
            F.coalesce(F.sum("_v.h"), F.lit(0)).alias("home_goals"),
            F.coalesce(F.sum("_v.a"), F.lit(0)).alias("away_goals"),
        )
    )


def head_to_head(matches: DataFrame, a: str, b: str) -> DataFrame:
    """Wins of either team and draws over all matches between the two."""
    home, away = F.col("home"), F.col("away")
    met = matches.where(((home == a) & (away == b)) | ((home == b) & (away == a))).withColumn("_r", result_of())
    winner = F.when(F.col("_r") == "home", home).when(F.col("_r") == "away", away)
    return met.withColumn("_w", winner).agg(
        F.count_if(F.col("_w") == a).alias("team_a_wins"),
        F.count_if(F.col("_w") == b).alias("team_b_wins"),
        F.count_if(F.col("_r") == "draw").alias("draws"),
    )


def squad_mix(players: DataFrame, matches: DataFrame) -> DataFrame:
    """Young and old players, split at the mean age, of clubs that played at home."""
    aged = players.withColumn("age", F.col("age").try_cast("int")).where(F.col("age").isNotNull())
    mean_age = aged.agg(F.avg("age")).scalar()
    band = F.when(F.col("age") <= mean_age, "Y").otherwise("O").alias("band")
    clubs = matches.select(F.col("home").alias("club")).distinct()
    counts = (
        aged.select("club", "age")
        .groupBy("club", band).agg(F.count("*").alias("n"))
        .join(clubs, "club", "left_semi")
    )
    sizes = counts.groupBy("club").agg(F.sum("n").alias("_all"))
    return counts.join(sizes, "club").select("club", "band", "n", (F.col("n") * 100.0 / F.col("_all")).alias("pct"))


def work_rate(players: DataFrame, teams: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Players per team and work rate, ``N/A`` left out; ``kinds`` maps a label to its column."""
    wanted = players.where(F.col("team").isin(list(teams)))
    result = None
    for kind, column in kinds.items():
        counts = (
            wanted.where(F.col(column) != "N/A")
            .groupBy("team", F.lit(kind).alias("kind"), F.col(column).alias("rate"))
            .agg(F.count("*").alias("n"))
        )
        result = counts if result is None else union_distinct(result, counts)
    return result


def replacements(players: DataFrame, name: str) -> DataFrame:
    """Younger players of the same position with at least the same potential."""
    typed = players.withColumn("age", F.col("age").try_cast("int")).select(
        "short_name", "age", "club", "position", "potential"
    )
    probe = typed.where(F.col("short_name") == name).agg(F.min(F.struct("age", "position", "potential"))).scalar()
    found = typed.where(
        (F.col("position") == probe["position"]) & (F.col("age") < probe["age"])
        & (F.col("potential") >= probe["potential"])
    )
    return found.select("short_name", "age", "club", "position", "potential").orderBy("age", "short_name")


def value_band_counts(players: DataFrame) -> DataFrame:
    return players.groupBy(first_band("value_eur", VALUE_BANDS).alias("value_range")).agg(F.count("*").alias("n"))


def continent_codes(countries: DataFrame) -> DataFrame:
    """Countries with the rank of their continent's name as code."""
    names = countries.select("continent").distinct()
    # a handful of names: one array of them gives the code by position
    ordered = names.agg(F.array_sort(F.collect_list("continent"))).scalar()
    return countries.select(
        "country", "continent", F.array_position(ordered, F.col("continent")).cast("bigint").alias("code")
    )


def continent_weight(players: DataFrame, countries: DataFrame) -> DataFrame:
    located = enrich(players.select("nationality", "weight_kg"), countries, "nationality", "country")
    return located.groupBy("continent").agg(F.avg("weight_kg").alias("average_weight"))


def body_type_counts(players: DataFrame, countries: DataFrame) -> DataFrame:
    """Players per continent and known body type."""
    located = enrich(players.select("nationality", "body_type"), countries, "nationality", "country")
    known = located.where(F.col("body_type").isin(list(BODY_CODES)))
    return known.groupBy("continent", "body_type").agg(F.count("*").alias("n"))


def club_age(players: DataFrame) -> DataFrame:
    """Mean age per club, youngest club first."""
    typed = players.select("club", F.col("age").try_cast("int").alias("age"))
    return typed.groupBy("club").agg(F.avg("age").alias("average_age")).orderBy("average_age", "club")
