"""Round trips through files in the shared folder: written, read again with explicit schemas, counted."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cents
from ..operators import models
from ..operators.relational import with_previous_day
from ..operators.resample import hash_split
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import readers, writers
from . import standins as si
from .registry import query
from .tables import Tables


def folder(t: Tables) -> str:
    """A new folder where driver and executors see the same files."""
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


@query("split_sinks", """
    select subreddit, score > 0 as positive, count(*) as n, sum(score)::bigint as total from comments group by all""", ("comments",))
def split_sinks(t: Tables) -> DataFrame:
    """One input into two JSON folders by predicate."""
    path = folder(t)
    writers.split_write(si.comments(t), F.col("score") > 0, f"{path}/yes", f"{path}/no")
    kind = "subreddit string, author string, score bigint"
    both = [readers.read_json(t.spark, f"{path}/{side}", kind).withColumn("positive", F.lit(side == "yes")) for side in ("yes", "no")]
    return both[0].unionByName(both[1]).groupBy("subreddit", "positive").agg(F.count("*").alias("n"), F.sum("score").alias("total"))


@query("csv_files", """
    select o_orderstatus as status, count(*) as n, sum(cast(round(o_totalprice * 100) as bigint))::bigint as cents, true as zipped from orders group by 1""")
def csv_files(t: Tables) -> DataFrame:
    """Compressed CSV without a header, read with its schema and the file each row came from."""
    path = folder(t)
    writers.write_csv(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    rows = readers.with_source_file(readers.read_csv(t.spark, path, "k bigint, status string, price double"))
    zipped = F.bool_and(F.col("filename").endswith(".csv.gz")).alias("zipped")
    return rows.groupBy("status").agg(F.count("*").alias("n"), F.sum(cents("price")).alias("cents"), zipped)


@query("spaced_files", """
    select hour, language, count(*) as n, sum(views)::bigint as views, max(title) as last_title from pageviews group by all""", ("pageviews",))
def spaced_files(t: Tables) -> DataFrame:
    """Lines of text with blanks between the fields, read as lines first and as columns then."""
    path = folder(t)
    line = F.concat_ws(" ", "hour", "language", "title", "views")
    writers.write_lines(si.pageviews(t).select(line.alias("value")), f"{path}/a")
    writers.write_lines(readers.read_lines(t.spark, f"{path}/a"), f"{path}/b")
    rows = readers.read_csv(t.spark, f"{path}/b", "hour string, language string, title string, views int", sep=" ", quote="")
    return rows.groupBy("hour", "language").agg(F.count("*").alias("n"), F.sum("views").alias("views"), F.max("title").alias("last_title"))


@query("connector_table", """
    select n_regionkey as region, sum(n)::bigint as n
    from nation join (select c_nationkey as k, count(*) * 2 as n from customer group by 1) on k = n_nationkey group by 1""")
def connector_table(t: Tables) -> DataFrame:
    """Appended twice through a fixed number of writers, registered as a view, asked in SQL."""
    path, view = folder(t), f"customers_{uuid.uuid4().hex}"
    for _ in range(2):
        writers.write_table(t.customer.select("c_custkey", "c_nationkey"), "parquet", 4, path)
    readers.register_view(t.spark, view, "parquet", {"path": path})
    return t.spark.sql(
        f"SELECT n_regionkey AS region, count(*) AS n FROM {view} JOIN {{nation}} ON c_nationkey = n_nationkey GROUP BY n_regionkey", nation=t.nation
    )


@query("saved_model", """
    select count(*) as n, 0::bigint as n_changed
    from daily_max a join daily_max b on a.station = b.station and b.date = a.date - 1""", ("daily_max",))
def saved_model(t: Tables) -> DataFrame:
    """A pipeline that is stored and loaded again scores every row as before."""
    path, rows = folder(t), cut_lineage(hash_split(with_previous_day(si.daily_max(t)), ["station", "date"], 0.75, 1))
    fitted = models.train_forecast(rows.where(F.col("part") == "train"))
    writers.save_model(fitted, path)
    scores = lambda model, name: models.score(model, rows).select("station", "date", F.col("prediction").alias(name))
    both = scores(fitted, "first").join(scores(writers.load_model(path), "again"), ["station", "date"], "full")
    return both.agg(F.count("*").alias("n"), F.count_if(~F.col("first").eqNullSafe(F.col("again"))).alias("n_changed"))
