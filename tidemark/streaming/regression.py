"""Running least-squares line over an unbounded stream of points."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import ratio
from ..session import ensure_checkpoint_dir


def parse_xy(messages: DataFrame, value: str = "value") -> DataFrame:
    """``x y`` text as two doubles; unreadable numbers become null and are not counted."""
    part = F.split(F.col(value), " ")
    return messages.select(
        F.try_element_at(part, F.lit(1)).try_cast("double").alias("x"),
        F.try_element_at(part, F.lit(2)).try_cast("double").alias("y"),
    ).where("x is not null and y is not null")


def regression_line(xy: DataFrame) -> DataFrame:
    """Slope and intercept from five running sums; works on tables and on streams alike."""
    x, y = F.col("x"), F.col("y")
    sums = xy.agg(
        F.count("*").cast("double").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"),
    )
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    beta = ratio(F.col("sxy") - sx * sy / n, F.col("sxx") - sx * sx / n)
    return sums.where("n > 0").withColumn("beta", beta).select("beta", (sy / n - F.col("beta") * sx / n).alias("alpha"))


def start_stream(
    df: DataFrame, sink: str = "console", mode: str = "complete", name: str | None = None,
    timeout: float | None = 600, once: bool = False, **options: str,
) -> StreamingQuery:
    """Start a stream and wait for a bounded time; ``once`` works through what is there and ends.

    State goes to ``checkpointLocation``, or else into the shared checkpoint folder, under the stream's name where it
    writes to a lasting sink, so that a restart goes on from there.
    """
    if "checkpointLocation" not in options:
        ensure_checkpoint_dir(df.sparkSession)
        lasting = name and sink not in ("memory", "console", "noop")
        shared = df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get()
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None) or shared
        options["checkpointLocation"] = f"{root}/streams/{name if lasting else uuid.uuid4().hex}"
    writer = df.writeStream.format(sink).outputMode(mode).options(**options)
    if name:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    stream = writer.start()
    if once:
        stream.awaitTermination()
    elif timeout:
        stream.awaitTermination(timeout)
    return stream
