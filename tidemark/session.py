"""Session settings and lineage cutting shared by every job."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution. ``DEFAULTS`` hold only where neither the cluster nor ``conf`` says otherwise."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in DEFAULTS.items():
        if key not in conf and not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder.

    A temporary folder is taken only in local mode, where driver and executors
    share one machine; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
