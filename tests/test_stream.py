import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.plans import REGISTRY
from tidemark.sources.readers import read_stream
from tidemark.streaming import regression


def test_stream_equals_batch_over_several_triggers(spark, tmp_path):
    for part in range(3):
        lines = spark.range(part * 10, part * 10 + 10).select(F.concat_ws(" ", "id", F.col("id") * 2 + 1 + F.col("id") % 3).alias("value"))
        lines.coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    (tmp_path / "in" / "bad.txt").write_text("1 x\n\n7\n")
    stream = regression.regression_line(regression.parse_xy(read_stream(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger="1")))
    name = f"t{uuid.uuid4().hex}"
    query = regression.start_stream(stream, "memory", name=name, once=True)
    assert len(query.recentProgress) >= 3
    batch = regression.regression_line(regression.parse_xy(spark.read.text(str(tmp_path / "in")))).first()
    assert tuple(spark.table(name).first()) == pytest.approx(tuple(batch))
    assert batch["beta"] == pytest.approx(2.0, abs=0.05)


def test_bounded_wait(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 2\n2 4\n")
    stream = regression.regression_line(regression.parse_xy(read_stream(spark, "text", str(tmp_path))))
    name = f"t{uuid.uuid4().hex}"
    query = regression.start_stream(stream, "memory", name=name, timeout=0.1)
    query.processAllAvailable()
    query.stop()
    assert tuple(spark.table(name).first()) == (2.0, 0.0)


def test_registered_stream(spark):
    assert len(REGISTRY["stream_regression"](spark, "/root/testdata/sf0.001").collect()) == 1
