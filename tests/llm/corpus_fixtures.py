"""Fixtures of the corpus operators' tests."""

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names the operators use inside.
CLASH = "f long, g long, v long, row long, _id long, score double, spans string, component_id long, island int, key long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def make(spark):
    """Documents of the given (doc_id, text) or (doc_id, text, lang) rows, with clashing extra columns."""
    kind = T.StructType.fromDDL(f"{DOC}, {CLASH}")

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1] or ""), *([None] * 10)) for r in rows]
        return spark.createDataFrame(full, kind)

    return build
