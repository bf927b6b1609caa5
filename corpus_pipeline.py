"""The corpus pipeline: language, near-duplicates, benchmark passages, secrets, packing.

Each stage takes all that the one before it kept, as written to Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import contamination, language, packing, secrets, simhash
from tidemark.llm.batches import crc_rest, stored
from tidemark.llm.queries import table, tokenizer_paths

#: A document stays if its language's posterior is at least this.
LEAST_POSTERIOR = 0.5
#: SQL can't say what naive Bayes, 64-bit hashes and tokenizers give; tests compare with plain Python.
ORACLE_SQL = None


def keep(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose id is among ``ids`` or is not; columns stay as they are."""
    name = "_id"
    while name in docs.columns:
        name += "_"
    ids = ids.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, docs["doc_id"] == ids[name], how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language; those without a letter or of unsure language go. Ids play no part."""
    model = language.fit(docs.where(F.coalesce(crc_rest("doc_id", 3) != 1, F.lit(True))))
    return language.keep_known(docs, model, LEAST_POSTERIOR)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates.

    Rows repeated under one id stay or go together; rows with a null id are in no group and stay.
    """
    kept = keep(docs, simhash.near_duplicates(docs).where("doc_id = component_id"), "left_semi")
    return kept.unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return keep(docs, contamination.find(docs, table(spark, sf_dir, "benchmark")), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and ``n_chars`` counted anew."""
    held = spark.sparkContext.broadcast(secrets.fit(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [None if t is None else secrets.redact(t, held.value) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(clean, batch.schema.field(i).type) if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences."""
    return packing.pack(docs, tokenizer_paths())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
