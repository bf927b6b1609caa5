"""The pipeline against plain Python, stage by stage, and on odd tables."""

import zlib

import public_tokenizers as P
import pytest
from corpus_fixtures import SMALL, docs, make  # noqa: F401
from test_small_ops import ODD, check_packing, slow_components, slow_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import contamination, language, secrets


def slow_pipeline(docs, items):  # noqa: F811
    """Texts by id that reach the last stage."""
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = language.fit(docs.where("doc_id is not null").rdd.filter(lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1).toDF(docs.schema))
    known = {}
    for d, t in rows.items():
        lang, sure = language.score(model, [t])
        if lang[0] != "und" and sure[0] >= 0.5:
            known[d] = t
    parts = slow_components({d: slow_fingerprint(t) for d, t in known.items()})
    first = {d: known[d] for d in known if parts[d] == d}
    wanted = [set(contamination.shingles(r["text"].encode())) for r in items.collect()]
    clean = {}
    for d, t in first.items():
        own = set(contamination.shingles(t.encode()))
        if not any(w and len(w & own) >= 0.8 * len(w) - 1e-9 for w in wanted):
            clean[d] = t
    return first, clean


def test_pipeline_brute(spark, docs):  # noqa: F811
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    first, clean = slow_pipeline(docs, items)
    assert len(first) < docs.count() and len(clean) <= len(first)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == docs.columns, name
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == clean
    formats = secrets.fit(kept)
    plain = {d: secrets.redact(t, formats) for d, t in clean.items()}
    hidden = corpus_pipeline.redact_secrets(spark, kept, SMALL)
    assert hidden.dtypes == docs.dtypes and {r["doc_id"]: (r["text"], r["n_chars"]) for r in hidden.collect()} == {d: (t, len(t)) for d, t in plain.items()}
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    n, total = check_packing(corpus_pipeline.run(spark, SMALL).collect(), plain, tok)
    assert n <= total / 2048 * 1.02 + 1


def test_secrets_go_and_other_columns_stay(spark, make):  # noqa: F811
    text = 'before token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" after'
    rows = make((1, text), (2, "nothing here"), (3, None))
    got = {r["doc_id"]: r for r in corpus_pipeline.redact_secrets(spark, rows, SMALL).collect()}
    assert got[1]["text"] == 'before [SECRET]" after' and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "nothing here" and got[3]["text"] is None and got[2].asDict().keys() == set(rows.columns)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_rows(spark, make, k):  # noqa: F811
    name, stage = corpus_pipeline.STAGES[k]
    for rows in (make(*ODD), make()):
        out = stage(spark, rows, SMALL)
        assert k == 4 or out.columns == rows.columns
        assert out.count() >= 0, name


def test_rows_without_an_id_stay(spark, make):  # noqa: F811
    words = "the quick brown fox jumps over the lazy dog and runs away "
    rows = make((None, words * 3), (None, words * 3), (1, words * 3), (2, words * 3), (3, None))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    wide = docs.unionByName(rows.select(docs.columns))
    kept = corpus_pipeline.language_id(spark, wide, SMALL)
    assert kept.where("doc_id is null").count() == 2
    first = corpus_pipeline.near_duplicates(spark, rows, SMALL)
    assert sorted(str(r["doc_id"]) for r in first.collect()) == ["1", "3", "None", "None"]
    assert corpus_pipeline.decontaminate(spark, rows, SMALL).count() == 5
