"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import by_bytes

BUCKETS = 1 << 15
ORDERS = (2, 3)
#: Most labelled documents a model is fitted on, taken by a hash of their text and language.
MAX_TRAIN = 20_000
#: Bytes of text whose n-grams are held at once: their arrays take some 60 times as much, in every worker of an executor.
SLICE_BYTES = 1 << 18
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


@dataclass(frozen=True)
class Model:
    """Log-probabilities per language and bucket, smoothed by one."""

    langs: tuple[str, ...]
    prior: np.ndarray
    logp: np.ndarray


def grams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to (ascending per order), letters per text.

    Texts are lower-cased; every run of other characters counts as one blank.
    """
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) for t in low])
    letter = letters()[code]
    n_letters = np.bincount(text[letter], minlength=len(low))
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (text[1:] == text[:-1])
    code, text = np.where(letter, code, np.uint32(32))[keep], text[keep]
    buckets, owners = [], []
    for n in ORDERS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, np.uint32)
        for j in range(n):
            h = (h ^ code[j : j + size]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h = (h * np.uint32(0x85EBCA6B)) >> np.uint32(17)
        same = text[:size] == text[n - 1 :]
        buckets.append(h[same])
        owners.append(text[:size][same])
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32), n_letters
    return np.concatenate(buckets), np.concatenate(owners), n_letters


def fit(labelled: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Model of the (text, lang) rows; rows with a null in either take no part.

    At most about ``max_train`` rows are used, chosen by hash, so a hot source or language cannot crowd
    out the rest. The driver receives a few rows of fixed size per language and none per document.
    """
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    total = rows.count()
    if total > max_train:
        share = int(max_train / total * (1 << 30))
        rows = rows.where(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < share)
    tasks = 8

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            langs = batch.column("lang").to_pylist()
            bucket, owner, _ = grams(batch.column("text").to_pylist())
            names = sorted(set(langs))
            of = np.array([names.index(x) for x in langs])
            for i, name in enumerate(names):
                held = seen.setdefault(name, [0, np.zeros(BUCKETS, np.int64)])
                held[0] += int((of == i).sum())
                held[1] += np.bincount(bucket[of[owner] == i], minlength=BUCKETS)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen)), pa.array([n for n, _ in seen.values()], pa.int64()), pa.array([c.tobytes() for _, c in seen.values()], pa.binary())],
                names=["lang", "n", "counts"],
            )

    parts = rows.repartition(tasks).mapInArrow(count, "lang string, n long, counts binary").collect()
    langs = tuple(sorted({p["lang"] for p in parts}))
    docs, counts = np.zeros(len(langs)), np.ones((len(langs), BUCKETS))
    for p in parts:
        i = langs.index(p["lang"])
        docs[i] += p["n"]
        counts[i] += np.frombuffer(p["counts"], np.int64)
    logp = np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)
    return Model(langs, np.log(docs / docs.sum()) if len(docs) else docs, logp)


def score(model: Model, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
    """Most probable language of each text and its posterior probability."""
    bucket, owner, n_letters = grams(texts)
    total = np.zeros((len(model.langs), len(texts)))
    for i in range(len(model.langs)):
        total[i] = model.prior[i] + np.bincount(owner, weights=model.logp[i][bucket], minlength=len(texts))
    if not len(model.langs):
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = total.argmax(0)
    sure = 1 / np.exp(total - total.max(0)).sum(0)
    known = n_letters > 0
    return [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, sure, 0.0)


def identify(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (posterior, 0 to 1) for every row of ``docs``.

    Only ``text`` is looked at. A null text, or one without a letter, gets ``und`` and 0, as does every
    text when the model has seen no language. Repeated rows are answered row by row, ties go to the
    language first in order, other columns are ignored. The broadcast model has a fixed size per language.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            lang, sure = score(held.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(lang, pa.string()), pa.array(sure, pa.float64())], names=[key, "lang_pred", "score"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {kind.simpleString()}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known with a posterior of ``least`` or more."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            lang, sure = score(held.value, batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield batch.filter(pa.array([x != UNKNOWN and p >= least for x, p in zip(lang, sure)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
