"""Arrow batches inside tasks: slicing by bytes, words and hashes of whole texts in numpy.

All helpers work on UTF-8 bytes. A word is a maximal run of bytes other than space and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once; a longer single text is handled whole.
SLICE_BYTES = 1 << 21

U64 = np.uint64
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_POWER = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts laid end to end and the n + 1 offsets; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts hold at most ``limit`` bytes, or one longer text."""
    for batch in batches:
        _, at = utf8(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, batch.num_rows
        while start < n:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[raw]


def powers(n: int, base: np.uint64 = _POWER) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word and, per text, the number of the first word (n + 1 entries)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~_SEP[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(raw))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word; separators after a word count for nothing."""
    return span_hashes(raw, starts, _SEP, (ends - starts).astype(U64)) if len(starts) else np.zeros(0, U64)


def span_hashes(raw: np.ndarray, starts: np.ndarray, skip: np.ndarray | None = None, extra: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of the bytes from each start to the next one, or to the end."""
    if not len(starts):
        return np.zeros(0, U64)
    raw, starts = raw[starts[0] :], starts - starts[0]
    lengths = np.diff(np.append(starts, len(raw)))
    within = np.arange(len(raw)) - np.repeat(starts, lengths)
    value = _BYTE[raw] * powers(int(lengths.max()))[within]
    if skip is not None:
        value[skip[raw]] = 0
    return mix(np.add.reduceat(value, starts) + (lengths.astype(U64) if extra is None else extra))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` values from each place on; the last ``n - 1`` places have none."""
    if len(h) < n:
        return np.zeros(0, U64)
    size = len(h) - n + 1
    out = np.zeros(size, U64)
    for j in range(n):
        out = out * _POWER + h[j : j + size]
    return mix(out)


def starts_inside(first: np.ndarray, n: int) -> np.ndarray:
    """Which of the ``window_hashes`` places keep their ``n`` values inside one text."""
    total = int(first[-1]) if len(first) else 0
    if total < n:
        return np.zeros(0, bool)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return text[: total - n + 1] == text[n - 1 :]


def crc_rest(column: str, base: int) -> Column:
    """Rest of crc32 of a number written as text; null stays null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(base))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the folder all executors share and go on from the files."""
    import uuid

    from tidemark.session import ensure_checkpoint_dir

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
