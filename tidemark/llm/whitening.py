"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred distinct rows.

The rows stay where they are, packed as matrices; a step is one pass that forms the rows' products with a right
vector and, from these, the transposed product. What leaves a task are sums of as many numbers as a vector has entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import stored

#: Factor from an entry to its whole number.
SCALE = 256.0
#: Bytes of one packed matrix of rows.
CHUNK_BYTES = 1 << 20
#: Entries handled at once.
SLICE = 1 << 21
#: A scaled entry of this size or more is no long.
LONG_END = float(1 << 63)
_LOW = np.int64((1 << 31) - 1)


@dataclass(frozen=True)
class Components:
    """Mean as sums over ``n`` rows, unit components (one a row), their variances and the total variance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


# -- whole-number rows -----------------------------------------------------------------------


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of all lists laid end to end, the n + 1 offsets, and which rows can be used."""
    at = np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths().fill_null(0)), dtype=np.int64)])
    flat = column.flatten()
    bad = np.asarray(flat.is_null()).astype(bool)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
        bad |= ~np.isfinite(values) | ~(np.abs(scaled) < LONG_END)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    usable = ~np.asarray(column.is_null()).astype(bool) & (wrong[at[1:]] == wrong[at[:-1]])
    scaled[bad] = 0.0
    return scaled.astype(np.int64), at, usable


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows, about ``SLICE`` entries at a time."""
    for batch in batches:
        entries = len(batch.column(column).flatten())
        step = max(1, batch.num_rows * SLICE // max(1, entries))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _keys():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 0):
            whole, at, usable = _rows(batch.column(0))
            small = np.abs(whole) < 1 << 15
            keys, dims = [], []
            for i in np.flatnonzero(usable):
                part = slice(at[i], at[i + 1])
                # the width follows from the entries, so equal rows have equal bytes
                keys.append(whole[part].astype("<i2" if small[part].all() else "<i8").tobytes() + bytes([bool(small[part].all())]))
                dims.append(at[i + 1] - at[i])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(dims, pa.int32())], ["key", "dim"])

    return run


def _pack(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = max(1, CHUNK_BYTES // (8 * dim))
        held: list[bytes] = []

        def chunk(rows: list[bytes]) -> pa.RecordBatch:
            narrow = all(r[-1] for r in rows)
            wide = [r[:-1] if narrow or not r[-1] else np.frombuffer(r[:-1], "<i2").astype("<i8").tobytes() for r in rows]
            return pa.RecordBatch.from_arrays([pa.array([b"".join(wide)], pa.binary()), pa.array([narrow])], ["rows", "narrow"])

        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= room:
                yield chunk(held[:room])
                held = held[room:]
        if held:
            yield chunk(held)

    return run


def fit_list(embeddings: DataFrame, vectors: str = "embedding") -> tuple[DataFrame, int]:
    """Distinct usable rows as packed matrices (``rows``, ``narrow``) and their length.

    Rows of another length than most have are left out (of two equally common lengths the smaller stays). Equal
    rows are combined before the shuffle, so a vector that a third of all rows hold adds one row a task.
    """
    keys = embeddings.select(vectors).mapInArrow(_keys(), "key binary, dim int")
    distinct = stored(keys.groupBy("key", "dim").agg(F.count("*").alias("n")))
    common = distinct.where("dim > 0").groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = common["dim"] if common else 0
    packed = distinct.where(F.col("dim") == dim).select("key").mapInArrow(_pack(max(dim, 1)), "rows binary, narrow boolean")
    return stored(packed), dim


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw, narrow in zip(batch.column(0), batch.column(1)):
            yield np.frombuffer(raw.as_buffer(), "<i2" if narrow.as_py() else "<i8").reshape(-1, dim)


def _totals(chunks: DataFrame, dim: int, work, size: int, kind: str = "double") -> list:
    """Sum over all chunks of ``work(matrix)``, ``size`` numbers; combined in each task, then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for matrix in _matrices(batches, dim):
            part = work(matrix)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["place", "part"])

    parts = chunks.mapInArrow(run, f"place int, part {kind}")
    summed = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)") if kind == "bigint" else F.col("part")).alias("part"))
    found = {r["place"]: r["part"] for r in summed.collect()}  # ``size`` numbers, whatever the number of rows
    return [found.get(i, 0) for i in range(size)]


def _column_sums(chunks: DataFrame, dim: int) -> tuple[int, tuple[int, ...]]:
    """Number of rows and exact sums by dimension, in two halves so that no partial sum leaves a long."""

    def work(matrix: np.ndarray) -> np.ndarray:
        wide = matrix.astype(np.int64)
        return np.concatenate([[len(wide)], (wide & _LOW).sum(axis=0), (wide >> 31).sum(axis=0)])

    found = [int(x) for x in _totals(chunks, dim, work, 2 * dim + 1, "bigint")]
    return found[0], tuple(low + (high << 31) for low, high in zip(found[1 : dim + 1], found[dim + 1 :]))


# -- bidiagonalisation ------------------------------------------------------------------------


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """What is left of a vector outside the basis; taken out twice, as once leaves rounding behind."""
    for _ in range(2):
        for b in basis:
            vector = vector - (b @ vector) * b
    return vector


def bidiagonalise(chunks: DataFrame, mean: np.ndarray, steps: int | None = None, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (one a row) and the upper bidiagonal matrix of the centred rows X.

    Step k forms p = X v_k, takes out all earlier left vectors, and from u_k = p / alpha the product X'u_k, from which all
    earlier right vectors are taken out: full reorthogonalisation on both sides. A left vector is as long as the
    table and is never gathered: it is kept as the y with u = X y, so its products with others are small sums already
    known (u_j'X z = (X'u_j)'z). When nothing is left of a vector, the walk goes on from a new direction, so that repeated
    variances are found too. It ends when all dimensions are used up, or after ``steps``.
    """
    dim = len(mean)
    rng = np.random.default_rng(seed)
    right: list[np.ndarray] = []  # v
    back: list[np.ndarray] = []  # X'u
    left: list[np.ndarray] = []  # y
    alphas, betas = [], []
    fresh = rng.standard_normal(dim)
    vector = fresh / np.linalg.norm(fresh)
    beta, largest = 0.0, 0.0

    def product(z: np.ndarray):
        def work(matrix: np.ndarray) -> np.ndarray:
            centred = matrix - mean
            u = centred @ z
            return np.concatenate([[u @ u], centred.T @ u])

        return work

    for _ in range(min(dim, steps or dim)):
        z = vector.copy()
        for _ in range(2):  # left vectors out of p = X z
            for y, w in zip(left, back):
                z = z - (w @ z) * y
        found = np.array(_totals(chunks, dim, product(z), dim + 1), float)
        alpha = float(np.sqrt(max(found[0], 0.0)))
        right.append(vector)
        betas.append(beta)
        largest = max(largest, alpha, beta)
        if alpha <= 1e-12 * largest or alpha == 0.0:  # this direction holds nothing new
            alphas.append(0.0)
            rest = np.zeros(dim)
        else:
            alphas.append(alpha)
            left.append(z / alpha)
            back.append(found[1:] / alpha)
            rest = _orthogonal(back[-1], right)
        beta = float(np.linalg.norm(rest))
        if beta <= 1e-12 * largest:
            beta = 0.0
            rest = _orthogonal(rng.standard_normal(dim), right)
        size = np.linalg.norm(rest)
        if size <= 1e-9:
            break
        vector = _orthogonal(rest / size, right)
        vector = vector / np.linalg.norm(vector)
    matrix = np.diag(alphas) + np.diag(betas[1:], 1)
    return np.array(right), matrix


def fit(embeddings: DataFrame, count: int = 4, vectors: str = "embedding", steps: int | None = None) -> Components:
    """Components of the distinct whole-number rows by falling variance, at most ``count``.

    Every pass reads the packed rows once; there are as many as dimensions, or ``steps`` (then repeated and
    close variances may be told apart less sharply). Components without variance are left out, so constant rows,
    one row or none give no component. The entry of largest size of each component is positive.
    """
    chunks, dim = fit_list(embeddings, vectors)
    if not dim:
        return Components(0, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    n, sums = _column_sums(chunks, dim)
    if n == 1:
        return Components(n, sums, np.zeros((0, dim)), np.zeros(0), 0.0, 0.0)
    mean = np.array([s / n for s in sums])
    right, small = bidiagonalise(chunks, mean, steps)
    _, sizes, turns = np.linalg.svd(small)
    kept = [i for i in range(min(count, len(sizes))) if sizes[i] > 1e-10 * sizes[0]]
    found = turns[kept] @ right
    for v in found:
        v /= np.linalg.norm(v)
        # of entries that are as large but for rounding, the first one says the sign
        v *= np.sign(v[np.argmax(np.abs(v) > (1 - 1e-9) * np.abs(v).max())])
    variances = sizes[kept] ** 2 / n
    k = len(kept)

    def spread(matrix: np.ndarray) -> np.ndarray:
        centred = matrix - mean
        return np.concatenate([[(centred**2).sum()], ((centred @ found.T) / np.sqrt(variances)).sum(axis=0)])

    first = np.array(_totals(chunks, dim, spread, k + 1), float)
    middle = first[1:] / n

    def gram(matrix: np.ndarray) -> np.ndarray:
        white = ((matrix - mean) @ found.T) / np.sqrt(variances) - middle
        return (white.T @ white).ravel()

    error = 0.0
    if k:
        covariance = np.array(_totals(chunks, dim, gram, k * k), float).reshape(k, k) / n
        error = float(np.abs(covariance - np.eye(k)).max())
    return Components(n, sums, found, variances, float(first[0] / n), error)


# -- rows -------------------------------------------------------------------------------------


def _deviations(rows: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2; null where it is no long."""
    reach = np.abs(rows).max(initial=0) * float(n) + max(abs(s) for s in sums)
    if len(sums) * reach * reach < 2.0**62:
        return ((rows * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in rows.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(embeddings: DataFrame, model: Components, vectors: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    Null vectors, vectors with null or non-finite entries, with entries that are no long after scaling, or of
    another length than the model are left out; repeated rows and null ids are rows like any other. ``deviation`` is
    null where it exceeds a long. Other columns are not read. Without components there are no rows.
    """
    dim, mean, turn = len(model.sums), model.mean if model.n else None, model.vectors
    spread, explained = np.sqrt(model.variances), (model.variances / model.trace if model.trace else model.variances)
    k, n, sums, error = len(turn), model.n, model.sums, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 1):
            if not k:
                continue
            whole, at, usable = _rows(batch.column(1))
            usable &= np.diff(at) == dim
            pick = np.flatnonzero(usable)
            if not len(pick):
                continue
            rows = whole[(at[:-1][pick, None] + np.arange(dim))]
            white = ((rows - mean) @ turn.T) / spread
            m = len(pick)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(pick, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array([d for d in _deviations(rows, n, sums) for _ in range(k)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = dict(embeddings.dtypes)["vec_id"]
    return embeddings.select("vec_id", vectors).mapInArrow(
        run, f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
