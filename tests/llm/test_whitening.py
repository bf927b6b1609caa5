"""Whitening against numpy's eigenvectors, exact deviations, and odd rows."""

import math

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int, key binary, component int, n long, rows binary"


@pytest.fixture(scope="module")
def vectors(spark):
    return lambda *rows: spark.createDataFrame([(i, v, 0, b"x", 9, 9, b"y") for i, v in rows], KIND)


def brute(rows, count=4):
    """Rows by plain numpy and whole numbers; the sign of a component by its largest entry."""
    usable = []
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        usable.append((i, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    dims = [len(x) for _, x in usable if x]
    if not dims:
        return {}, 0
    dim = min(set(dims), key=lambda d: (-dims.count(d), d))
    usable = [(i, x) for i, x in usable if len(x) == dim]
    fit = sorted({x for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array(fit, float) - np.array([s / n for s in sums])
    values, vecs = np.linalg.eigh(m.T @ m / n)
    order = [j for j in np.argsort(-values)[:count] if values[j] > 1e-9 * max(values.max(), 1e-300)]
    out = {}
    for i, x in usable:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k, j in enumerate(order):
            v = vecs[:, j] * np.sign(vecs[np.argmax(np.abs(vecs[:, j])), j])
            white = float((np.array(x, float) - np.array([s / n for s in sums])) @ v / math.sqrt(values[j]))
            out.setdefault((i, k + 1), []).append((n, deviation, white, values[j] / np.trace(m.T @ m / n)))
    return out, n


def check(df, rows, tolerance=1e-9):
    got = whitening.whiten(df, whitening.fit(df)).collect()
    want, _ = brute(rows)
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        n, deviation, white, explained = want[(r["vec_id"], r["component"])][0]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["whitened"] == pytest.approx(white, abs=tolerance * max(1, abs(white)))
        assert r["explained"] == pytest.approx(explained, rel=1e-9) and 0 <= r["identity_error"] < 1e-9
    return got


def test_whole_table_matches_eigenvectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {(r["vec_id"], r["component"]): r for r in QUERIES["op12_whitening"](spark, "/root/testdata/sf0.01").collect()}
    want, n = brute(rows)
    assert got.keys() == want.keys() and len(got) == 4 * len(rows)
    assert max(abs(got[k]["whitened"] - v[0][2]) for k, v in want.items()) < 1e-9
    assert all(got[k]["deviation"] == v[0][1] and got[k]["n"] == n for k, v in want.items())


def test_odd_rows_copies_and_lengths(vectors):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(None, rows[1][1]), (7, rows[2][1])]
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [1.0, math.nan, 1.0, 1.0, 1.0]), (204, [math.inf] * 5), (205, [1.0, 2.0]), (206, [3e38] * 5)]
    rows += [(300, [200.0, -300.0, 0.0, 1.0, 5.0])]  # beyond sixteen bits
    df = vectors(*rows)
    model = whitening.fit(df)
    usable = [(i, v) for i, v in rows if i != 206]
    assert model.n == brute(usable)[1] == 61
    # id 7 has two vectors and null ids are rows: compare as lists
    got = sorted((str(r["vec_id"]), r["component"], r["deviation"], round(r["whitened"], 8) + 0.0) for r in whitening.whiten(df, model).collect())
    want = sorted((str(i), k, d, round(w, 8) + 0.0) for (i, k), many in brute(usable)[0].items() for _, d, w, _ in many)
    assert got == want


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(vectors, rows):
    df = vectors(*rows) if rows else vectors((1, None)).where("false")
    assert whitening.whiten(df, whitening.fit(df)).collect() == []


def test_low_rank_and_constant_dimensions(vectors):
    rng = np.random.default_rng(2)
    rows = [(i, [float(a), 3.0, float(a) * 2, float(b), 0.0, -float(b)]) for i, (a, b) in enumerate(rng.integers(-50, 50, (80, 2)))]
    got = check(vectors(*rows), rows, 1e-7)
    assert {r["component"] for r in got} == {1, 2}


def test_repeated_variances_are_all_found(vectors):
    rows = [(2 * j + s, [float((1 - 2 * s) * 3) if k == j else 0.0 for k in range(6)]) for j in range(6) for s in (0, 1)]
    df = vectors(*rows)
    model = whitening.fit(df)
    assert len(model.variances) == 4 and np.ptp(model.variances) < 1e-6 * model.variances[0]
    assert model.identity_error < 1e-9 and np.allclose(model.vectors @ model.vectors.T, np.eye(4), atol=1e-12)


def test_wide_spread_of_variances(vectors):
    rng = np.random.default_rng(3)
    turn, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    data = (rng.normal(size=(300, 12)) * np.logspace(3, -1, 12)) @ turn
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(data)]
    check(vectors(*rows), rows, 1e-8)


def test_sums_beyond_a_long(vectors):
    rows = [(i, [float(np.float32(x)) for x in (2.0**52, -(2.0**52) * i, 1.0)]) for i in range(8)]
    df = vectors(*rows)
    model = whitening.fit(df)
    assert model.sums == tuple(sum(math.floor(256 * v[j]) for _, v in rows) for j in range(3))
    deviation = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df, model).collect()}
    assert set(deviation.values()) == {None}


def test_bidiagonal_factors_are_orthogonal(spark, vectors):
    rng = np.random.default_rng(4)
    data = rng.integers(-100, 100, (50, 8))
    chunks, dim = whitening.fit_list(vectors(*[(i, (v / 256).tolist()) for i, v in enumerate(data)]))
    x = data - data.mean(axis=0)
    right, small = whitening.bidiagonalise(chunks, data.mean(axis=0))
    assert np.allclose(right @ right.T, np.eye(8), atol=1e-13) and np.allclose(np.tril(small, -1), 0) and np.allclose(np.triu(small, 2), 0)
    left = x @ right.T @ np.linalg.inv(small)
    assert np.allclose(left.T @ left, np.eye(8), atol=1e-10)
    assert np.allclose(np.linalg.svd(small)[1], np.linalg.svd(x)[1], rtol=1e-12)
