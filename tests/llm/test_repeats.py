"""Substring and suffix-array dedup against plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from corpus_fixtures import docs, make  # noqa: F401

from tidemark.llm import repeats, substrings, suffixes


def slow_words(rows, width=20):
    """rows: (doc_id, text), one row an id."""
    seen, out = {}, {}
    for d, t in sorted(rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            x = tuple(w[i : i + width])
            if x in seen:
                gone[i : i + width] = [True] * width
            seen.setdefault(x, (d, i))
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def slow_bytes(rows, width=400):
    count = defaultdict(int)
    raws = [(t or "").encode() for _, t in rows]
    for r in raws:
        for i in range(len(r) - width + 1):
            count[hash(r[i : i + width])] += 1
    out = []
    for (d, _), r in zip(rows, raws):
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - width + 1):
            if count[hash(r[i : i + width])] > 1:
                gone[i : i + width] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((d, len(r), int(gone.sum()), len(suffixes.runs(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed, n=60):
    """Texts with copies, edits, shared passages, periodic stretches and odd white space."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "é", "日本"] * 10
    say = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passages = [say(rng.randrange(15, 400)) for _ in range(5)]
    rows, last = [], []
    for d in range(n):
        kind = rng.randrange(6)
        w = say(rng.randrange(0, 300))
        if kind == 1 and last:
            w = list(rng.choice(last))
            for _ in range(rng.randrange(4)):
                if w:
                    w[rng.randrange(len(w))] = "edit"
        elif kind == 2:
            w = w + rng.choice(passages) + say(rng.randrange(100))
        elif kind == 3:
            w = w + say(rng.randrange(1, 4)) * rng.randrange(200)
        elif kind == 4:
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            w = p[a:] + w + p + p[: a + 1]
        last.append(w)
        rows.append((d * 7 % 101, rng.choice([" ", "  ", "\n", " "]).join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_words_brute(make, seed):  # noqa: F811
    rows = corpus(seed)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove(make(*rows).repartition(5)).collect()}
    assert got == slow_words(rows) and sum(x[1] for x in got.values()) > 1000


@pytest.mark.parametrize("seed", [3, 4])
def test_bytes_brute(make, seed):  # noqa: F811
    rows = corpus(seed)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.remove(make(*rows).repartition(5)).collect())
    assert got == slow_bytes(rows) and sum(x[2] for x in got) > 5000


def test_whole_table(docs):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove(docs).collect()}
    assert got == slow_words(rows)
    found = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.remove(docs).collect())
    assert found == slow_bytes(rows)


def test_odd_rows(make):  # noqa: F811
    long = "lorem " * 200_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, "a b"), (6, "x " * 30), (6, "x " * 30), (None, "x " * 500)]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.remove(make(*rows)).collect())
    assert got == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 200_000, 199_999), (5, 2, 0), (6, 30, 29), (6, 30, 29)]
    same = "".join(chr(97 + i % 26) + str(i) for i in range(300))
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffixes.remove(make(*rows, (7, same), (7, same), (8, "é" * 250))).collect())
    n = len(same)
    assert got == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 2, 0, 0), (4, 1_200_000, 1_200_000, 1), (5, 3, 0, 0), (6, 60, 0, 0), (6, 60, 0, 0), (7, n, n, 1), (7, n, n, 1), (8, 500, 500, 1)]
    for op in (substrings, suffixes):
        assert op.remove(make()).count() == 0


def test_maximal_repeats():
    rng = random.Random(8)
    for _ in range(40):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))).encode() for _ in range(rng.randrange(1, 5))]
        want = []
        for i, s in enumerate(strings):
            flags = np.array([any(t[k : k + 6] == s[j : j + 6] and (i, j) != (m, k) for m, t in enumerate(strings) for k in range(len(t) - 5)) for j in range(max(0, len(s) - 5))], bool)
            want.append(suffixes.runs(flags))
        assert suffixes.windows(strings, 6) == want


def test_matching_statistics():
    rng = random.Random(9)
    group = [[rng.choice("ab") for _ in range(rng.randrange(60))] for _ in range(6)]
    seen, want = set(), []
    for line in group:
        flags = []
        for i in range(len(line) - substrings.WIDTH + 1):
            x = tuple(line[i : i + substrings.WIDTH])
            flags.append(x in seen)
            seen.add(x)
        want.append(substrings.runs(flags))
    assert substrings.repeated(group) == want


def test_segments_cover_each_window_once():
    rng = np.random.default_rng(3)
    for size in (0, 5, 30, 500, 3000):
        h = rng.integers(0, 50, size, dtype=np.uint64)
        first = np.sort(np.concatenate([[0, size], rng.integers(0, size + 1, 6)]))
        key, text, start, n, _, _ = repeats.segments(repeats.mix(h), first, 20, 5)
        seen = sorted((t, s + i) for t, s, k in zip(text, start, n) for i in range(k))
        assert seen == [(t, i) for t in range(len(first) - 1) for i in range(first[t + 1] - first[t] - 19)]


@pytest.mark.parametrize("rows_per_key", [1, 3])
def test_hot_keys_brute(make, monkeypatch, rows_per_key):  # noqa: F811
    monkeypatch.setattr(repeats, "HOT_ROWS", rows_per_key)
    rng = random.Random(11)
    common = [f"p{i}" for i in range(60)]
    rows = corpus(5) + [(1000 + d, " ".join([f"x{rng.randrange(50)}" for _ in range(rng.randrange(40))] + common + [f"y{rng.randrange(3)}" for _ in range(30)])) for d in range(30)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove(make(*rows).repartition(5)).collect()}
    assert got == slow_words(rows)
    found = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.remove(make(*rows).repartition(5)).collect())
    assert found == slow_bytes(rows)


def test_dense_and_sparse_arrays_agree(monkeypatch):
    rng = random.Random(12)
    cases = [["".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))).encode() for _ in range(4)] for _ in range(30)]
    cases.append([b"ab" * 300, b"x" + b"ab" * 40 + b"y", b"z"])
    want = [suffixes.windows(c, 5) for c in cases]
    monkeypatch.setattr(suffixes, "TAIL_BYTES", 0)
    assert [suffixes.windows(c, 5) for c in cases] == want
