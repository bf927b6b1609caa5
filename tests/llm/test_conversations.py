"""Prefix trie against plain Python on odd, deep and copied conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversations as C

KIND = "conv_id long, turn long, role string, text string, depth long, f1 long, part int, at long, bytes long, c1 long, pos long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def turns(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows], KIND)


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        whole = tuple(own.get(c - rest, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), kids[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    )


def check(df, rows):
    got = C.trie(df)
    assert got.columns == COLUMNS and {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got.collect()) == brute(rows)


def random_rows(seed, convs, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), convs):
        rows += [(c, t, rng.choice(["user", "bot", None]), rng.choice(words)) for t in range(rng.randint(1, longest))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,convs,longest,words", [(1, 120, 12, ["a", "b", None]), (2, 150, 4, ["", "é", "long " * 50, "x,y"])])
def test_random_conversations(turns, seed, convs, longest, words):
    rows = random_rows(seed, convs, longest, words)
    check(turns(rows), rows)


def test_odd_rows(turns):
    rows = [(None, 1, "user", "lost"), (None, None, None, None), (3, None, "user", "first"), (3, 5, "user", "same"), (3, 5, "user", "same"), (3, -2, None, "")]
    rows += [(7, None, None, None), (2**62, 1, "user", "z" * 1_000_000), (-(2**63), 0, "user", "low"), (0, 0, "ab", "c"), (5, 0, "a", "bc"), (10, 0, "", "abc")]
    check(turns(rows), rows)
    assert C.trie(turns(rows).where("false")).collect() == []
    assert C.trie(turns([(None, 1, "user", "lost")])).collect() == []


def test_equal_turns_keep_one_order(turns):
    rows = [(5, 1, "user", w) for w in "abcdef"]
    one, other = (C.trie(turns(r)).collect() for r in (rows, rows[::-1]))
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, other), key=repr) and len(one) == 7


def test_a_long_conversation_is_cut_into_ranges(spark, turns, monkeypatch):
    rng = random.Random(9)
    rows = [(10, t, "user", rng.choice("ab")) for t in range(260)] + [(11, t, "user", "a") for t in range(30)]
    rows += [(c, t, "user", "a") for c in range(20, 40) for t in range(5)]
    monkeypatch.setattr(C, "DEPTHS", 64)
    monkeypatch.setattr(C, "IDS", 3)
    rows += [(100, t, "user", x[3]) for t, x in enumerate(rows[:90])]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(turns(rows), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_copies(turns):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 1500, 5) for t in range(3)] + [(1, 0, "user", "turn 0")]
    check(turns(rows), rows)


def test_colliding_names_are_noticed_and_another_attempt_made(turns, monkeypatch):
    rows = random_rows(4, 40, 5, ["a", "b", "c"])
    asked = []
    real = C.contents

    def clashing(df, attempt):
        asked.append(attempt)
        named = real(df, attempt)
        return named.withColumns({"c1": C.F.lit(0).cast("bigint"), "c2": C.F.lit(0).cast("bigint")}) if attempt == 0 else named

    monkeypatch.setattr(C, "contents", clashing)
    check(turns(rows), rows)
    assert asked == [0, 1]


def test_colliding_fingerprints_are_noticed(turns, monkeypatch):
    rows = random_rows(5, 40, 5, ["a", "b", "c"])
    real, used = C.Fields.power, []

    def flat(self, lane, n):
        used.append(self.attempt)
        return C.F.lit(0).cast("bigint") if self.attempt == 0 else real(self, lane, n)

    monkeypatch.setattr(C.Fields, "power", flat)
    check(turns(rows), rows)
    assert set(used) == {0, 1}
