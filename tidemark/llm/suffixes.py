"""Suffix-array dedup: bytes of long strings that stand more than once, as maximal repeats of an enhanced suffix array."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats

WIDTH = 400
GRAM = 32
PLAN = repeats.Plan(WIDTH, GRAM, repeats.byte_symbols, every=True)
#: Bytes of segments in one enhanced suffix array; whole keys only, so one key's segments may be more.
ARRAY_BYTES = 1 << 20
#: Bytes of suffixes held at once for the sparse array.
TAIL_BYTES = 1 << 26


def enhanced(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and the common prefix of each suffix with the one before it, by prefix doubling.

    ``text`` holds small numbers, and a mark of its own after every string, so no common prefix crosses one.
    """
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    levels, size = [rank], 1
    order = np.argsort(rank, kind="stable")
    while size < n and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[: n - size] = rank[size:] + 1
        pair = rank * (n + 1) + second
        order = np.argsort(pair, kind="stable")
        step = np.concatenate([[0], np.cumsum(np.diff(pair[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = step
        levels.append(rank)
        size *= 2
    a, b = order[1:].copy(), order[:-1].copy()
    common = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        alike = np.zeros(n - 1, bool)
        ok = (a < n) & (b < n)
        alike[ok] = levels[k][a[ok]] == levels[k][b[ok]]
        common[1:][alike] += 1 << k
        a[alike] += 1 << k
        b[alike] += 1 << k
    return order, common


def maximal_repeats(order: np.ndarray, common: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Length and all places of every maximal repeat of at least ``least`` symbols.

    A stack scan over the enhanced suffix array closes the intervals of common prefix one after the other, from
    the inside out. An interval is a maximal repeat if the symbols ``before`` its suffixes differ; each entry
    of the stack carries that symbol, or the fact that they differ, up to the interval around it.
    """
    diverse = -(1 << 62)
    long = common >= least
    starts = np.flatnonzero(long & ~np.concatenate([[False], long[:-1]]))
    stops = np.flatnonzero(~long & np.concatenate([[False], long[:-1]]))
    if len(stops) < len(starts):
        stops = np.append(stops, len(order))
    for s, e in zip(starts.tolist(), stops.tolist()):
        heights, lefts = common[s:e].tolist(), before[s - 1 : e].tolist()
        stack: list[list[int]] = []  # height, first row, what stands before
        for i in range(e - s + 1):
            height = heights[i] if i < e - s else -1
            first, left = i, lefts[i]
            while stack and stack[-1][0] > height:
                top, first, held = stack.pop()
                left = held if held == left else diverse
                if left == diverse:
                    yield top, order[s - 1 + first : s + i]
            if height < 0:
                break
            if stack and stack[-1][0] == height:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == left else diverse
            else:
                stack.append([height, first, left])


def pieces(text: str, parts: list) -> list[bytes]:
    raw = text.encode()
    return [raw[p["start"] : p["start"] + p["n"] + WIDTH - 1] for p in parts]


def windows(strings: list[bytes], width: int) -> list[list[tuple[int, int]]]:
    """For each string the runs of windows that lie in a maximal repeat of all strings together."""
    sizes = np.array([len(s) for s in strings])
    begin = np.cumsum(sizes) - sizes
    n = np.maximum(0, sizes - width + 1)
    raw = b"".join(strings)
    places, end, before = left_diverse(raw, begin, n, sizes, width)
    edge = np.zeros(len(raw) + 1, np.int64)
    if len(places):
        if int((end - places).sum()) <= TAIL_BYTES:
            found = sparse(raw, places, end, before)
        else:
            found = dense(strings, begin)
        for length, at in maximal_repeats(*found, width):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length - width + 1, -1)
    starts = np.cumsum(edge[:-1]) > 0
    return [runs(starts[a : a + k]) for a, k in zip(begin.tolist(), n.tolist())]


def left_diverse(raw: bytes, begin: np.ndarray, n: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose window stands elsewhere with another symbol before it, the ends of their strings, and
    that symbol.

    A window that has the same symbol before it everywhere is inside a repeat that starts further left, so every place
    of every maximal repeat is among these. Windows are brought together by their hashes; the arrays compare the bytes.
    """
    code = np.frombuffer(raw, np.uint8)
    string = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n) + begin[string]
    if len(at) < 2:
        return at[:0], at[:0], at[:0]
    hashed = repeats.gram_hashes(repeats.byte_symbols(code, begin)[0], width)[at]
    order = np.argsort(hashed)
    hashed = hashed[order]
    head = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1]]))
    size = np.diff(np.append(head, len(order)))
    before = code[at - 1].astype(np.int64)
    first = at == begin[string]
    before[first] = -2 - at[first]  # the start of a string is like no other symbol
    before = before[order]
    diverse = np.logical_or.reduceat(before != np.repeat(before[head], size), head)
    chosen = np.repeat(diverse, size)
    rows = order[chosen]
    return at[rows], begin[string[rows]] + sizes[string[rows]], before[chosen]


def sparse(raw: bytes, places: np.ndarray, end: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Enhanced suffix array of the suffixes at ``places``, each up to its ``end``."""
    tails = [raw[a:b] for a, b in zip(places.tolist(), end.tolist())]
    order = sorted(range(len(tails)), key=tails.__getitem__)
    common = [0, *(common_prefix(tails[a], tails[b]) for a, b in zip(order, order[1:]))]
    return places[order], np.array(common), before[order]


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def dense(strings: list[bytes], begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Enhanced suffix array of all suffixes, for strings with long periods; places as in the strings laid end to end."""
    marked = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int64), 256 + i) for i, s in enumerate(strings)])
    order, common = enhanced(marked)
    is_mark = marked >= 256
    before = np.where(order > 0, np.where(is_mark[order - 1], -2 - order, marked[order - 1]), -2 - order)
    shift = np.cumsum(is_mark) - is_mark
    return order - shift[order], common, before


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    x = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(x[::2].tolist(), (x[1::2] - x[::2]).tolist()))


def resolve(t: pa.Table) -> Iterator[pa.RecordBatch]:
    key, doc, h, start, kind = (t.column(c).to_numpy() for c in ("key", "doc_id", "h", "start", "kind"))
    content = t.column("content").to_pylist()
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]).tolist()
    rows, a = [], 0
    while a < len(key):
        # whole keys up to the size of an array; strings of other keys share no window, so they may share an array
        b, size = a, 0
        for stop in bounds[bisect_right(bounds, a) :]:
            more = sum(len(c) for c in content[b:stop])
            if b > a and size + more > ARRAY_BYTES:
                break
            b, size = stop, size + more
        for i, found in enumerate(windows(content[a:b], WIDTH), a):
            if not kind[i] & repeats.MANY:
                rows += [(doc[i], h[i], start[i] + s, n) for s, n in found]
        a = b
    if rows:
        d, hh, s, n = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(hh, pa.int32()), pa.array(s, pa.int32()), pa.array(n, pa.int32())], names=["doc_id", "h", "start", "n"])


def remove(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row with an id.

    A byte goes if a string of ``WIDTH`` bytes over it also starts anywhere else, in the same document or another.
    Texts are UTF-8, null ones empty, and strings never cross texts. Each row is a document of its own, also where ids
    or texts repeat. ``kept`` is binary, as a cut may fall into a character. Rows with a null id are left
    out; other columns are ignored.

    Strings meet by key (see ``repeats``). What only one content stands for is settled by its number; contents that
    share a key and differ are laid into enhanced suffix arrays, whose maximal repeats give all occurrences.
    """
    own = repeats.identified(docs)
    spans = repeats.spans_of(own, PLAN, pieces, resolve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, n_spans, digest, left = [], [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode()
                size.append(len(raw))
                if found:
                    gone = repeats.covered(found, WIDTH, len(raw))
                    removed.append(int(gone.sum()))
                    n_spans.append(len(runs(gone)))
                    raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                else:
                    removed.append(0)
                    n_spans.append(0)
                digest.append(hashlib.sha256(raw).hexdigest())
                left.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string()), pa.array(left, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    joined = own.join(spans.hint("shuffle_hash"), ["doc_id", "h"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
