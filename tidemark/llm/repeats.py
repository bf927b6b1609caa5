"""Bringing together the places where long repeated windows may be, shared by the substring operators.

A window is ``width`` symbols of one text. Its key is the smallest hash of the ``gram``-symbol strings in it, so
equal windows have equal keys wherever they stand; neighbouring windows mostly share theirs, and a run
of windows with one key is a segment. Only segments that meet another one under their key need looking at, and
of those only one of each content: the steps before that move a few numbers per segment and no text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import U64, by_bytes, mix, powers, stored, utf8, word_hashes, words

#: Windows in one segment at most.
LONGEST = 1 << 16
_Q = U64(0xD1342543DE82EF95)
_Q_INVERSE = U64(pow(int(_Q), -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))

SEGMENT = "key long, doc_id long, h int, start int, n int, body long, kind int"
#: Bits of ``kind``: the content stands more than once, the row is done, it is to be looked into, and the key's
#: string stands twice in the segment, so that a window may repeat within it.
MANY, DONE, NEED, TWICE, HOT = 1, 2, 4, 8, 16
#: Bytes of text whose symbols are hashed at once; each takes up to a hundred bytes meanwhile.
PART_BYTES = 1 << 19
#: Segments under one key from which on they no longer meet in one task.
HOT_ROWS = 50_000


@dataclass(frozen=True)
class Plan:
    """``symbols`` gives symbol hashes and the first symbol of each text; ``every`` says that all
    occurrences of a repeated window count, not just those after the first."""

    width: int
    gram: int
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    every: bool


def word_symbols(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(raw, at)
    return word_hashes(raw, starts, ends), first


def byte_symbols(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _BYTES[raw], at


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` symbols from each place on, put together from powers of two."""
    out, at, part, size = None, 0, h, 1
    while n:
        if n & 1:
            piece = part[at:]
            out = piece if out is None else out[: len(piece)] * U64(0x9E3779B97F4A7C15) + piece
            at += size
        n >>= 1
        if n:
            part = mix(part[: len(part) - size] * _Q + part[size:]) if len(part) > size else part[:0]
            size *= 2
    return mix(out)


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of ``w`` values from each place on."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    full = np.full(-(-len(x) // w) * w, U64(0xFFFFFFFFFFFFFFFF))
    full[: len(x)] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def segments(h: np.ndarray, first: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Key, text, first window, number of windows, content digest and ``TWICE`` bit of every segment."""
    none = np.zeros(0, np.int64)
    nothing = np.zeros(0, U64), none, none, none, np.zeros(0, U64), none
    size = len(h) - width + 1
    if size <= 0:
        return nothing
    reach = width - gram + 1
    grams = gram_hashes(h, gram)
    least = sliding_least(grams, reach)[:size]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = text[:size] == text[width - 1 :]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (text[1:size] != text[: size - 1])
    at = np.flatnonzero(begins)
    if not len(at):
        return nothing
    ends_before = np.append(at[1:], size)
    count = np.concatenate([[0], np.cumsum(inside)])
    n = count[ends_before] - count[at]
    if n.max() > LONGEST:
        pieces = -(-n // LONGEST)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at, n = np.repeat(at, pieces) + within * LONGEST, np.repeat(n, pieces)
        n = np.minimum(LONGEST, n - within * LONGEST)
    up, down = powers(len(h), _Q), powers(len(h), _Q_INVERSE)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(h * up[: len(h)], dtype=U64)])
    digest = mix((total[at + n + width - 1] - total[at]) * down[at] + n.astype(U64))
    twice = np.zeros(len(at), np.int64)
    long = np.flatnonzero(n > 1)
    span = n[long] + reach - 1
    ends = np.cumsum(span)
    if len(long):
        own = grams[np.repeat(at[long] - ends + span, span) + np.arange(ends[-1])] == np.repeat(least[at[long]], span)
        twice[long] = np.where(np.add.reduceat(own, ends - span, dtype=np.int64) > 1, TWICE, 0)
    return least[at], text[at], at - first[text[at]], n, digest, twice


def table_of(key, doc, h, start, n, body, kind) -> pa.RecordBatch:
    columns = [(key, np.int64), (doc, np.int64), (h, np.int32), (start, np.int32), (n, np.int32), (body, np.int64), (kind, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).astype(t, copy=False)) for c, t in columns], names=["key", "doc_id", "h", "start", "n", "body", "kind"])


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a short hash ``h`` of it, which tells texts under one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null").withColumn("h", F.hash("text"))


def cut(docs: DataFrame, plan: Plan) -> DataFrame:
    """Segments of all texts. Equal segments of one batch are combined: of them the first goes on, and the
    others are done, as they are repeats whatever else there is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for part in by_bytes(iter([batch]), "text", PART_BYTES):
                h, first = plan.symbols(*utf8(part.column("text")))
                key, text, start, n, digest, twice = segments(h, first, plan.width, plan.gram)
                held.append((key.view(np.int64), part.column("doc_id").to_numpy()[text], part.column("h").to_numpy()[text], start, n, digest.view(np.int64), twice))
            if not held:
                continue
            key, doc, h, start, n, body, twice = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((start, doc, body, key))
            key, doc, h, start, n, body, twice = (c[order] for c in (key, doc, h, start, n, body, twice))
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (body[1:] == body[:-1])
            head = np.flatnonzero(~same)
            size = np.diff(np.append(head, len(key)))
            kind = np.where(size > 1, MANY, 0) | twice[head]
            yield table_of(key[head], doc[head], h[head], start[head], n[head], body[head], kind)
            group = np.repeat(np.arange(len(head)), size)
            done = np.flatnonzero(size[group] > 1) if plan.every else later(key, body, doc, start)
            if len(done):
                spread = mix(body[done].view(U64) + np.arange(len(done), dtype=U64)).view(np.int64)
                yield table_of(spread, doc[done], h[done], start[done], n[done], body[done], np.full(len(done), DONE))

    return docs.mapInArrow(run, SEGMENT)


def later(key: np.ndarray, body: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows, sorted by key, body, document and start, that a smaller (document, start) precedes."""
    if not len(key):
        return np.zeros(0, np.int64)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (body[1:] != body[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    return np.flatnonzero((doc != doc[head]) | (start != start[head]))


def meet(cut_segments: DataFrame, plan: Plan, hot: bool = False) -> DataFrame:
    """Segments under their keys: what is done, and of each content under a key with several one row to look into.

    ``hot`` keys are dealt by content too, so no task gets all of one, and every content is to be looked into.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            done = (batch.column("kind").to_numpy() & DONE) > 0
            if done.any():
                yield batch.filter(pa.array(done))
            if not done.all():
                held.append(batch.filter(pa.array(~done)))
        if not held:
            return
        t = pa.Table.from_batches(held)
        key, doc, h, start, n, body, kind = (t.column(c).to_numpy() for c in ("key", "doc_id", "h", "start", "n", "body", "kind"))
        del t, held
        order = np.lexsort((start, doc, body, key))
        key, doc, h, start, n, body, kind = (c[order] for c in (key, doc, h, start, n, body, kind))
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_body = new_key.copy()
        new_body[1:] |= body[1:] != body[:-1]
        head = np.flatnonzero(new_body)
        size = np.diff(np.append(head, len(key)))
        many = (size > 1) | (np.bitwise_or.reduceat(kind, head) & MANY > 0)
        of_key = np.cumsum(new_key) - 1
        group = np.repeat(np.arange(len(head)), size)
        done = np.flatnonzero((size > 1)[group]) if plan.every else later(key, body, doc, start)
        if len(done):
            yield table_of(key[done], doc[done], h[done], start[done], n[done], body[done], np.full(len(done), DONE))
        mixed = np.bincount(of_key[head]) > 1
        twice = kind[head] & TWICE > 0
        if plan.every:  # contents that stand more than once are done; the others may hold windows of theirs
            mixed &= np.bincount(of_key[head], weights=~many) > 0
            twice &= ~many
        asked = np.full(len(head), True) if hot else mixed[of_key[head]] | twice
        need = head[asked]
        if len(need):
            flags = (HOT if hot else NEED) | np.where(many[asked], MANY, 0)
            yield table_of(key[need], doc[need], h[need], start[need], n[need], body[need], flags)

    return cut_segments.repartition(*(("key", "body") if hot else ("key",))).mapInArrow(run, SEGMENT)


def gathered(segs: DataFrame, plan: Plan) -> DataFrame:
    """``meet`` for all keys, those of more than ``HOT_ROWS`` segments in the way of hot ones."""
    rows = segs.where(F.col("kind").bitwiseAND(F.lit(DONE)) == 0).groupBy("key").agg(F.count("*").alias("_n"))
    hot = stored(rows.where(F.col("_n") > HOT_ROWS).select("key", F.lit(True).alias("_hot")))
    if hot.isEmpty():
        return meet(segs, plan)
    marked = segs.join(hot, "key", "left")
    cold = marked.where("_hot is null").drop("_hot")
    return meet(cold, plan).unionByName(meet(marked.where("_hot").drop("_hot"), plan, hot=True))


def hot_windows(fetched: DataFrame, plan: Plan) -> DataFrame:
    """Repeated windows of hot keys' contents, told by 128 bits of hash, since their texts cannot meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "content", 1 << 17):
            symbols, first = plan.symbols(*utf8(batch.column("content")))
            n = batch.column("n").to_numpy()
            at = np.repeat(first[:-1], n) + (within := np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            take = np.repeat(np.arange(len(n)), n)
            one, two = (gram_hashes(mix(symbols ^ U64(salt)), plan.width)[at].view(np.int64) for salt in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(one), pa.array(two), batch.column("doc_id").take(pa.array(take)), batch.column("h").take(pa.array(take)), pa.array((batch.column("start").to_numpy()[take] + within).astype(np.int32)), batch.column("kind").take(pa.array(take))],
                names=["w1", "w2", "doc_id", "h", "start", "kind"],
            )

    rows = fetched.dropDuplicates(["key", "doc_id", "h", "start"]).mapInArrow(run, "w1 long, w2 long, doc_id long, h int, start int, kind int")
    many = F.col("kind").bitwiseAND(F.lit(MANY)) > 0
    if plan.every:
        again = rows.groupBy("w1", "w2").agg(F.sum(F.when(many, 2).otherwise(1)).alias("_n")).where("_n > 1")
        found = rows.where(~many).join(again, ["w1", "w2"])
    else:
        least = rows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "start")).alias("_least"), F.count("*").alias("_n")).where("_n > 1")
        found = rows.join(least, ["w1", "w2"]).where(F.struct("doc_id", "start") > F.col("_least"))
    return found.select("doc_id", "h", "start", F.lit(1).alias("n"))


def fetch(docs: DataFrame, need: DataFrame, piece: Callable[[str, list], list[bytes]]) -> DataFrame:
    """The segments of ``need`` with their content, which ``piece`` cuts out of a text."""
    asked = need.groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "n", "key", "kind")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            doc_of, h_of, rows, content = [], [], [], []
            for doc, h, text, parts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "text", "parts"))):
                rows += parts
                content += piece(text, parts)
                doc_of += [doc] * len(parts)
                h_of += [h] * len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["key"] for r in rows], pa.int64()), pa.array(doc_of, pa.int64()), pa.array(h_of, pa.int32()), pa.array([r["start"] for r in rows], pa.int32()), pa.array([r["n"] for r in rows], pa.int32()), pa.array([r["kind"] for r in rows], pa.int32()), pa.array(content, pa.binary())],
                names=["key", "doc_id", "h", "start", "n", "kind", "content"],
            )

    return docs.join(asked.hint("shuffle_hash"), ["doc_id", "h"]).select("doc_id", "h", "text", "parts").mapInArrow(run, "key long, doc_id long, h int, start int, n int, kind int, content binary")


def once(batches: list[pa.RecordBatch]) -> pa.Table:
    """The rows as a table; a row repeated under one id has its segments once."""
    t = pa.Table.from_batches(batches)
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in ("key", "doc_id", "start", "h"):
        x = t.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return t if new.all() else t.filter(pa.array(new))


def by_key(fetched: DataFrame, resolve: Callable[[pa.Table], Iterator[pa.RecordBatch]], rows: int = 20_000) -> DataFrame:
    """Hand ``resolve`` whole keys, many at a time, sorted by key, document and start; it gives repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if n >= rows:
                key = batch.column("key").to_numpy()
                other = np.flatnonzero(key != held[-1].column("key")[held[-1].num_rows - 1].as_py())
                k = int(other[0]) if len(other) else batch.num_rows
                if k:
                    held.append(batch.slice(0, k))
                    n += k
                if k == batch.num_rows:
                    continue
                yield from resolve(once(held))
                held, n, batch = [], 0, batch.slice(k)
            held.append(batch)
            n += batch.num_rows
        if held:
            yield from resolve(once(held))

    sorted_rows = fetched.repartition("key").sortWithinPartitions("key", "doc_id", "start", "h")
    return sorted_rows.mapInArrow(run, "doc_id long, h int, start int, n int")


def spans_of(docs: DataFrame, plan: Plan, piece, resolve) -> DataFrame:
    """``doc_id``, ``h`` and ``spans``: all runs of repeated windows of each text that has any."""
    found = stored(gathered(stored(cut(docs, plan)), plan))
    need = found.where(F.col("kind").bitwiseAND(F.lit(NEED)) > 0)
    looked = by_key(fetch(docs, need, piece), resolve)
    hot = found.where(F.col("kind").bitwiseAND(F.lit(HOT)) > 0)
    if not hot.isEmpty():
        looked = looked.unionByName(hot_windows(fetch(docs, hot, piece), plan))
    done = found.where(F.col("kind").bitwiseAND(F.lit(DONE)) > 0).select("doc_id", "h", "start", "n")
    return done.unionByName(looked).groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def covered(spans: list, width: int, size: int) -> np.ndarray:
    """Which of ``size`` symbols stand in a window of the spans."""
    edge = np.zeros(size + 1, np.int64)
    if spans:
        a = np.array([s["start"] for s in spans])
        b = a + np.array([s["n"] for s in spans]) + width - 1
        np.add.at(edge, a, 1)
        np.add.at(edge, b, -1)
    return np.cumsum(edge[:-1]) > 0
