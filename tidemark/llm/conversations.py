"""Prefix trie of conversations that are rebuilt from another's head and their own rest.

The fingerprint of a turn sequence is an element of a monoid: its length and, in four prime fields, the polynomial
of its turns' hashes. Products of pieces follow from the pieces, so prefixes of hot conversations are scanned
in parts, and a rebuilt prefix is the product of a stored head and the quotient of two own prefixes. Rebuilt texts are
never written. Prefix groups are then verified against the stored turns they end in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import salted_join

from .batches import stored

#: The largest primes below 2**31, so that products stay within a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
#: Bases of the polynomials, one a prime and attempt.
BASE = 1_000_003
#: Digits of a position in powers of a base: three of them reach beyond eight thousand million turns.
RADIX_BITS, DIGITS = 11, 3
#: Turns that may be taken from another conversation's head.
LONGEST_HEAD = 8
#: Depths summed by one window, and ids joined to one text.
DEPTHS, IDS = 1 << 16, 1 << 12
LANES = range(len(PRIMES))
NODE = ["depth", "f1", "f2"]


def head_length() -> Column:
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_HEAD + 1)


def base_of() -> Column:
    return F.col("conv_id") - F.col("conv_id") % 5


class Fields:
    """Powers and products in the prime fields of one attempt."""

    def __init__(self, attempt: int):
        self.bases = [BASE + 2 * (attempt * len(PRIMES) + lane) for lane in LANES]
        self.attempt = attempt

    def power(self, lane: int, n: Column) -> Column:
        """base ** n, by table digits of n."""
        p, result = PRIMES[lane], None
        for digit in range(DIGITS):
            step = pow(self.bases[lane], 1 << (RADIX_BITS * digit), p)
            values = [1]
            for _ in range((1 << RADIX_BITS) - 1):
                values.append(values[-1] * step % p)
            table = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
            part = F.get(table, F.shiftright(n, RADIX_BITS * digit).bitwiseAND((1 << RADIX_BITS) - 1).cast("int"))
            result = part if result is None else result * part % p
        return result

    def inverse(self, lane: int, n: Column) -> Column:
        """base ** -n for n up to the longest head."""
        p = PRIMES[lane]
        back = pow(self.bases[lane], -1, p)
        return F.get(F.array(*[F.lit(pow(back, k, p)).cast("bigint") for k in range(LONGEST_HEAD + 1)]), n.cast("int"))


def _lanes(make: Callable[[int], Column], name: str) -> list[Column]:
    return [make(lane).alias(f"{name}{lane}") for lane in LANES]


def _packed(make: Callable[[int], Column], name: str) -> list[Column]:
    """Four residues as two numbers."""
    two = lambda a, b: F.shiftleft(make(a), 31).bitwiseOR(make(b))
    return [two(0, 1).alias(f"{name}1"), two(2, 3).alias(f"{name}2")]


# -- turns ------------------------------------------------------------------------------------


def contents(conversations: DataFrame, attempt: int) -> DataFrame:
    """Turns that belong to a conversation, with a 128-bit name ``c1, c2`` of their role and text."""
    plain = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return plain.withColumns({f"c{k}": F.xxhash64(F.lit(2 * attempt + k), "role", "text") for k in (1, 2)})


def names_are_exact(named: DataFrame) -> bool:
    """Whether no two different contents share a name, by their full role and text."""
    many = named.select("c1", "c2", "role", "text").distinct().groupBy("c1", "c2").agg(F.count("*").alias("n"))
    return many.where("n > 1").isEmpty()


def placed_turns(named: DataFrame, fields: Fields) -> DataFrame:
    """Turns with position and prefix fingerprints: ``r`` with the turn, ``s`` before it.

    Turns are dealt by ranges of (conversation, turn, tie), so a conversation of any size is cut. Each range takes
    the products of its own part; those of earlier parts are put before it, at most one row a range.
    """
    # equal turns in the order of a hash of their content; the last key only cuts runs of equal rows
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("tie"), F.col("u")]
    rows = named.select(
        "conv_id", "turn", "c1", "c2", F.xxhash64("role", "text").alias("tie"), F.octet_length("text").cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("u"),
    )
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "c1", "c2", "bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i")
    )
    within = Window.partitionBy("part", "conv_id").orderBy("i")
    local = stored(ranged).withColumn("at", F.row_number().over(within).cast("bigint"))
    symbol = lambda lane: F.pmod(F.xxhash64("c1", "c2", F.lit(lane)), F.lit(PRIMES[lane]))
    weighed = local.select("*", *_lanes(lambda k: symbol(k) * fields.power(k, F.col("at")) % PRIMES[k], "w"))
    running = Window.partitionBy("part", "conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    local = stored(weighed.select("*", *_lanes(lambda k: F.sum(f"w{k}").over(running) % PRIMES[k], "q")).drop("i"))

    parts = local.groupBy("conv_id", "part").agg(F.count("*").alias("n"), *[(F.sum(f"w{k}") % PRIMES[k]).alias(f"h{k}") for k in LANES])
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    counted = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    terms = counted.select("conv_id", "part", "before", *_lanes(lambda k: F.col(f"h{k}") * fields.power(k, F.col("before")) % PRIMES[k], "t"))
    summed = terms.select("conv_id", "part", "before", *_lanes(lambda k: F.coalesce(F.sum(f"t{k}").over(earlier), F.lit(0)) % PRIMES[k], "t"))
    cut = summed.where("before > 0")  # only a range's first conversation has earlier parts

    joined = local.join(F.broadcast(cut), ["conv_id", "part"], "left")
    before = F.coalesce("before", F.lit(0)).cast("bigint")
    moved = lambda k, value: (F.coalesce(f"t{k}", F.lit(0)) + value * fields.power(k, before)) % PRIMES[k]
    less = lambda k: (F.col(f"q{k}") + PRIMES[k] - F.col(f"w{k}")) % PRIMES[k]
    return stored(
        joined.select(
            "conv_id", (F.col("at") + before).alias("pos"), "c1", "c2", "bytes",
            *_lanes(lambda k: moved(k, F.col(f"q{k}")), "r"), *_lanes(lambda k: moved(k, less(k)), "s"),
        )
    )


# -- rebuilt prefixes -------------------------------------------------------------------------


def recipes(turns: DataFrame) -> DataFrame:
    """Per conversation: base, head length ``h`` asked and ``hb`` got, own length, rebuilt length ``size``, fingerprints
    ``g`` of the head and ``o`` of the own turns that it replaces."""
    early = turns.where(F.col("pos") <= LONGEST_HEAD)
    known = stored(turns.groupBy("conv_id").agg(F.count("*").alias("length")))
    asked = known.select("conv_id", "length", head_length().alias("h"), base_of().alias("base"))
    of_base = known.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    sized = asked.join(of_base, "base", "left").withColumn("hb", F.least("h", F.coalesce("base_length", F.lit(0))))
    head = early.select(F.col("conv_id").alias("base"), F.col("pos").alias("hb"), *[F.col(f"r{k}").alias(f"g{k}") for k in LANES])
    own = early.select("conv_id", F.col("pos").alias("h"), *[F.col(f"r{k}").alias(f"o{k}") for k in LANES])
    full = sized.join(head, ["base", "hb"], "left").join(own, ["conv_id", "h"], "left")
    return full.select(
        "conv_id", "base", "h", "hb", "length", (F.col("hb") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("size"),
        *[F.coalesce(f"{c}{k}", F.lit(0)).alias(f"{c}{k}") for c in "go" for k in LANES],
    )


def prefixes(turns: DataFrame, fields: Fields) -> DataFrame:
    """A row for every conversation and depth: fingerprint ``f``, its parent's ``p``, the last turn's name and bytes."""
    recipe = stored(recipes(turns))
    row = ["conv_id", "depth", "f1", "f2", "p1", "p2", "c1", "c2", "bytes", "ends"]
    zero = F.lit(0).cast("bigint")
    root = recipe.select(
        "conv_id", *[zero.alias(c) for c in row[1:9]], (F.col("size") == 0).alias("ends")
    )
    # a base has at most nine conversations and eight early turns
    head = recipe.select(F.col("conv_id").alias("member"), F.col("base").alias("conv_id"), "hb", "size").join(
        turns.where(F.col("pos") <= LONGEST_HEAD), "conv_id"
    ).where("pos <= hb")
    heads = head.select(
        F.col("member").alias("conv_id"), F.col("pos").alias("depth"), *_packed(lambda k: F.col(f"r{k}"), "f"),
        *_packed(lambda k: F.col(f"s{k}"), "p"), "c1", "c2", "bytes", (F.col("pos") == F.col("size")).alias("ends"),
    )
    rest = salted_join(turns, recipe, ["conv_id"], ["pos"]).where("pos > h")
    follow = lambda k, c: (F.col(f"g{k}") + fields.inverse(k, F.col("h") - F.col("hb")) * ((F.col(f"{c}{k}") + PRIMES[k] - F.col(f"o{k}")) % PRIMES[k])) % PRIMES[k]
    depth = F.col("pos") - F.col("h") + F.col("hb")
    owns = rest.select(
        "conv_id", depth.alias("depth"), *_packed(lambda k: follow(k, "r"), "f"), *_packed(lambda k: follow(k, "s"), "p"),
        "c1", "c2", "bytes", (depth == F.col("size")).alias("ends"),
    )
    return stored(root.unionByName(heads).unionByName(owns))


def nodes(rows: DataFrame) -> DataFrame:
    """Prefix groups with members, smallest member, parent and ends; ``agree`` is false where members differ.

    By induction from the root a group whose members have one parent fingerprint and one verified
    last turn holds one sequence.
    """
    checked = ["p1", "p2", "c1", "c2"]
    found = rows.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"), F.count_if("ends").alias("n_ends"),
        *[F.min(c).alias(c) for c in checked], *[F.max(c).alias(f"_{c}") for c in checked],
    )
    same = F.lit(True)
    for c in checked:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return stored(found.withColumn("agree", same).drop(*[f"_{c}" for c in checked]))


# -- ends -------------------------------------------------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted rows of one node as comma-joined ids, ``IDS`` at most."""
    names = [*NODE, "first", "ids"]
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        out, ids, now = [], [], None
        for key in zip(*columns):
            if key[:3] != now or len(ids) == IDS:
                if ids:
                    out.append((*now, ids[0], ",".join(map(str, ids))))
                now, ids = key[:3], []
            ids.append(key[3])
        if ids:
            out.append((*now, ids[0], ",".join(map(str, ids))))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string() if n == "ids" else pa.int64()) for c, n in zip(zip(*out) if out else [[]] * 5, names)], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the sorted texts of each node; only the running digest is held."""
    names = [*NODE, "ends_sha256"]
    table = lambda rows: pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.string() if i == 3 else pa.int64()) for i in range(4)], names
    )
    now, digest, done = None, None, []
    for batch in batches:
        for *key, _, text in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if key == now:
                digest.update(b"," + text.encode())
                continue
            if now:
                done.append((*now, digest.hexdigest()))
            now, digest = key, hashlib.sha256(text.encode())
        if len(done) > IDS:
            yield table(done)
            done = []
    if now:
        done.append((*now, digest.hexdigest()))
    if done:
        yield table(done)


def end_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each node's ending conversations, smallest id first.

    A digest must read its ids in order, so a node with very many meets in one task, but as
    texts of ``IDS`` ids that the ranges before it have joined, one after the other.
    """
    ends = rows.where("ends").select(*NODE, "conv_id")
    ranged = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    kind = "depth bigint, f1 bigint, f2 bigint"
    texts = ranged.mapInArrow(_texts, f"{kind}, first bigint, ids string")
    met = texts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return met.mapInArrow(_digests, f"{kind}, ends_sha256 string")


# -- trie -------------------------------------------------------------------------------------


def trie(conversations: DataFrame, attempts: int = 8) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. A null role or text is empty; rows without ``conv_id`` belong to no conversation
    and are left out; a null turn comes first; equal turns stand in the order of a hash of role and text, and
    repeated rows are turns of their own. Without conversations there are no nodes. Other columns are not read.

    Of each conversation the nodes that it is the smallest member of form a chain down to its end, so what lies below
    a node is the rest of its own chain and the whole chains of its other members: one sum over prefix
    rows, and no walk over depths.
    """
    for attempt in range(attempts):
        named = contents(conversations, attempt)
        if not names_are_exact(named):
            continue
        fields = Fields(attempt)
        rows = prefixes(placed_turns(named, fields), fields)
        groups = nodes(rows)
        if groups.where("not agree").isEmpty():
            return _measured(rows, groups)
    raise RuntimeError("fingerprints of different prefixes met in every attempt")


def _measured(rows: DataFrame, groups: DataFrame) -> DataFrame:
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("bigint")
    chains = stored(
        groups.groupBy("conv_id").agg(
            F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum(saved).alias("chain_saved"), F.sum(leaf).alias("chain_leaves")
        )
    )
    # what a chain saves above a node, by blocks of depths
    block = F.floor(F.col("depth") / DEPTHS)
    above = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    weighed = groups.select(*NODE, "conv_id", block.alias("block"), saved.alias("saved"))
    blocks = weighed.groupBy("conv_id", "block").agg(F.sum("saved").alias("t"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("conv_id", "block", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t"))
    passed = weighed.withColumn("in", F.coalesce(F.sum("saved").over(above), F.lit(0))).join(offsets, ["conv_id", "block"])
    passed = passed.select(*NODE, (F.col("t") + F.col("in")).alias("saved_above"))

    # whole chains that hang below a node
    member = salted_join(rows.select("conv_id", *NODE), chains, ["conv_id"], ["depth"]).where("depth < top")
    hanging = member.groupBy(*NODE).agg(F.sum("chain_saved").alias("hang_saved"), F.sum("chain_leaves").alias("hang_leaves"))

    own = salted_join(groups, chains, ["conv_id"], ["depth"])
    tops = stored(own.where("depth = top and depth > 0").select(
        *NODE, (F.col("depth") - 1).alias("up"), F.col("p1").alias("u1"), F.col("p2").alias("u2")
    ))
    kids = tops.groupBy(F.col("up").alias("depth"), F.col("u1").alias("f1"), F.col("u2").alias("f2")).agg(F.count("*").alias("branches"))
    above_tops = groups.select(F.col("depth").alias("up"), F.col("f1").alias("u1"), F.col("f2").alias("u2"), F.col("conv_id").alias("parent"))
    parents = salted_join(tops, above_tops, ["up", "u1", "u2"], NODE).select(*NODE, "parent")

    full = own
    for part in (passed, hanging, kids, parents, end_digests(rows)):
        full = full.join(part, NODE, "left")
    nothing = F.lit(0).cast("bigint")
    return full.select(
        "conv_id", "depth",
        F.when(F.col("depth") == 0, F.lit(None)).otherwise(F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("branches", nothing) + (F.col("depth") < F.col("bottom")).cast("bigint")).alias("n_children"),
        (F.col("chain_leaves") + F.coalesce("hang_leaves", nothing)).alias("n_leaves"),
        (F.col("chain_saved") - F.col("saved_above") + F.coalesce("hang_saved", nothing)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
