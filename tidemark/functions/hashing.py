"""Seeded hashes that do not depend on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def seeded_hash(seed: int | str | Column, *parts: str | Column) -> Column:
    """Uniform integer in ``[0, 2**60)`` from the seed and the given columns."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("-", seed, *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def seeded_uniform(seed: int | str | Column, *parts: str | Column) -> Column:
    """Uniform double in ``[0, 1)``."""
    return F.shiftright(seeded_hash(seed, *parts), 8).cast("double") / F.lit(float(2 ** (HASH_BITS - 8)))


# The same hash as SQL text, for the checking queries.
def hash_sql(*parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('-', {', '.join(parts)})), 1, {HASH_BITS // 4}))::bigint)"
