"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null, not an error or infinity, on a zero divisor."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def cents(value: str | Column) -> Column:
    """Two-decimal money as whole cents, so that sums do not depend on their order."""
    return F.round(col(value) * 100).cast("bigint")


def total(columns: Sequence[str], scale: float = 1.0) -> Column:
    """Row sum of columns divided by a unit."""
    first, *rest = [F.col(c) for c in columns]
    for c in rest:
        first = first + c
    return first / F.lit(scale)


def age_from_year(year: str | Column, reference_year: int) -> Column:
    return F.lit(reference_year) - col(year)


def euclidean(left: Sequence[str | Column], right: Sequence[str | Column]) -> Column:
    squares = [(col(a) - col(b)) * (col(a) - col(b)) for a, b in zip(left, right, strict=True)]
    result = squares[0]
    for s in squares[1:]:
        result = result + s
    return F.sqrt(result)


def jaccard(a: str | Column, b: str | Column) -> Column:
    """Jaccard similarity of two token arrays; null when both are empty."""
    return ratio(F.size(F.array_intersect(col(a), col(b))), F.size(F.array_union(col(a), col(b))))


def equal_bin(value: str | Column, lo: Column, hi: Column, bins: int) -> Column:
    """One-based number of the equal-width bin between lo and hi; the last bin is closed.

    All values equal gives bin 1.
    """
    width = (hi - lo) / F.lit(bins)
    inside = F.floor((col(value) - lo) / F.nullif(width, F.lit(0.0))).cast("int") + 1
    # least() would skip a null, so missing values and a width of zero are told apart first
    return F.when(col(value).isNull(), F.lit(None)).when(width > 0, F.least(F.lit(bins), inside)).otherwise(F.lit(1))
