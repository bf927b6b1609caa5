"""Axis-aligned boxes given as corner, width and height."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ratio


def box_iou(pred: str = "p_", true: str = "t_") -> Column:
    """Overlap area over joint area of two boxes stored as ``<prefix>x, y, w, h`` columns."""

    def overlap(start: str, length: str) -> Column:
        a, b = F.col(pred + start), F.col(true + start)
        end = F.least(a + F.col(pred + length), b + F.col(true + length))
        return F.greatest(end - F.greatest(a, b), F.lit(0.0))

    shared = overlap("x", "w") * overlap("y", "h")
    joint = F.col(pred + "w") * F.col(pred + "h") + F.col(true + "w") * F.col(true + "h") - shared
    return ratio(shared, joint)
