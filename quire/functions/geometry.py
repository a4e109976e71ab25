"""Axis-aligned boxes [x0, y0, x1, y1] as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _side(b: Column, axis: int) -> Column:
    return b[axis + 2] - b[axis]


def area(b: Column) -> Column:
    """0 for a null box."""
    return F.coalesce(_side(b, 0) * _side(b, 1), F.lit(0.0))


def _inter(a: Column, b: Column) -> Column:
    w, h = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 for null boxes, touching ones and empty unions."""
    i = _inter(a, b)
    u = area(a) + area(b) - i
    return F.coalesce(F.when((i > 0) & (u != 0), i / u), F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Intersection over the smaller area."""
    i, s = _inter(a, b), F.least(area(a), area(b))
    return F.coalesce(F.when((i > 0) & (s != 0), i / s), F.lit(0.0))
