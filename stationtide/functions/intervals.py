"""Range predicates. Ranges are half open: ``start <= x < end``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Northern and eastern ends of the coordinate axes.
LATITUDE_LIMIT = 90.0
LONGITUDE_LIMIT = 180.0


def within(x: Column, start, end) -> Column:
    return (x >= start) & (x < end)


def overlaps(a: Column, b: Column, c, d) -> Column:
    """``[a, b)`` and ``[c, d)`` share a point; an empty range shares none."""
    c = c if isinstance(c, Column) else F.lit(c)
    d = d if isinstance(d, Column) else F.lit(d)
    return (a < d) & (c < b) & (a < b) & (c < d)


def holds_point(start: Column, end: Column, value) -> Column:
    """Closed containment, used for single-value catalogue filters."""
    return (start <= value) & (end >= value)


def coordinate_within(x: Column, start: float, end: float, limit: float) -> Column:
    """Row filter on one axis. A request ending on the axis limit includes the limit."""
    return (x >= start) if end >= limit else within(x, start, end)


def tile_may_hold(tile_start: Column, tile_end: Column, start: float, end: float, limit: float) -> Column:
    """Tile filter matching :func:`coordinate_within`.

    It never loses a row: the zero-width edge tile at the axis limit is kept for
    a request that ends there, and the row filter decides exactly.
    """
    upper = F.lit(True) if end >= limit else tile_start < end
    return upper & (tile_end >= start)
