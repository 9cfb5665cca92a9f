"""Ranges of time as ``struct<lower, upper, lower_inc, upper_inc>``; a NULL bound is unbounded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_range(lower: Column, upper: Column, bounds: str = "[)") -> Column:
    """Build a range; ``bounds`` is one of ``[)``, ``[]``, ``(]``, ``()``."""
    if len(bounds) != 2 or bounds[0] not in "[(" or bounds[1] not in "])":
        raise ValueError(f"bad bounds {bounds!r}")
    return F.struct(
        lower.alias("lower"),
        upper.alias("upper"),
        F.lit(bounds[0] == "[").alias("lower_inc"),
        F.lit(bounds[1] == "]").alias("upper_inc"),
    )


def is_empty(r: Column) -> Column:
    """No point lies in the range."""
    lo, hi = r["lower"], r["upper"]
    point = (lo == hi) & ~(r["lower_inc"] & r["upper_inc"])
    return F.coalesce((lo > hi) | point, F.lit(False))


def _starts_by(a: Column, b: Column) -> Column:
    """Range ``a`` begins no later than range ``b`` ends."""
    lo, hi = a["lower"], b["upper"]
    touch = (lo == hi) & a["lower_inc"] & b["upper_inc"]
    return lo.isNull() | hi.isNull() | (lo < hi) | touch


def overlaps(a: Column, b: Column) -> Column:
    """``a && b``. NULL when either range is NULL, false when either is empty."""
    hit = _starts_by(a, b) & _starts_by(b, a) & ~is_empty(a) & ~is_empty(b)
    return F.when(a.isNotNull() & b.isNotNull(), hit)


def contains_point(r: Column, t: Column) -> Column:
    """``r @> t``."""
    lo, hi = r["lower"], r["upper"]
    above = lo.isNull() | (lo < t) | ((lo == t) & r["lower_inc"])
    below = hi.isNull() | (t < hi) | ((t == hi) & r["upper_inc"])
    return F.when(r.isNotNull() & t.isNotNull(), above & below)


def contains_range(outer: Column, inner: Column) -> Column:
    """``outer @> inner``; the empty range lies in every range."""
    olo, ilo, ohi, ihi = outer["lower"], inner["lower"], outer["upper"], inner["upper"]
    low_ok = olo.isNull() | (
        ilo.isNotNull() & ((olo < ilo) | ((olo == ilo) & (outer["lower_inc"] | ~inner["lower_inc"])))
    )
    high_ok = ohi.isNull() | (
        ihi.isNotNull() & ((ihi < ohi) | ((ihi == ohi) & (outer["upper_inc"] | ~inner["upper_inc"])))
    )
    return F.when(
        outer.isNotNull() & inner.isNotNull(),
        is_empty(inner) | (F.coalesce(low_ok & high_ok, F.lit(False)) & ~is_empty(outer)),
    )


def contained_by(inner: Column, outer: Column) -> Column:
    """``inner <@ outer``."""
    return contains_range(outer, inner)
