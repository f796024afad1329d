"""Scalar column helpers used across operators.

Money is accumulated as exact fixed-point integers (``MONEY_SCALE`` units per
currency unit).  Integer sums are associative, so a total does not depend on
how rows are spread over partitions or in which order tasks finish: reruns on
a cluster give bit-identical scores, and stay in codegen'd long arithmetic.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import LEVEL_BOUNDS, LEVEL_RANGE

MONEY_SCALE = 10000

__all__ = [
    "MONEY_SCALE", "units", "from_units", "money_sum", "sdiv", "zero_if_null", "clamp", "clamp_replace",
    "level_of", "level_min", "level_max", "days_between", "col_or_lit",
]


def col_or_lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def units(c) -> Column:
    """Amount as exact integer units (null stays null)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * MONEY_SCALE).cast("long")


def from_units(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double") / MONEY_SCALE


def money_sum(c, cond: Column | None = None) -> Column:
    """Exact sum of an amount (optionally of the rows where ``cond`` holds), as integer units."""
    u = units(c)
    if cond is not None:
        u = F.when(cond, u)
    return F.sum(u)


def sdiv(a, b) -> Column:
    """Division that yields null for a zero or null divisor (ANSI-safe)."""
    return F.try_divide(col_or_lit(a).cast("double"), col_or_lit(b).cast("double"))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def clamp(c: Column, lo: float = 0, hi: float = 800) -> Column:
    """``< lo -> lo``, ``> hi -> hi``; null stays null."""
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def clamp_replace(c: Column, lo: float = 0, hi: float = 800, lo_to: float = 10, hi_to: float = 780) -> Column:
    """Clamp that replaces out-of-range values by fixed in-range ones."""
    return F.when(c < lo, F.lit(lo_to)).when(c > hi, F.lit(hi_to)).otherwise(c)


def level_of(score: Column) -> Column:
    """Risk level 1..3 of a 0..800 score (right-closed bins; outside -> null)."""
    expr = None
    for level, lo, hi in LEVEL_BOUNDS:
        cond = (score > lo) & (score <= hi)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.cast("int")


def _level_lookup(level: Column, idx: int) -> Column:
    expr = None
    for lv, rng in LEVEL_RANGE.items():
        expr = F.when(level == lv, F.lit(rng[idx])) if expr is None else expr.when(level == lv, F.lit(rng[idx]))
    return expr.cast("int")


def level_min(level: Column) -> Column:
    return _level_lookup(level, 0)


def level_max(level: Column) -> Column:
    return _level_lookup(level, 1)


def days_between(later, earlier) -> Column:
    """Whole days ``later - earlier`` (int)."""
    return F.datediff(col_or_lit(later), col_or_lit(earlier))
