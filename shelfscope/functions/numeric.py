"""Numeric helpers shared by facts, marts and analytics.

Rounding rule: values are first fixed to 12 decimals, then rounded half-up to
``n`` places.  Plain ``round(double, n)`` rounds the binary value and differs
between engines at half-way points; the decimal makes the result independent
of summation noise and of the engine, and its 12 places lie far below any
digit that decides.  Values too large for it have no such digits and are
rounded as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(col: Column | str, n: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.round(c.try_cast("decimal(38,12)"), n).cast("double"), F.round(c.cast("double"), n))


def round_to_long(col: Column | str) -> Column:
    """Round to 0 decimals and return a long (``avg_*_count`` style)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.try_cast("decimal(38,12)"), 0).try_cast("long")


def guarded_pct(num: Column | str, den: Column | str, n: int = 2) -> Column:
    """``round(num / den * 100, n)`` when ``den > 0``, else null."""
    nc = F.col(num) if isinstance(num, str) else num
    dc = F.col(den) if isinstance(den, str) else den
    return F.when(dc > 0, round_to(nc / dc * 100, n)).otherwise(F.lit(None).cast("double"))


def flag_count(col: Column | str) -> Column:
    """Count of true flags; null flags are skipped, an all-null group gives null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("int"))


def flag_rate(col: Column | str, n: int = 2) -> Column:
    """Share of true flags among non-null flags, in percent."""
    c = F.col(col) if isinstance(col, str) else col
    return round_to(F.avg(c.cast("int")) * 100, n)


def trunc_long(col: Column) -> Column:
    """Double -> long by truncation toward zero, null when out of range."""
    return col.try_cast("long")
