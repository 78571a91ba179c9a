"""Exact money arithmetic.

Quotients are done on whole cents: numerator and denominator as BIGINT, rounded
half away from zero, then turned back into a DECIMAL with two places. This avoids
engine-specific decimal division scales, and the reference's ``DECIMAL(10,10)``
variables (which overflow for any real salary).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """DECIMAL(p,2) -> BIGINT cents (exact)."""
    return (amount * 100).cast("bigint")


def hundredths(pct: Column) -> Column:
    """DECIMAL(4,2) percentage -> BIGINT hundredths of a percent (exact)."""
    return (pct * 100).cast("bigint")


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative BIGINTs: the remainder is removed
    first, so the decimal quotient is a whole number."""
    whole = (a - F.pmod(a, b)).cast("decimal(38,0)")
    return (whole / b.cast("decimal(38,0)")).cast("bigint")


def rounded_quotient(n: Column, d: int) -> Column:
    """``n / d`` rounded half away from zero, for BIGINT n and int d > 0."""
    mag = F.abs(n) * 2 + F.lit(d).cast("bigint")
    q = int_div(mag, F.lit(2 * d).cast("bigint"))
    return F.when(n < 0, -q).otherwise(q)


def from_cents(c: Column, precision: int = 10) -> Column:
    """BIGINT cents -> DECIMAL(precision, 2) (exact)."""
    return (c.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(
        f"decimal({precision},2)")
