"""Money arithmetic whose result does not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Six decimals hold every price exactly; twelve digits before the point bound a single amount.
MONEY = "decimal(18,6)"


def exact_sum(c: Column) -> Column:
    """Sum of a double column through decimals: the same on any partitioning and after any retry."""
    return F.sum(c.cast(MONEY)).cast("double")


def exact_mean(c: Column) -> Column:
    """Mean of a double column through an exact sum; null where there is no value."""
    return exact_sum(c) / F.nullif(F.count(c), F.lit(0))


def rate(amount: Column, parts: Column) -> Column:
    """``round(amount / parts, 2)``, null for zero parts.

    Amounts in whole cents are split in integer arithmetic, so a half cent always rounds away
    from zero; other amounts fall back to rounding the quotient.
    """
    count = F.abs(F.nullif(parts, F.lit(0))).cast("long")
    cents = F.rint(F.abs(amount) * 100).cast("long")
    whole = F.abs(F.abs(amount) * 100 - cents) < 1e-6
    halves = cents * 2 + count
    rounded = (halves - halves % (count * 2)) / (count * 2) / 100.0
    sign = F.signum(amount) * F.signum(parts)
    return F.when(whole, rounded * sign).otherwise(F.round(amount / F.nullif(parts, F.lit(0)), 2))
