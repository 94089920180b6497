"""Money and exact rounding. Money is decimal from end to end, never double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"
MONEY_SUM = "decimal(28,2)"


def money(amount: Column) -> Column:
    """Final form of an amount in a table or report; half-up at two places."""
    return F.round(amount, 2).cast(MONEY)


def half_up_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """numerator / denominator, half-up at `scale` places, in integer arithmetic.

    A plain division rounds once to its own scale and a second time here; this rounds once.
    NULL when either side is NULL or the denominator is zero.
    """
    parts = F.nullif(denominator, F.lit(0))
    doubled = F.abs(numerator) * F.lit(2 * 10**scale)
    units = F.call_function("div", doubled + parts, parts * 2)
    signed = F.when(numerator < 0, -units).otherwise(units)
    return (signed.cast("decimal(20,0)") * F.lit(10**-scale).cast(f"decimal({scale + 1},{scale})")).cast(
        f"decimal(20,{scale})"
    )


def mean_money(total: Column, count: Column) -> Column:
    """Mean of `count` amounts adding up to `total`, half-up at two places."""
    return half_up_ratio(total, count, 2)
