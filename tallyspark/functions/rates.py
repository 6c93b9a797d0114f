"""Exact sums, exact rounding, rates and zero-safe division.

The ``*_sql`` helpers return SQL text, the others columns.  Rounded figures go through
DECIMAL so that a value ending in exactly half a unit rounds away from zero on every
run and at every partitioning.  Unrounded figures are one DOUBLE division of two exact
sums.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# 22 integer digits on top and 26 below: sums of money stay far from an overflow, and the
# quotient still has 14 fractional digits, so rounding to a few places does not round twice.
TOP = "decimal(30,8)"
BOTTOM = "decimal(28,2)"

# Columns with at most two decimals.
MONEY = {"amount", "refund_amount", "cashback_earned", "discount_applied", "total_savings",
         "net_amount", "savings_pct", "processing_time_sec"}


def money_sum_sql(value: str, where: str | None = None, zero=False) -> str:
    """Exact sum of a two-decimal value as DECIMAL(30,2).

    A DECIMAL sum allocates an object per row; two BIGINT sums (multiples of 2**20 cents
    and the rest) do not, and neither can overflow below 2**40 rows.
    """
    cents = f"cast(cast({value} AS decimal(16,2)) * 100 AS bigint)"

    def part(sql):
        if not where:
            return f"sum({sql})"
        return f"sum(CASE WHEN {where} THEN {sql}{' ELSE 0' if zero else ''} END)"

    high, low = part(f"shiftright({cents}, 20)"), part(f"{cents} & 1048575")
    return (f"cast((cast({high} AS decimal(20,0)) * 1048576 + cast({low} AS decimal(20,0)))"
            " * 0.01BD AS decimal(30,2))")


def rounded_ratio_sql(top: str, bottom: str, places: int, scale: int = 1) -> str:
    """``scale * top / bottom`` rounded half up; NULL when ``bottom`` is 0 or NULL.

    ``bottom`` may be a count or an amount with two decimals.
    """
    return (f"cast(round(try_divide(cast({top} * {scale} AS {TOP}), cast({bottom} AS {BOTTOM})),"
            f" {places}) AS double)")


def plain_ratio_sql(top: str, bottom: str, scale: int = 1) -> str:
    """``top / bottom * scale`` as DOUBLE; NULL when ``bottom`` is 0 or NULL."""
    out = f"try_divide(cast({top} AS double), cast({bottom} AS double))"
    return f"{out} * {float(scale)}D" if scale != 1 else out


def plain_ratio(top: Column, bottom: Column, scale: int = 1) -> Column:
    """:func:`plain_ratio_sql` over columns."""
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value * F.lit(float(scale)) if scale != 1 else value


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))
