"""Exact means and percentages.

``avg`` over decimals is already rounded, so rounding it again can be off by one in the last
digit.  The helpers below divide integers and round half away from zero exactly once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"
WIDE = "decimal(28,0)"


def money(column: Column) -> Column:
    """Money sums in one width."""
    return column.cast(MONEY)


def cents(amount: Column) -> Column:
    """A two-digit amount as a whole number of hundredths."""
    return (amount * F.lit(100)).cast(WIDE)


def from_cents(total: Column) -> Column:
    """A whole number of hundredths as money."""
    return (total.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def half_up(numerator: Column, denominator: Column, digits: int = 2, width: str = WIDE) -> Column:
    """numerator / denominator of two whole numbers, rounded half away from zero.

    NULL when the denominator is zero or either side is NULL.  With ``width="bigint"`` the division
    stays in primitive arithmetic.  A result of more than 18 digits raises instead of wrapping.
    """
    top, bottom = numerator.cast(width), denominator.cast(width)
    size = F.nullif(F.abs(bottom), F.lit(0).cast(width))
    doubled = F.abs(top) * F.lit(2 * 10**digits).cast(_factor(width)) + size
    units = F.call_function("div", doubled, size * F.lit(2).cast(_factor(width)))
    signed = F.when((top < 0) != (bottom < 0), -units).otherwise(units)
    return (signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(
        f"decimal(20,{digits})"
    )


def _factor(width: str) -> str:
    return "bigint" if width == "bigint" else "int"


def mean_money(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean of a two-digit amount from its sum and its row count."""
    return half_up(cents(total), count * F.lit(100), digits)


def mean(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean of whole numbers from their sum and their row count."""
    return half_up(total, count, digits, "bigint")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole of two counts."""
    return half_up(part * F.lit(100), whole, digits, "bigint")


def percent_money(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole of two two-digit amounts."""
    return half_up(cents(part).cast("decimal(26,0)") * F.lit(100), cents(whole), digits)
