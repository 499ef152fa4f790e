"""Rounding, ratios and money sums shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round to `digits` places, ties to even, in double arithmetic."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator; null, never zero or an error, without a denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole rounded; null when there is no whole."""
    return half_even(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def money_sum(value: Column) -> Column:
    """Sum of amounts kept to four places, the same in whatever order rows arrive.

    Adding doubles is order-dependent, and ranks and segments are decided on
    these sums, so ten-thousandths are added as whole numbers, in decimals that
    no total overflows.
    """
    return in_units(F.sum(ten_thousandths(value)))


def ten_thousandths(value: Column) -> Column:
    return F.rint(value * F.lit(1e4)).cast("decimal(20,0)")


def in_units(amount: Column) -> Column:
    return amount.cast("double") / F.lit(1e4)


def exact_price(value: Column) -> Column:
    """A unit price as a decimal, so that a mean does not depend on row order."""
    return value.cast("decimal(18,6)")
