"""Integer division, rounding and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division that truncates towards zero."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round a decimal half away from zero."""
    return F.round(value, digits)


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round a double the way numpy does: scale, half to even, scale back."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale


def round_to_int(value: Column) -> Column:
    """Numeric to INT as a database assignment does it: rounds, never truncates."""
    return round_half_up(value, 0).cast("int")


def hundredths(amount: Column) -> Column:
    """An amount of two decimals as a whole number."""
    return (amount * 100).cast("decimal(38,0)")


def round_div(a: Column, b: Column) -> Column:
    """``a / b`` of whole numbers, rounded half away from zero; NULL where ``b`` is zero.

    Whole-number arithmetic throughout: a decimal quotient is cut at six
    decimals, so that rounding it again can go the wrong way.
    """
    double = F.nullif(F.abs(b), F.lit(0).cast("decimal(1,0)")) * 2
    rounded_up = F.abs(a) * 2 + F.abs(b)
    # divisible, so exact; div would give a BIGINT and wrap around
    quotient = ((rounded_up - rounded_up % double) / double).cast("decimal(32,0)")
    return F.when((a < 0) != (b < 0), -quotient).otherwise(quotient)


def average_of(amount: Column, count: Column) -> Column:
    """Exact mean of an amount of two decimals, rounded half away from zero to two decimals."""
    return (round_div(hundredths(amount), count.cast("decimal(38,0)")) / 100).cast("decimal(20,2)")


def percent_of(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` of two amounts of two decimals, exactly rounded to two decimals; NULL where ``whole`` is zero."""
    share = round_div(hundredths(part) * 10_000, hundredths(whole))
    return (share / 100).cast("decimal(32,2)")


def percent_text(percentage: Column) -> Column:
    """Percentage of two decimals as text: ``12.50%``."""
    return F.concat(percentage.cast("decimal(38,2)").cast("string"), F.lit("%"))


def whole_percent_text(part: Column, whole: Column) -> Column:
    """Percentage of two counts with integer division: ``12%``."""
    return F.concat(int_div(part * 100, F.nullif(whole, F.lit(0))).cast("string"), F.lit("%"))
