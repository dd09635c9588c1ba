"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunehouse.functions.numbers import int_div


def email_domain(email: Column) -> Column:
    """The part from ``@`` on, ``@`` included; the whole text if it has none."""
    return F.substring(email, F.greatest(F.locate("@", email), F.lit(1)), F.length(email))


def capitalize_first(name: Column) -> Column:
    """Upper-case the first letter only and lower-case all the others."""
    return F.concat(F.upper(F.left(name, F.lit(1))), F.lower(F.substring(name, F.lit(2), F.length(name))))


def concat_skip_nulls(*parts: Column) -> Column:
    """Concatenation that leaves NULL parts out instead of becoming NULL."""
    return F.concat_ws("", *parts)


def two_digits(number: Column) -> Column:
    """Pad to two characters and keep the last two: 7 is ``07``, 100 is ``00``."""
    return F.right(F.concat(F.lit("0"), number.cast("string")), F.lit(2))


def seconds_of(milliseconds: Column) -> Column:
    return int_div(milliseconds, 1000).cast("int")


def minutes_seconds(milliseconds: Column) -> Column:
    """``MM:SS``; a NULL duration gives ``:``."""
    seconds = int_div(milliseconds, 1000)
    return concat_skip_nulls(two_digits(int_div(seconds, 60)), F.lit(":"), two_digits(seconds % 60))


def full_name(first: Column, last: Column) -> Column:
    """First and last name with a blank between; NULL if either is NULL."""
    return F.concat(first, F.lit(" "), last)
