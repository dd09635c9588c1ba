"""Currency expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_USD_ILS = 3.56  # fixed value: the rate used where a day has none


def usd_to_ils(usd: Column, usd_pln: Column, ils_pln: Column) -> Column:
    """Cross rate over PLN; NULL where a rate is missing or zero."""
    usable = (usd_pln != 0) & (ils_pln != 0)
    return F.when(usable, usd.cast("double") * usd_pln * F.try_divide(F.lit(1.0), ils_pln))


def usd_to_ils_or_default(usd: Column, usd_pln: Column, ils_pln: Column, default: float = DEFAULT_USD_ILS) -> Column:
    return F.coalesce(usd_to_ils(usd, usd_pln, ils_pln), usd.cast("double") * F.lit(default))
