"""Invoice totals in USD and ILS."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunehouse.functions.dates import day_key
from tunehouse.functions.money import DEFAULT_USD_ILS, usd_to_ils, usd_to_ils_or_default
from tunehouse.schemas import CURRENCIES, conform


def convert(invoices: DataFrame, rates: DataFrame, default_rate: float = DEFAULT_USD_ILS) -> DataFrame:
    """Every column of ``invoices`` plus ``usd_price``, ``ils_price`` and ``rate_is_default``.

    ``rates`` has at most one row per calendar day, so it can be broadcast:
    even ten thousand years of days are under four million short rows.
    """
    by_day = rates.groupBy(F.col("rate_date").alias("_day")).agg(
        F.max("usd_pln").alias("_usd_pln"), F.max("ils_pln").alias("_ils_pln")
    )
    rate = (F.col("total"), F.col("_usd_pln"), F.col("_ils_pln"))
    return (
        invoices.withColumn("_day", day_key(F.col("invoicedate")))
        .join(F.broadcast(by_day), "_day", "left")
        .withColumns(
            {
                "usd_price": F.col("total").cast("double"),
                "ils_price": usd_to_ils_or_default(*rate, default_rate),
                "rate_is_default": usd_to_ils(*rate).isNull() & F.col("total").isNotNull(),
            }
        )
        .drop("_day", "_usd_pln", "_ils_pln")
    )


def convert_at_default(invoices: DataFrame, default_rate: float = DEFAULT_USD_ILS) -> DataFrame:
    """The same columns without looking up any rate."""
    usd = F.col("total").cast("double")
    return invoices.withColumns(
        {"usd_price": usd, "ils_price": usd * F.lit(default_rate), "rate_is_default": F.col("total").isNotNull()}
    )


def currencies(invoices: DataFrame, rates: DataFrame, default_rate: float = DEFAULT_USD_ILS) -> DataFrame:
    """One row per invoice: ``purchase_date, usd_price, ils_price``."""
    priced = convert(invoices, rates, default_rate).withColumnRenamed("invoicedate", "purchase_date")
    return conform(priced, CURRENCIES)


dim_currencies = currencies
