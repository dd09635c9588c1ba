"""Customer analyses."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunehouse.functions.text import full_name
from tunehouse.operators.ranking import top_k
from tunehouse.plans.currencies import convert


def millionths(price: Column) -> Column:
    """A price in whole millionths, so that sums are exact and do not depend on row order."""
    return F.rint(price * 1e6).cast("bigint").cast("decimal(18,0)")


def customer_totals(fact_invoice: DataFrame, dim_currencies: DataFrame) -> DataFrame:
    """USD and ILS per customer by joining invoices to currencies on the day.

    ``dim_currencies`` has a row per invoice, so k invoices of one day meet all
    k currency rows of it and the totals are inflated; that is the meaning of
    this report (``customer_totals_per_invoice`` is the corrected one). The k * k
    pairs are not formed: the currency rows are added up per day first. That is
    at most one row per calendar day, which is broadcast.
    """
    midnight = F.col("purchase_date").cast("date")
    per_day = (
        dim_currencies.filter(F.col("purchase_date") == midnight.cast("timestamp_ntz"))
        .groupBy(midnight.alias("invoicedate"))
        .agg(F.sum(millionths(F.col("usd_price"))).alias("_usd"), F.sum(millionths(F.col("ils_price"))).alias("_ils"))
    )
    return (
        fact_invoice.filter(F.col("customerid").isNotNull())
        .join(F.broadcast(per_day), "invoicedate")
        .groupBy("customerid")
        .agg(*_sums(F.col("_usd"), F.col("_ils")))
    )


def customer_totals_per_invoice(fact_invoice: DataFrame, rates: DataFrame) -> DataFrame:
    """USD and ILS per customer, each invoice counted once at its own day's rate."""
    return (
        convert(fact_invoice, rates)
        .filter(F.col("customerid").isNotNull())
        .groupBy("customerid")
        .agg(*_sums(millionths(F.col("usd_price")), millionths(F.col("ils_price"))))
    )


def _sums(usd: Column, ils: Column) -> list[Column]:
    unit = F.lit(Decimal("0.000001"))
    return [
        (F.coalesce(F.sum(value), F.lit(0)).cast("decimal(38,0)") * unit).cast("decimal(38,6)").alias(name)
        for name, value in (("usd_price", usd), ("ils_price", ils))
    ]


def ranked_customers(totals: DataFrame) -> DataFrame:
    """All customers, the highest USD total first."""
    return totals.orderBy(F.desc("usd_price"), F.asc("customerid"))


def top_customers(totals: DataFrame, dim_customer: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` customers with the highest USD total among those with a name."""
    named = totals.join(dim_customer.select("customerid", "firstname", "lastname"), "customerid")
    return top_k(named, k, F.desc("usd_price"), F.asc("customerid")).select(
        full_name(F.col("firstname"), F.col("lastname")).alias("customer_name"),
        F.col("usd_price").alias("usd_total"),
        F.col("ils_price").alias("ils_total"),
    )


def monthly_sales(fact_invoice: DataFrame) -> DataFrame:
    """Sales per year and month."""
    return (
        fact_invoice.filter(F.col("invoicedate").isNotNull())
        .groupBy(F.year("invoicedate").alias("year"), F.month("invoicedate").alias("month"))
        .agg(F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(20,2)").alias("total"))
        .orderBy("year", "month")
    )


def months_of_best_years(invoices: DataFrame, n: int = 1) -> DataFrame:
    """Monthly sales of the ``n`` years with the highest sales, of invoices in folders by ``year``.

    The best years are found from the year column and the totals; the months then read only the folders of those
    years, which Spark learns while the job runs.
    """
    yearly = invoices.where("year is not null").groupBy("year").agg(F.sum("total").alias("_sales"))
    # a row per year
    ranked = yearly.withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("_sales"), F.asc("year"))))
    best = ranked.where(F.col("_rank") <= n).select("year")
    return monthly_sales(invoices.join(F.broadcast(best), "year").select("invoicedate", "total"))
