"""Country analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunehouse.functions.numbers import average_of, int_div, percent_of, percent_text, round_half_even
from tunehouse.operators.joins import broadcast_within
from tunehouse.operators.ranking import top_k
from tunehouse.operators.sets import union_all


def revenue_by_country(fact_invoice: DataFrame) -> DataFrame:
    return fact_invoice.groupBy(F.col("billingcountry").alias("country")).agg(F.sum("total").alias("total_revenue"))


def _both_ends(by_country: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The ``k`` countries with the most and the ``k`` with the least revenue."""
    by_name = F.asc_nulls_last("country")
    return (
        top_k(by_country, k, F.desc_nulls_first("total_revenue"), by_name),
        top_k(by_country, k, F.asc_nulls_last("total_revenue"), by_name),
    )


def country_tiers(fact_invoice: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` countries with the most and the ``k`` with the least revenue."""
    top, bottom = _both_ends(revenue_by_country(fact_invoice), k)
    return union_all(
        top.select(F.lit("Top").alias("country_tier"), "*"), bottom.select(F.lit("Bottom").alias("country_tier"), "*")
    )


def genre_share(
    fact_invoice: DataFrame, fact_invoiceline: DataFrame, dim_track: DataFrame, k: int = 5
) -> DataFrame:
    """How the revenue of each tier country splits by genre, smallest share first.

    The share is the genre's unit prices over the country's invoice totals; where
    those are negative, the genre of the highest sum has the smallest share. A
    country in both tiers has its lines counted twice. Only the invoices of the
    ``2 * k`` tier countries meet the lines, and prices are added up per country
    and track before the genres are looked up.

    An invoice without lines counts as one line without genre and price. The one
    inner join also counts the invoices that have lines, for which a country has
    fewer than invoices if there is any without: an outer join could not split
    the lines of one huge invoice among tasks.
    """
    by_country = fact_invoice.groupBy(F.col("billingcountry").alias("country")).agg(
        F.sum("total").alias("total_revenue"), F.count(F.lit(1)).alias("_invoices")
    )
    tiers = (
        union_all(*_both_ends(by_country, k))
        .groupBy("country")
        .agg(
            F.max("total_revenue").alias("total_revenue"),
            F.max("_invoices").alias("_invoices"),
            F.count(F.lit(1)).alias("_tiers"),
        )
    )
    invoices = fact_invoice.select("invoiceid", F.col("billingcountry").alias("country")).join(
        broadcast_within(tiers.select("country"), 2 * k), "country", "left_semi"
    )
    lines = fact_invoiceline.select(F.col("invoice_id").alias("invoiceid"), "track_id", "unitprice")
    # a line counts for its track and for its invoice
    track = F.struct("track_id", F.lit(None).cast("bigint").alias("_invoice"), F.col("unitprice").alias("_price"))
    invoice = F.struct(
        F.lit(None).cast(fact_invoiceline.schema["track_id"].dataType).alias("track_id"),
        F.col("invoiceid").cast("bigint").alias("_invoice"),
        F.lit(None).cast(fact_invoiceline.schema["unitprice"].dataType).alias("_price"),
    )
    parts = (
        invoices.join(lines, "invoiceid")
        .select("country", F.inline(F.array(track, invoice)))
        .groupBy("country", "track_id", "_invoice")
        .agg(F.sum("_price").alias("_price"))
    )
    genres = dim_track.select(F.col("trackid").alias("track_id"), "genre_name")
    # the invoices are counted before the join, where they would all have the key NULL
    by_track = parts.groupBy("country", "track_id").agg(
        F.sum("_price").alias("_price"),
        F.count("_invoice").alias("_with_lines"),
        F.count_if(F.col("_invoice").isNull()).alias("_tracks"),
    )
    by_genre = (
        by_track.join(genres, "track_id", "left")
        .groupBy("country", "genre_name")
        .agg(*(F.sum(c).alias(c) for c in ("_price", "_with_lines", "_tracks")))
    )
    share = tiers.join(by_genre, "country", "left").filter(
        F.col("genre_name").isNotNull()
        | F.col("_tracks").isNull()
        | (F.col("_tracks") > 0)
        | (F.col("_with_lines") < F.col("_invoices"))
    )
    revenue = F.col("_price") * F.col("_tiers")
    whole = F.col("total_revenue")
    size = F.when(whole > 0, revenue).when(whole < 0, -revenue)
    rank = F.dense_rank().over(Window.partitionBy("country").orderBy(size.asc_nulls_last()))
    return share.select(
        "country",
        rank.cast("bigint").alias("rank_by_presentege"),
        "genre_name",
        percent_text(percent_of(revenue, whole)).alias("presentege_from_total_country_rev"),
    ).orderBy(F.asc_nulls_last("country"), "rank_by_presentege", F.asc_nulls_last("genre_name"))


def customer_summary(dim_customer: DataFrame, fact_invoice: DataFrame) -> DataFrame:
    """Customers, average orders and average revenue per country.

    Countries with a single customer are folded into one row ``Other``, which is
    there even if there is no such country. Invoices are added up per customer
    first, so neither a busy customer nor a large country is a hot join key.
    """
    orders = fact_invoice.groupBy("customerid").agg(
        F.count("invoiceid").alias("_orders"), F.sum("total").alias("_revenue")
    )
    countries = (
        dim_customer.select("customerid", "country")
        .join(orders, "customerid", "left")
        .groupBy("country", "customerid")
        .agg(F.sum(F.coalesce("_orders", F.lit(0))).alias("_orders"), F.sum("_revenue").alias("_revenue"))
        .groupBy("country")
        .agg(
            F.count("customerid").alias("total_customers"),
            F.sum("_orders").alias("_orders"),
            F.sum("_revenue").alias("_revenue"),
        )
    )
    single = (
        countries.filter(F.col("total_customers") == 1)
        .agg(*(F.sum(c).alias(c) for c in ("total_customers", "_orders", "_revenue")))
        .select(F.lit("Other").alias("country"), "*")
    )
    both = union_all(countries.filter(F.col("total_customers") > 1), single)
    return both.select(
        "country",
        "total_customers",
        int_div(F.col("_orders"), F.col("total_customers")).alias("avg_orders_per_customer"),
        average_of(F.col("_revenue"), F.col("total_customers")).alias("avg_revenue_per_customer"),
    )


def top_countries(fact_invoice: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` billing countries with the highest sales."""
    sales = (
        fact_invoice.filter(F.col("billingcountry").isNotNull())
        .groupBy(F.col("billingcountry").alias("country"))
        .agg(F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(20,2)").alias("total_sales"))
    )
    return top_k(sales, k, F.desc("total_sales"), F.asc("country"))


def manager_share(
    fact_invoice: DataFrame, dim_customer: DataFrame, dim_employee: DataFrame, k: int = 5
) -> DataFrame:
    """What part of the top countries' sales comes from customers whom a manager serves.

    The managers' part goes by the customer's country, the whole by the billing
    country. Only customers of the ``k`` countries meet the invoices, and
    sales are added up per employee before the managers are picked, so an
    employee with very many customers is no hot join key.
    """
    top = top_countries(fact_invoice, k)
    managers = dim_employee.filter(F.col("is_manager") == 1).select(F.col("employeeid").alias("supportrepid"))
    served = dim_customer.select("customerid", "country", "supportrepid").join(
        broadcast_within(top.select("country"), k), "country", "left_semi"
    )
    spent = fact_invoice.groupBy("customerid").agg(F.sum("total").alias("_spent"))
    by_country = (
        served.join(spent, "customerid", "left")
        .groupBy("supportrepid", "country")
        .agg(F.sum("_spent").alias("_spent"))
        .join(managers, "supportrepid")
        .groupBy("country")
        .agg(F.coalesce(F.sum("_spent"), F.lit(0)).cast("decimal(30,2)").alias("total_by_managers"))
    )
    share = F.col("total_by_managers").cast("double") * 100 / F.nullif(F.col("total_sales").cast("double"), F.lit(0.0))
    return (
        top.join(by_country, "country", "left")
        .select("country", "total_sales", "total_by_managers", round_half_even(share).alias("percentege_of_managers_sales"))
        .orderBy(F.desc("total_sales"), F.asc("country"))
    )
