"""Song recommendations for all customers at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunehouse.operators.ranking import group_top_n, position_in_group
from tunehouse.sinks.tables import save_bucketed


def order_lines(dim_customer: DataFrame, fact_invoice: DataFrame, fact_invoiceline: DataFrame) -> DataFrame:
    """``customerid, track_id`` of every line whose invoice and customer are known."""
    invoices = fact_invoice.select(F.col("invoiceid").alias("invoice_id"), "customerid").join(
        dim_customer.select("customerid"), "customerid", "left_semi"
    )
    return (
        fact_invoiceline.select("invoice_id", "track_id").join(invoices, "invoice_id").select("customerid", "track_id")
    )


def track_popularity(
    dim_customer: DataFrame, fact_invoice: DataFrame, fact_invoiceline: DataFrame, dim_track: DataFrame
) -> DataFrame:
    """Order lines per track, over the lines whose invoice and customer are known."""
    invoices = fact_invoice.select(F.col("invoiceid").alias("invoice_id"), "customerid").join(
        dim_customer.select("customerid"), "customerid", "left_semi"
    )
    counts = (
        fact_invoiceline.select("invoice_id", "track_id")
        .join(invoices, "invoice_id", "left_semi")
        .groupBy("track_id")
        .agg(F.count(F.lit(1)).alias("total_track_orders"))
    )
    tracks = dim_track.select(F.col("trackid").alias("track_id"), "genre_name", "track_name")
    return counts.join(tracks, "track_id")


def recommend(
    dim_customer: DataFrame,
    fact_invoice: DataFrame,
    fact_invoiceline: DataFrame,
    dim_track: DataFrame,
    customer_id: int | None = None,
    n_genres: int = 2,
    per_genre: int = 3,
    order: str = "track_id",
    fill_single_genre: bool = False,
) -> DataFrame:
    """Tracks each customer has not ordered yet, from the genres they order most.

    Candidates are tracks that somebody ordered, in ``track_id`` order, or by
    ``order="popularity"``; ``per_genre`` of them for each of ``n_genres``
    genres. With ``fill_single_genre`` a customer of a single genre gets the
    other genres' share from it too.

    No customer is paired with all tracks of a genre. The candidates of a genre
    are numbered 1, 2, 3, …; of the first ``k + w`` numbers a customer who has
    ``k`` of the genre's tracks lacks at least ``w``. So that many numbers are
    listed per customer and genre, those that they have are taken off, and the
    lowest ``w`` are kept. All customers go this way, and it lists
    no more than a row per track a customer has, and a few.
    """
    if order not in ("track_id", "popularity"):
        raise ValueError(f"unknown order {order!r}")
    ordered = order_lines(dim_customer, fact_invoice, fact_invoiceline)
    mine = ordered
    if customer_id is not None:  # reaches the scans of customers and invoices
        one = F.col("customerid") == customer_id
        mine = order_lines(dim_customer.filter(one), fact_invoice.filter(one), fact_invoiceline)
    tracks = dim_track.filter(F.col("genre_name").isNotNull()).select(
        F.col("trackid").alias("track_id"), "genre_name", "track_name"
    )
    popularity = ordered.groupBy("track_id").agg(F.count(F.lit(1)).alias("_orders")).join(tracks, "track_id")
    numbered = position_in_group(
        popularity, ["genre_name"], "track_id", "_number", lead="_orders" if order == "popularity" else None
    ).drop("_orders")

    genre = ["customerid", "genre_name"]
    owned = (
        mine.join(numbered.select("track_id", "genre_name", "_number"), "track_id")
        .groupBy(*genre, "_number")
        .agg(F.count(F.lit(1)).alias("_orders"))
    )
    tastes = owned.groupBy(*genre).agg(F.sum("_orders").alias("_orders"), F.count(F.lit(1)).alias("_has"))
    preferred = group_top_n(tastes, n_genres, ["customerid"], F.desc("_orders"), F.asc("genre_name"))
    wanted, most = F.lit(per_genre), per_genre
    if fill_single_genre:
        alone = F.count(F.lit(1)).over(Window.partitionBy("customerid")) == 1
        wanted, most = F.when(alone, n_genres * per_genre).otherwise(per_genre), n_genres * per_genre
    preferred = preferred.withColumn("_wanted", wanted)
    numbers = F.sequence(F.lit(1).cast("bigint"), F.col("_has") + F.col("_wanted"))
    lacked = preferred.select(*genre, "_wanted", F.explode(numbers).alias("_number")).join(
        owned.select(*genre, "_number"), [*genre, "_number"], "left_anti"
    )
    # each task keeps only its own lowest numbers of a customer and genre before the shuffle
    ranked = lacked.withColumn("_rank", F.row_number().over(Window.partitionBy(*genre).orderBy("_number")))
    picks = ranked.filter(F.col("_rank") <= most).filter(F.col("_rank") <= F.col("_wanted"))
    return picks.join(numbered, ["genre_name", "_number"]).select("customerid", "track_id", "track_name", "genre_name")


def store_recommendations(recommended: DataFrame, table: str, location: str, buckets: int) -> DataFrame:
    """All customers' recommendations as a table in buckets by customer: ``recommendations_of`` then reads one bucket.

    A customer has at most a few rows, so buckets are even.
    """
    return save_bucketed(recommended, table, "customerid", buckets, location)


def recommendations_of(spark: SparkSession, table: str, customer_id: int) -> DataFrame:
    """One customer's stored recommendations, in track order: one bucket is read, and in it the row groups of the customer."""
    return spark.table(table).where(F.col("customerid") == customer_id).orderBy("track_id")
