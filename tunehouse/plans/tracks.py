"""Track analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunehouse.operators.ranking import stride_of_counts, top_k

TICK_STRIDE = 350  # fixed value: every how many tracks the duration axis is labelled


def sales_tiers(dim_track: DataFrame, fact_invoiceline: DataFrame) -> DataFrame:
    """Tracks per sales tier: 1 from ten sales up, 2 from five, 3 from one, 4 unsold."""
    sold = fact_invoiceline.groupBy(F.col("track_id").alias("trackid")).agg(F.count("track_id").alias("_sold"))
    tier = (
        F.when(F.col("_sold") >= 10, 1).when(F.col("_sold") >= 5, 2).when(F.col("_sold") >= 1, 3).otherwise(4)
    )
    return (
        dim_track.select("trackid")
        .join(sold, "trackid", "left")
        .groupBy(tier.alias("track_sales_quarter"))
        .agg(F.count("trackid").alias("total_tracks_per_quartr"))
        .orderBy("track_sales_quarter")
    )


def top_by_distinct(dim_track: DataFrame, group: str, counted: str, name: str, k: int = 5) -> DataFrame:
    """The ``k`` groups with the most distinct values of ``counted``; NULL groups do not count."""
    return top_k(
        dim_track.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(counted).alias(name)),
        k,
        F.desc(name),
        F.asc(group),
    )


def sales_by_track(dim_track: DataFrame, fact_invoiceline: DataFrame) -> DataFrame:
    """Sales per sold track, with the track's duration. Adds up before joining."""
    sales = fact_invoiceline.groupBy("track_id").agg(F.coalesce(F.sum("unitprice"), F.lit(0)).alias("total_sales"))
    durations = dim_track.select(F.col("trackid").alias("track_id"), "track_duration")
    return sales.join(durations, "track_id").filter(F.col("track_duration").isNotNull()).select(
        "track_id", "track_duration", F.col("total_sales").cast("decimal(20,2)").alias("total_sales")
    )


def duration_sales(dim_track: DataFrame, fact_invoiceline: DataFrame) -> DataFrame:
    """Sales per track, sorted by duration."""
    return sales_by_track(dim_track, fact_invoiceline).orderBy("track_duration", "track_id")


def duration_line(dim_track: DataFrame, fact_invoiceline: DataFrame) -> DataFrame:
    """Mean sales per duration: the points of the line chart."""
    return (
        sales_by_track(dim_track, fact_invoiceline)
        .groupBy("track_duration")
        .agg(F.avg("total_sales").alias("avg_total_sales"), F.count(F.lit(1)).alias("n"))
    )


def duration_ticks(dim_track: DataFrame, fact_invoiceline: DataFrame, stride: int = TICK_STRIDE) -> DataFrame:
    """Duration of every ``stride``-th sold track in duration order.

    A duration is five characters of digits, so there are some ten thousand at
    most however many tracks there are; only their counts are put in order.
    """
    sold = fact_invoiceline.select(F.col("track_id").alias("trackid")).distinct()
    counts = (
        dim_track.filter(F.col("track_duration").isNotNull())
        .join(sold, "trackid")
        .groupBy("track_duration")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return stride_of_counts(counts, "track_duration", "_n", stride).select("track_duration")
