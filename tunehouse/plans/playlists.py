"""Playlist analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunehouse.functions.numbers import average_of, whole_percent_text
from tunehouse.operators.ranking import group_best, top_k
from tunehouse.operators.sets import union_all
from tunehouse.session import land


def load_counts(dim_playlist: DataFrame) -> DataFrame:
    """Tracks per playlist id, to check a load by eye."""
    return (
        dim_playlist.groupBy("playlist_id", "playlist_name")
        .agg(F.count("track_id").alias("count"))
        .orderBy(F.asc_nulls_last("playlist_id"), F.asc_nulls_last("playlist_name"))
    )


def track_counts(dim_playlist: DataFrame) -> DataFrame:
    """Tracks per playlist name."""
    return dim_playlist.groupBy("playlist_name").agg(F.count("track_id").alias("total_tracks"))


def count_stats(dim_playlist: DataFrame) -> DataFrame:
    """Largest, smallest and average playlist size."""
    return track_counts(dim_playlist).agg(
        F.max("total_tracks").alias("max_tracks_plalist"),
        F.min("total_tracks").alias("min_tracks_plalist"),
        F.avg("total_tracks").alias("avg_tracks_on_playlist"),
    )


def extremes(dim_playlist: DataFrame, smallest: int = 2, largest: int = 1) -> DataFrame:
    """The smallest and the largest playlists, each next to the average size."""
    counts = track_counts(dim_playlist)
    picked = union_all(
        top_k(counts, smallest, F.asc_nulls_last("total_tracks"), F.asc_nulls_last("playlist_name")),
        top_k(counts, largest, F.desc_nulls_first("total_tracks"), F.asc_nulls_last("playlist_name")),
    )
    size = average_of(F.sum("total_tracks").cast("decimal(20,0)"), F.count("total_tracks"))
    average = counts.agg(size.alias("avg")).scalar()
    return picked.withColumn("avg_tracks_on_playlist", average)


def breakdown(dim_playlist: DataFrame, dim_track: DataFrame, fact_invoiceline: DataFrame) -> DataFrame:
    """Sold percentage, leading genre and leading media type of each playlist.

    Ties for the lead all stay, and the two sets of ties multiply. The
    percentage is sale lines over rows of playlist-joined-to-sales, in whole
    percent: a track sold n times counts max(n, 1) rows. Those are weights here,
    so the sales never multiply the playlists' rows.
    """
    sold = fact_invoiceline.groupBy("track_id").agg(F.count("track_id").alias("_sold"))
    facts = (
        dim_track.select(F.col("trackid").alias("track_id"), "genre_name", "mediatype_name")
        .join(sold, "track_id", "full")
    )
    times_sold = F.coalesce("_sold", F.lit(0))
    # one row per playlist, genre and media type; landed because three results come from it
    parts = land(
        dim_playlist.select("playlist_name", "track_id")
        .join(facts, "track_id", "left")
        .groupBy("playlist_name", "genre_name", "mediatype_name")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum(times_sold).alias("_sold"),
            F.sum(F.when(F.col("track_id").isNotNull(), F.greatest(times_sold, F.lit(1)))).alias("_joined"),
        ),
        "playlist-parts",
    )

    def leading(column: str) -> DataFrame:
        named = F.when(F.col(column).isNotNull(), F.col("_rows")).otherwise(0)
        counts = parts.groupBy("playlist_name", column).agg(F.sum(named).alias("_n"))
        return group_best(counts, ["playlist_name"], F.desc("_n")).drop("_n")

    sales = parts.groupBy("playlist_name").agg(
        whole_percent_text(F.sum("_sold"), F.coalesce(F.sum("_joined"), F.lit(0))).alias("percentege_of_sold_tracks")
    )
    return (
        sales.join(leading("genre_name"), "playlist_name")
        .join(leading("mediatype_name"), "playlist_name")
        .select(
            "playlist_name",
            "percentege_of_sold_tracks",
            F.col("genre_name").alias("top_genre_on_playlist"),
            F.col("mediatype_name").alias("main_media_type_on_playlist"),
        )
    )
