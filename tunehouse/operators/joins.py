"""Membership joins and update-from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BROADCAST_ROWS = 100_000


def broadcast_within(df: DataFrame, bound: int, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df``, known to have at most ``bound`` rows, for broadcast if that is few enough."""
    return F.broadcast(df) if bound <= rows else df


def _keys(other: DataFrame, on: dict[str, str]) -> DataFrame:
    # distinct is combined before its shuffle, so a hot key arrives as one row per task
    return other.select(*(F.col(theirs).alias(ours) for ours, theirs in on.items())).distinct()


def semi_join(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``; ``on`` maps our column to theirs."""
    return df.join(_keys(other, on), list(on), "left_semi").select(*df.columns)


def anti_join(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; a NULL key is kept."""
    return df.join(_keys(other, on), list(on), "left_anti").select(*df.columns)


def flag_member(df: DataFrame, other: DataFrame, on: dict[str, str], name: str) -> DataFrame:
    """Add a 0/1 column telling whether the key occurs in ``other``."""
    members = _keys(other, on).withColumn("_member", F.lit(1))
    return df.join(members, list(on), "left").withColumn(name, F.coalesce("_member", F.lit(0))).drop("_member")


def update_from(target: DataFrame, source: DataFrame, on: dict[str, str], columns: list[str]) -> DataFrame:
    """Take ``columns`` from the matching row of ``source``; unmatched rows keep their values.

    ``on`` maps a target column to a source column. Where several source rows
    match, the greatest tuple of ``columns`` wins, so a target row is never
    multiplied and the result does not depend on row order.
    """
    newest = (
        source.groupBy(*(F.col(theirs).alias(f"_k_{ours}") for ours, theirs in on.items()))
        .agg(F.max(F.struct(*columns)).alias("_new"))
    )
    condition = [target[ours] == newest[f"_k_{ours}"] for ours in on]
    joined = target.join(newest, condition, "left")
    matched = F.col("_new").isNotNull()
    return joined.select(
        *(
            F.when(matched, F.col(f"_new.{c}")).otherwise(target[c]).alias(c) if c in columns else target[c]
            for c in target.columns
        )
    )
