"""Exact distinct counts that merge: bitmaps over dense key numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunehouse.operators.ranking import with_global_position


def with_new_numbers(known: DataFrame | None, keys: DataFrame) -> DataFrame:
    """(key, number) of the keys that ``known`` lacks, numbered on from its highest number; NULL keys have none.

    Numbers are 1, 2, 3, … without gaps, so that bitmaps over them are full whatever the keys are, and never change.
    """
    fresh = keys.select(F.col(keys.columns[0]).alias("key")).dropna().distinct()
    last = 0
    if known is not None:
        fresh = fresh.join(known.select("key"), "key", "left_anti")
        last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    return with_global_position(fresh, "key", name="position").select("key", (F.col("position") + (last + 1)).alias("number"))


def bitmap_states(rows: DataFrame, group: list[str], number: str = "number") -> DataFrame:
    """(group, bucket, bitmap): which numbers occur, 64 to a BIGINT; combined within each task before the shuffle.

    There are never more states than rows, however thinly the numbers lie in a group, and a state is as short as a row: it
    is hashed in place, where a long binary bitmap would be sorted whole.
    """
    at = F.col(number).cast("bigint") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    return rows.where(F.col(number).isNotNull()).groupBy(*group, F.shiftright(at, 6).alias("bucket")).agg(F.bit_or(bit).alias("bitmap"))


def merged(states: DataFrame, group: list[str]) -> DataFrame:
    """States of fewer columns, or of several loads, as one per group and bucket."""
    return states.groupBy(*group, "bucket").agg(F.bit_or("bitmap").alias("bitmap"))


def distinct_counts(states: DataFrame, group: list[str], name: str) -> DataFrame:
    """Distinct numbers per group over all states, without the rows they came from."""
    return merged(states, group).groupBy(*group).agg(F.sum(F.bit_count("bitmap")).alias(name))
