"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate frames by column name; a column that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
