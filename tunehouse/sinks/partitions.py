"""Tables in folders by the value of a column, of which only the folders concerned are read or rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.operators.joins import semi_join, update_from
from tunehouse.session import land


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """A folder per value of ``by``, which has few values; a value's rows are written by all the tasks that hold some."""
    df.write.partitionBy(by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def update_stored(spark: SparkSession, path: str, schema: T.StructType, by: str, source: DataFrame, on: dict[str, str], columns: list[str]) -> list:
    """``update_from`` on a stored table; gives the values of ``by`` whose folders were rewritten.

    First only keys are read, to find the folders with a matched row; then only those folders are read, updated and
    put in place of the old ones by a dynamic partition overwrite. A row stays in its folder, so ``by`` is not updated. The
    values are gathered on the driver, which lists the folders anyway. The updated rows are stored before the
    first folder is replaced, so a job that fails until then changes nothing; a job that fails later has replaced some
    folders and can be run again, if ``source`` does not depend on the table.
    """
    if by in columns:
        raise ValueError(f"{by} decides on the folder and cannot be updated")
    stored = read_partitioned(spark, path, schema)
    source = land(source.select(*{*on.values(), *columns}), "update-source")
    keys = semi_join(stored.select(*dict.fromkeys([*on, by])), source, on)
    hit = [r[0] for r in keys.select(by).distinct().toLocalIterator()]
    if not hit:
        return []
    values = [v for v in hit if v is not None]
    concerned = F.col(by).isin(values) | F.col(by).isNull() if None in hit else F.col(by).isin(values)
    updated = land(update_from(stored.where(concerned), source, on, columns).select(*stored.columns), "updated")
    updated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return hit
