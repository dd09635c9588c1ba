"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunehouse.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def landed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared scratch folder and read it back; also gives the folder, for ``remove``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``landed`` wrote and that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text, whole; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that helper columns beside it clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def fields(df: DataFrame, row: str, **changed: Column) -> list[Column]:
    """The columns of ``df`` out of a ``whole_row`` column, some of them with another value."""
    return [changed.get(c, F.col(f"{row}.`{c}`")).alias(c) for c in df.columns]
