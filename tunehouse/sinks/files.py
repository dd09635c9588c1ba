"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunehouse.session import land


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column; replaces what lies at ``path``."""
    df.write.option("header", True).mode("overwrite").csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = "-") -> None:
    """Text with a header and a chosen separator."""
    df.write.option("header", True).option("sep", sep).mode("overwrite").csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_columns(df: DataFrame, path: str, key: str, rows_per_document: int = 1000) -> None:
    """Column-oriented documents, one per line.

    ``key`` is a unique non-negative integer column. It places the rows into
    documents of at most ``rows_per_document`` rows each, so no document grows
    with the table.
    """
    index = (F.col(key) % rows_per_document).cast("string")
    document = F.call_function("div", F.col(key), F.lit(rows_per_document))
    columns = [
        F.map_from_entries(F.collect_list(F.struct(index, F.col(field.name)))).alias(field.name)
        for field in df.schema.fields
    ]
    df.groupBy(document.alias("_document")).agg(*columns).drop("_document").write.mode("overwrite").json(path)




def write_json_document(df: DataFrame, path: str, key: str) -> None:
    """All rows as one column-oriented document, whose consecutive parts are the files of ``path`` in the order of their names.

    ``key`` is a unique column that names the rows. The cells are dealt and sorted by column and key, so each task
    writes its part of the document; every cell ends with a comma, the last one of the document too. NULL cells are left out.
    """
    cells = [
        F.struct(F.lit(i).alias("column"), F.to_json(F.create_map(F.col(key).cast("string"), F.col(f.name))).alias("cell"))
        for i, f in enumerate(df.schema.fields)
    ]
    kept = [F.when(F.col(f.name).isNotNull(), c) for f, c in zip(df.schema.fields, cells, strict=True)]
    rows = df.select(F.col(key).alias("key"), F.explode(F.filter(F.array(*kept), lambda c: c.isNotNull())).alias("c"))
    rows = land(rows.select("key", "c.column", F.expr("substr(c.cell, 2, length(c.cell) - 2)").alias("cell")), "json-cells")
    ends = rows.groupBy("column").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    # a row per column of the schema
    ends = ends.withColumn("last_column", F.max("column").over(Window.partitionBy(F.lit(1)))).withColumn(
        "first_column", F.min("column").over(Window.partitionBy(F.lit(1)))
    )
    names = F.array(*[F.to_json(F.create_map(F.lit(f.name), F.lit(0))) for f in df.schema.fields])
    name = F.expr("substr(name, 2, length(name) - 3)")  # what stands before the 0
    marked = rows.join(F.broadcast(ends), "column").withColumn("name", F.get(names, F.col("column")))
    opening = F.concat(F.when(F.col("column") == F.col("first_column"), F.lit("{")).otherwise(F.lit("")), name, F.lit("{"))
    closing = F.when(F.col("column") == F.col("last_column"), F.lit("}}")).otherwise(F.lit("}"))
    text = F.concat(
        F.when(F.col("key") == F.col("first"), opening).otherwise(F.lit("")),
        "cell",
        F.when(F.col("key") == F.col("last"), closing).otherwise(F.lit("")),
    )
    ordered = marked.select("column", "key", text.alias("text")).orderBy("column", "key").select("text")
    ordered.write.option("lineSep", ",").mode("overwrite").text(path)
