"""Delimited text, JSON Lines and column-oriented JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "-") -> DataFrame:
    """Text with a header line, which must name the schema's columns in order.

    A row with a surplus field fails the job rather than losing text, whichever
    columns are asked for: every line is parsed whole.
    """
    reader = spark.read.option("enforceSchema", False).option("columnPruning", False)
    return reader.csv(path, schema=schema, sep=sep, header=True, mode="FAILFAST")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_columns(spark: SparkSession, path: str, schema: T.StructType, one_per_line: bool = False) -> DataFrame:
    """Documents of the shape ``{"column": {"0": value, "1": value}}``, as rows.

    A file holds one document, which may span lines; with ``one_per_line`` each
    line is a document, so that a large file can be split among tasks; for one
    large document see ``json_document``. A cell that a column lacks is NULL.
    """
    documents = spark.read.schema(columns_as_maps(schema)).option("mode", "FAILFAST").json(path, multiLine=not one_per_line)
    return cells_of_columns(documents.withColumn("_document", F.monotonically_increasing_id()), schema)


def columns_as_maps(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.MapType(T.StringType(), f.dataType)) for f in schema.fields])


def cells_of_columns(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of documents (_document, and a map of cells per column); a document may come in several parts."""

    def cells(field: T.StructField):
        """A column's entries, as rows of which only this column is filled."""

        def row(entry):
            return F.struct(
                entry["key"].alias("_row"),
                *(
                    (entry["value"] if f.name == field.name else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in schema.fields
                ),
            )

        entries = F.coalesce(F.map_entries(field.name), F.array().cast(_entries_type(field)))
        return F.transform(entries, row)

    # entries are grouped, not looked up: finding each row key in each map would be quadratic in a document
    names = schema.fieldNames()
    every = documents.select("_document", F.inline(F.concat(*map(cells, schema.fields))))
    return every.groupBy("_document", "_row").agg(*(F.first(n, ignorenulls=True).alias(n) for n in names)).select(*names)


def _entries_type(field: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", field.dataType)]))
