"""One column-oriented JSON document of any size, read by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.session import land
from tunehouse.sources.files import cells_of_columns, columns_as_maps

SPLIT = ["file", "block"]
CELL_DEPTH = 2  # braces around the cells of ``{"column": {"0": value}}``


def _count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _depth_change(bare: Column, inside: Column) -> Column:
    """Brackets opened less those closed outside strings, for a piece that begins inside a string or not."""
    text = F.when(inside, F.concat(F.lit('"'), bare)).otherwise(bare)
    outside = F.regexp_replace(text, '"[^"]*+"?+', "")
    return (_count(outside, "{[") - _count(outside, "}]")).cast("bigint")


def _running(amount: Column, inclusive: bool = False) -> Column:
    """Running sum within a split."""
    upto = Window.partitionBy(*SPLIT).orderBy("i").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return F.coalesce(F.sum(amount).over(upto), F.lit(0))


def _over_splits(amount: Column) -> Column:
    """Sum over the earlier splits of a file."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(earlier), F.lit(0))


def pieces_of(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """What lies between commas, told apart by (file, block, i): block is where the split begins that a task reads.

    With ``parts`` the files of a folder, in the order of their names, are one document, of which each ends with a comma.
    """
    read = spark.read.option("lineSep", ",").text(path)
    file, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    block = F.concat(name, F.lit(" "), F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0"))
    document = F.expr("substr(_metadata.file_path, 1, length(_metadata.file_path) - length(_metadata.file_name))") if parts else file
    return read.select(document.alias("file"), block.alias("block"), F.monotonically_increasing_id().alias("i"), "value")


def with_state(pieces: DataFrame) -> DataFrame:
    """(file, block, i, value, depth, ends): the brackets open before a piece, and whether its comma ends an entry.

    Every split first counts quotes as if it began outside strings, and brackets for either case; one row per split
    then tells all splits how they really begin. A comma inside a string or a nested value ends no entry. A document
    that ends inside a string or with open brackets fails.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # without escapes, as of quotes in strings
    counted = pieces.withColumn("bare", bare).withColumn("quotes", _count(F.col("bare"), '"'))
    odd = counted.withColumn("odd", _running(F.col("quotes")) % 2 == 1)
    either = odd.select(
        *SPLIT,
        "i",
        "value",
        "odd",
        (F.col("quotes") % 2 == 1).alias("turns"),
        _depth_change(F.col("bare"), F.col("odd")).alias("change"),
        _depth_change(F.col("bare"), ~F.col("odd")).alias("change_if_inside"),
    )
    known = land(either, "json-pieces")
    sums = known.groupBy(*SPLIT).agg(
        F.sum(F.col("turns").cast("bigint")).alias("turns"), F.sum("change").alias("change"), F.sum("change_if_inside").alias("change_if_inside")
    )
    # a row per split of a file from here on: as many as there were tasks to read it
    starts = sums.withColumn("inside", _over_splits(F.col("turns")) % 2 == 1)
    starts = starts.withColumn("real", F.when(F.col("inside"), F.col("change_if_inside")).otherwise(F.col("change")))
    whole = Window.partitionBy("file")
    broken = (F.sum("turns").over(whole) % 2 != 0) | (F.sum("real").over(whole) != 0)
    starts = starts.withColumn("depth_before", _over_splits(F.col("real")))
    failed = F.raise_error(F.concat(F.lit("not a whole JSON document: "), F.col("file")))
    starts = starts.select(*SPLIT, "inside", F.when(broken, failed).otherwise(F.col("depth_before")).cast("bigint").alias("depth_before"))
    joined = known.join(F.broadcast(starts), SPLIT)
    change = F.when(F.col("inside"), F.col("change_if_inside")).otherwise(F.col("change"))
    depth = joined.withColumn("change", change).withColumn("depth", F.col("depth_before") + _running(F.col("change")))
    inside_after = F.col("inside") != (F.col("odd") != F.col("turns"))
    ends = ~inside_after & (F.col("depth") + F.col("change") <= CELL_DEPTH)
    return depth.select(*SPLIT, "i", "value", "depth", (F.col("depth") + F.col("change")).alias("depth_after"), ends.alias("ends"))


def entries_of(pieces: DataFrame) -> DataFrame:
    """(file, column, text, depth, depth_after) of every entry: pieces up to a comma that ends one, joined again.

    ``column`` is the number of the entry that names its column: itself, or the last one before it that is not inside a
    column.
    """
    known = land(with_state(pieces), "json-state")
    ends = F.col("ends").cast("bigint")
    opens = (F.col("ends") & (F.col("depth_after") < CELL_DEPTH)).cast("bigint")
    sums = known.groupBy(*SPLIT).agg(F.sum(ends).alias("n_ends"), F.sum(opens).alias("n_opens"))
    starts = sums.select(*SPLIT, _over_splits(F.col("n_ends")).alias("first_entry"), _over_splits(F.col("n_opens")).alias("first_column"))
    placed = known.join(F.broadcast(starts), SPLIT).select(
        "file",
        "block",
        "i",
        "value",
        "depth",
        "depth_after",
        (F.col("first_entry") + _running(ends)).alias("entry"),
        (F.col("first_column") + _running(opens)).alias("column"),
    )
    at = F.struct("block", "i")
    joined = placed.groupBy("file", "entry").agg(
        F.first("column").alias("column"),
        F.array_sort(F.collect_list(F.struct("block", "i", "value"))).alias("pieces"),
        F.min_by("depth", at).alias("depth"),
        F.max_by("depth_after", at).alias("depth_after"),
    )
    return joined.select("file", "column", F.array_join("pieces.value", ",").alias("text"), "depth", "depth_after")


def read_json_document(spark: SparkSession, path: str, schema: T.StructType, parts: bool = False) -> DataFrame:
    """The rows that ``read_json_columns`` gives, from documents that are split among tasks wherever commas are.

    A document is a file, or with ``parts`` a folder of files in a row. Each entry is put back between the braces and below the column name that it stood in, and then parsed like a small document of
    its own. One value is never split, so it has to fit in a task.
    """
    entries = land(entries_of(pieces_of(spark, path, parts)), "json-entries")
    named = entries.where(F.col("depth") < CELL_DEPTH)
    name = F.regexp_extract("text", r'^\s*+\{?+\s*+("(?:[^"\\]++|(?s:\\.))*+")\s*+:', 1)
    names = land(named.select("file", "column", name.alias("name")), "json-column-names")
    whole = F.concat(
        F.when(F.col("depth") == 0, F.lit("")).when(F.col("depth") == 1, F.lit("{")).otherwise(F.concat(F.lit("{"), "name", F.lit(":{"))),
        F.col("text"),
        F.repeat(F.lit("}"), F.col("depth_after").cast("int")),
    )
    documents = entries.join(names, ["file", "column"]).select(
        F.col("file").alias("_document"), F.from_json(whole, columns_as_maps(schema), {"mode": "FAILFAST"}).alias("_d")
    )
    return cells_of_columns(documents.select("_document", "_d.*"), schema)
