"""Near-duplicates by SimHash, searched in a grid of per-segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunehouse.llm.common import fields, landed, text_or_empty, whole_row
from tunehouse.llm.components import connected_components

SEED = 42
CHUNK = 65_536  # hashes counted at a time, so that a very long text needs no more memory
EVEN_BITS = 0x5555555555555555


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of a text: unsigned, 64 bits; 0 without any word (NULL, empty, white space only).

    Words are split at ASCII white space after lower-casing A-Z. Shingles are `words` words, repeats included,
    joined by a space; a text of fewer words is one shingle. A bit is set if it is set in over half of the hashes.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) < words:
        return digest(b" ".join(parts), SEED)
    total = len(parts) - words + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, CHUNK):
        stop = min(start + CHUNK, total)
        columns = [parts[start + i : stop + i] for i in range(words)]
        grams = map(b" ".join, zip(*columns, strict=True))
        hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, stop - start)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp) per row; fp is the fingerprint as a signed bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {kind}, fp bigint")


def popcount_cell(fp: Column) -> Column:
    """The point of a fingerprint: its bit count (0 to 2) in each of 32 segments of 2 bits, 2 bits per count."""
    low = fp.bitwiseAND(F.lit(EVEN_BITS))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN_BITS))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _steps(cell: str) -> str:
    """SQL: the points one step away; a count may go 0-1 and 1-2, which are these bit flips of its field."""
    field = f"(shiftrightunsigned({cell}, 2 * i) & 3)"
    one = f"if({field} < 2, {cell} ^ shiftleft(1L, 2 * i), null)"
    three = f"if({field} > 0, {cell} ^ shiftleft(3L, 2 * i), null)"
    return f"array_compact(flatten(transform(sequence(0, 31), i -> array({one}, {three}))))"


def link_fingerprints(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (u, v), u < v, of the distinct fingerprints ``prints.fp`` that differ in at most ``max_bits`` bits.

    Two fingerprints differ in at least as many bits as the Manhattan distance of their points. Points at a
    distance of max_bits or less share a grid cell within ceil(max_bits / 2) steps of both, so both are copied to
    all cells that near and joined on the cell; the bits are compared exactly in the join condition. 32 segments
    hold about 45 bits of a random fingerprint, so even 10^10 fingerprints meet few strangers in a cell, and each
    is copied to about 50 cells, however many fingerprints there are. A pair may come twice.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    # few bytes, but some fifty rows each: the number of tasks is not left to their size
    dealt = prints.select("fp").repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    points = dealt.select("fp", F.array(popcount_cell(F.col("fp"))).alias("cells"))
    for _ in range((max_bits + 1) // 2):
        around = F.expr(f"flatten(transform(cells, c -> array_append({_steps('c')}, c)))")
        points = points.select("fp", F.array_distinct(around).alias("cells"))
    cells = points.select("fp", F.explode("cells").alias("cell"))
    a, b = cells.select("cell", F.col("fp").alias("u")), cells.select("cell", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    at_u, at_v = (F.col("cell") == popcount_cell(F.col(x)) for x in "uv")
    # one cell is enough for a pair on one point, and for a pair one step apart
    once = F.when(popcount_cell(F.col("u")) == popcount_cell(F.col("v")), at_u).otherwise(~at_v)
    return a.join(b, "cell").where("u < v").where(near & once).select("u", "v")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2
) -> DataFrame:
    """(id, fingerprint, component_id, component_key) per row of ``docs``.

    Rows are linked when their fingerprints differ in at most ``max_bits`` bits; component_id is the smallest id
    reachable (NULL ids are passed over, a component of NULL ids has NULL), component_key its smallest
    fingerprint, signed. Copies are one fingerprint from the start, so a group of any size is one node. Texts
    without words have fingerprint 0 and are linked like any other. Repeated rows each give a row; other columns
    are ignored; an empty table gives no rows.
    """
    own = landed(with_fingerprints(docs, id_col, text_col, words), "fingerprints")[0]
    prints = landed(own.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")[0]
    found = connected_components(link_fingerprints(prints, max_bits))
    linked = prints.join(found, prints["fp"] == found["node"]).select("fp", "component", "least")
    smallest = linked.groupBy("component").agg(F.min("least").alias("smallest"))
    named = linked.join(smallest, "component").select("fp", "component", "smallest")
    every = prints.join(named, "fp", "left").select(
        "fp",
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("component_id"),
        F.coalesce("component", "fp").alias("component_key"),
    )
    every = landed(every, "fingerprint-groups")[0]  # a plain join of two exchanges next: a hot fingerprint can be split
    return own.join(every, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "component_key",
    )


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` with exactly one row left of each group of near-duplicates: that of the smallest doc_id.

    A row is known by its doc_id and its text, so two texts of one doc_id are two rows, each in its own group. Rows
    without doc_id come last in a group; of rows of one id the smallest hash of the text counts. Of rows that are equal in both one stays.
    """
    ident = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.sha2(text_or_empty(), 256).alias("text"))
    named = docs.select(whole_row(docs).alias("row"), ident.alias("ident"), F.col("text").cast("string").alias("text"))
    groups = near_duplicates(named, id_col="ident", words=words, max_bits=max_bits)
    kept = groups.groupBy("component_key").agg(F.min("ident").alias("ident")).select("ident")
    # equal in id and text: the other columns decide, so that the same row stays whatever the order
    one = named.join(kept, "ident", "left_semi").groupBy("ident").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select(*fields(docs, "row"))
