"""Top-k, ranking and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunehouse.functions.numbers import int_div
from tunehouse.operators.joins import broadcast_within
from tunehouse.session import land


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows in ``order``; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def group_top_n(df: DataFrame, n: int, group: list[str], *order: Column) -> DataFrame:
    """The first ``n`` rows of every group. Feed it pre-aggregated rows."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def group_best(df: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """The rows ranked first in every group, ties included."""
    ranked = df.withColumn("_rank", F.rank().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def with_global_position(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Add each row's 0-based position in the total ``order``, which must have no ties.

    A range-partitioned sort numbers the rows within each task; the sorted rows
    are landed, and the tasks' row counts (one row per task) give the offsets.
    No task ever holds more than its own range.
    """
    numbered = land(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "sorted")
    task = F.shiftrightunsigned("_slot", 33)
    within = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per task of the sort: a size set by the partition count, not by the data
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        numbered.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")
        .withColumn(name, F.col("_offset") + within)
        .drop("_task", "_slot", "_offset")
    )


def head_rest_split(df: DataFrame, n: int, *order: Column | str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows in ``order`` and all the others.

    With ``key``, a column that is unique and never NULL, the head comes from one pass in which each task keeps its own
    first ``n`` rows, and the rest are the rows without its keys: nothing but the head is moved or stored. Without one, every
    row is in one of the two also where it is repeated or holds NULLs: the rows get a number of their own and are landed
    with it, and both parts come from that. Ties go by the key or that number. One task gathers the ``n`` rows.
    """
    if key is not None:
        head = land(df.orderBy(*order, key).limit(n), "head-rows")
        return head.select(*df.columns), df.join(broadcast_within(head.select(key), n), key, "left_anti").select(*df.columns)
    numbered = land(df.withColumn("_number", F.monotonically_increasing_id()), "numbered-rows")
    head = numbered.orderBy(*order, "_number").limit(n)
    rest = numbered.join(broadcast_within(head.select("_number"), n), "_number", "left_anti")
    return head.select(*df.columns), rest.select(*df.columns)


def position_in_group(
    df: DataFrame, group: list[str], key: str, name: str = "position", lead: str | None = None, block: int = 65_536
) -> DataFrame:
    """1-based position of every row in its group by ``key``, a unique integer within it.

    With ``lead`` the order is ``lead`` descending, then ``key``. The group is
    cut by ``lead`` and into key ranges of at most ``block`` rows, numbered on
    their own; the counts of the earlier ranges are added. A group of any size is
    thereby spread over many tasks. Rows with a NULL in ``group`` or ``key`` drop out.
    """
    sub = [lead] if lead else []
    keys = [*group, *sub, "_block"]
    # the explicit shuffle keeps a partitioning by the whole group, left by an earlier join, from being reused;
    # with no NULL left, the join below adds no filter that would make the two branches differ
    local = (
        df.dropna(subset=[*group, *sub, key])
        .withColumn("_block", F.coalesce(int_div(F.col(key), block), F.lit(0)))
        .repartition(*keys)
        .withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(key)))
    )
    # counted on the numbered rows, so both branches read the same shuffle
    sizes = local.groupBy(*keys).agg(F.max("_local").alias("_rows"))
    offsets = sizes.select(*keys, _rows_before([*group, *sub], F.asc("_block")).alias("_offset"))
    if lead:
        ranks = sizes.groupBy(*group, lead).agg(F.sum("_rows").alias("_rows"))
        ranks = ranks.select(*group, lead, _rows_before(group, F.desc(lead)).alias("_above"))
        offsets = offsets.join(ranks, [*group, lead]).select(*keys, (F.col("_offset") + F.col("_above")).alias("_offset"))
    return (
        local.join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_block", "_local", "_offset")
    )


def _rows_before(group: list[str], order: Column) -> Column:
    """Running total of ``_rows`` over the earlier rows of the group."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_rows").over(earlier), F.lit(0))


def stride_of_counts(counts: DataFrame, value: str, rows: str, step: int, chunk: int = 100_000) -> DataFrame:
    """Every ``step``-th entry of a sorted column given as (value, number of rows).

    The same result as sorting all rows, from one row per distinct value: value
    ``v`` covers the positions ``[start, end)`` and is emitted once per multiple
    of ``step`` in there. The multiples are unfolded in chunks, so one very
    frequent value does not build a huge array. ``counts`` must be small: it is
    numbered in one task.
    """
    upto = Window.orderBy(F.asc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, 0)
    spans = counts.select(
        value,
        F.sum(rows).over(upto).alias("_end"),
        (F.sum(rows).over(upto) - F.col(rows)).alias("_start"),
    )
    first = int_div(F.col("_start") + (step - 1), step)
    last = int_div(F.col("_end") - 1, step)
    ticks = spans.select(value, first.alias("_first"), last.alias("_last")).filter("_first <= _last")
    starts = F.sequence("_first", "_last", F.lit(chunk).cast("bigint"))
    chunks = ticks.select(value, "_last", F.explode(starts).alias("_from"))
    return chunks.select(
        value, F.explode(F.sequence("_from", F.least(F.col("_last"), F.col("_from") + (chunk - 1)))).alias("_tick")
    ).select(value, (F.col("_tick") * step).alias("position"))
