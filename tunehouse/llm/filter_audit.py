"""How filters interact: every set of filters by a Gray-code walk, every order of them by differences of the sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunehouse.llm.common import landed

FILTERS = "ABCDE"
COPY = "E"  # the filter that looks at other documents; the others see one text
COUNTS = ("kept", "good", "toxic")
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no character
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def text_failures(raw: bytes) -> int:
    """Bits of the filters A to D that one whole text (UTF-8) fails, A lowest."""
    words = raw.split()
    chars = len(raw.translate(None, _CONTINUED))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * capitals > 10 * chars) << 2
        | (len(raw.translate(None, b"#$%&*|")) < len(raw)) << 3
    )


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, id, mask) per row of ``docs``: the filters it fails as bits. NULL texts are empty, NULL parts ''.

    A text is a copy (E) if the same whole text has a smaller id somewhere in the table; rows that repeat the smallest
    id are no copies, nor are rows without an id, which make no others copies either. Texts are compared by their SHA-256, so
    none is shuffled; only digests that occur twice are joined back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [t.as_py() for t in batch.column(2)]
            masks = pa.array([text_failures(r) for r in raws], pa.int32())
            digests = pa.array([hashlib.sha256(r).digest() for r in raws], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, digests], names=["part", "id", "mask", "digest"])

    kind = docs.schema[id_col].dataType.simpleString()
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    slim = docs.select(part.alias("part"), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    seen = landed(slim.mapInArrow(run, f"part string, id {kind}, mask int, digest binary"), "failures")[0]
    copied = seen.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = landed(copied.select("digest", "first"), "copied")[0]  # its size is then known, and decides on a broadcast
    bit = 1 << FILTERS.index(COPY)
    mask = F.col("mask") + F.when(F.col("id") > F.col("first"), bit).otherwise(0)
    return seen.join(copies, "digest", "left").select("part", "id", mask.alias("mask"))


def mask_cells(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, kept, good, toxic): documents of each set of failures, at most 2^filters rows a part.

    Several labels of an id count as one that is good or toxic if any of them is.
    """
    marks = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    each = masks.join(marks, "id", "left")
    return each.groupBy("part", "mask").agg(
        F.count("*").alias("kept"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS[1:]]
    )


def gray_walk(masks: np.ndarray, counts: np.ndarray, filters: int) -> Iterator[tuple[int, np.ndarray]]:
    """(set of active filters, counts that survive it) for all sets, each one filter away from the one before.

    Every cell counts how many of the active filters it fails: it leaves the survivors as the counter rises to 1 and is back
    as the counter falls to 0.
    """
    active = np.zeros(len(masks), np.int64)
    kept = counts.sum(axis=0)
    subset = 0
    yield subset, kept
    for i in range(1, 1 << filters):
        bit = (i & -i)  # the i-th step of a Gray code toggles the lowest bit set in i
        subset ^= bit
        cells = (masks & bit) != 0
        if subset & bit:
            active += cells
            kept = kept - counts[cells & (active == 1)].sum(axis=0)
        else:
            active -= cells
            kept = kept + counts[cells & (active == 0)].sum(axis=0)
        yield subset, kept


def subset_states(cells: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """(part, subset, kept, good, toxic): 2^filters rows a part, what is left under each set of filters."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        walk = list(gray_walk(part["mask"].to_numpy(np.int64), part[list(COUNTS)].to_numpy(np.int64), filters))
        out = pd.DataFrame([kept for _, kept in walk], columns=list(COUNTS))
        return out.assign(part=part["part"].iloc[0], subset=[s for s, _ in walk])

    schema = "part string, subset int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return cells.groupBy("part").applyInPandas(run, schema)


def order_steps(filters: Sequence[str] = FILTERS) -> list[tuple[str, int, str, int, int]]:
    """(order, step, filter, set before, set after) of all orders: k! * k rows, so for few filters only."""
    rows = []
    for order in permutations(filters):
        before = 0
        for step, name in enumerate(order, 1):
            after = before | 1 << filters.index(name)
            rows.append(("".join(order), step, name, before, after))
            before = after
    return rows


def audit(states: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from the states.

    A step is the difference of the states before and after it. ``shapley`` adds up what a filter removes over all orders.
    """
    spark = states.sparkSession
    steps = spark.createDataFrame(order_steps(filters), "filter_order string, step int, name string, before int, after int")
    everything = (1 << len(filters)) - 1

    def kept(subset: int):
        return F.sum(F.when(F.col("subset") == subset, F.col("kept")))

    alone = [
        F.struct(
            F.lit(name).alias("name"),
            (kept(0) - kept(1 << i)).alias("fails"),
            (kept(everything ^ 1 << i) - kept(everything)).alias("unique_fails"),
        )
        for i, name in enumerate(filters)
    ]
    single = states.groupBy("part").agg(F.array(*alone).alias("each")).select("part", F.inline("each"))
    left = states.select("part", F.col("subset").alias("before"), *[F.col(c).alias(f"{c}_before") for c in COUNTS])
    right = states.select("part", F.col("subset").alias("after"), *COUNTS)
    # the orders are k! * k rows whatever the data
    moves = left.join(F.broadcast(steps), "before").join(right, ["part", "after"]).join(single, ["part", "name"])
    removed = F.col("kept_before") - F.col("kept")
    return moves.select(
        "part",
        "filter_order",
        "step",
        "kept",
        removed.alias("removed"),
        (F.col("fails") - removed).alias("redundant"),
        "unique_fails",
        (F.col("good_before") - F.col("good")).alias("good_lost"),
        (F.col("toxic_before") - F.col("toxic")).alias("toxic_lost"),
        F.sum(removed).over(Window.partitionBy("part", "name")).alias("shapley"),
    )


def interaction_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of all documents, per language: 600 rows each; no documents give no rows. The states are stored."""
    cells = mask_cells(failures(docs), labels)
    return audit(landed(subset_states(cells), "subset-states")[0])


#: DuckDB; every order is applied to every set of failures, without the states.
AUDIT_SQL = r"""
with recursive d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by t) as first from d),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
      from labels group by doc_id),
m as (select part,
             case when len(ws) < 100 then 'A' else '' end
             || case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 'B' else '' end
             || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) then 'C' else '' end
             || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
             || case when doc_id > first then 'E' else '' end as fails,
             coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
      from w left join l using (doc_id)),
c as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, fails),
o as (select '' as done union all
      select done || x from o, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) where not contains(done, x)),
s as (select done as filter_order, k as step, substr(done, k, 1) as f, substr(done, 1, k - 1) as earlier
      from o, range(1, 6) r(k) where length(done) = 5),
r as (select c.part, filter_order, step, f,
             sum(case when translate(fails, earlier || f, '') = fails then n else 0 end) as kept,
             sum(case when contains(fails, f) and translate(fails, earlier, '') = fails then n else 0 end) as removed,
             sum(case when contains(fails, f) and translate(fails, earlier, '') <> fails then n else 0 end) as redundant,
             sum(case when fails = f then n else 0 end) as unique_fails,
             sum(case when contains(fails, f) and translate(fails, earlier, '') = fails then good else 0 end) as good_lost,
             sum(case when contains(fails, f) and translate(fails, earlier, '') = fails then toxic else 0 end) as toxic_lost
      from c, s group by c.part, filter_order, step, f)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
       redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
       toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, f))::bigint as shapley
from r
"""
