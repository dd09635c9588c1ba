"""Mix sources to target weights by weighted random sampling without replacement (exponential keys)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunehouse.llm.common import WORD, fields, landed, text_or_empty, whole_row, word_count
from tunehouse.operators.ranking import with_global_position

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
BINS = 4096  # bins per unit of key; a source's cut falls into one bin, and only that bin's rows are sorted
SYMBOLS = "[#*$%&|<>!]"
LEAST_WEIGHT = 0.05
OWN = ("__size", "__key", "__bin")  # columns put beside the documents' own


def quality_weight(text: Column) -> Column:
    """Share of a text's characters that are not junk symbols; 0.05 at least."""
    chars = F.length(text) + 1
    return F.greatest(F.lit(LEAST_WEIGHT), (chars - F.regexp_count(text, F.lit(SYMBOLS))).cast("double") / chars)


def exponential_key(doc_id: Column, size: Column, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u from a hash of seed, id and size: the smaller, the sooner taken."""
    known = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"))
    u = (F.conv(F.substring(F.md5(known), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def with_keys(docs: DataFrame, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with __size (words; 0 for NULL), __key and __bin."""
    weight = quality_weight(text_or_empty()) if weight is None else weight
    sized = docs.withColumns({"__size": word_count(F.col("text")), "__weight": weight})
    keyed = sized.withColumn("__key", exponential_key(F.col("doc_id"), F.col("__size"), F.col("__weight"), seed))
    return keyed.withColumn("__bin", F.floor(F.col("__key") * BINS)).drop("__weight")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> with target: the words that the mix takes from a source.

    Sources by code point, NULL last, weigh ``weights`` in turn and share all sizes' sum. A target stops at cap x
    its source's size; what it leaves goes to the others by weight. In ascending order of cap / weight the stopped
    ones come first, so the level of the others follows from sums over the order. One row per source, sorted in
    one task: sources are few against documents.
    """
    turn = F.array(*map(F.lit, weights))
    ranked = sizes.withColumn("__turn", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.select(
        "source",
        "source_size",
        F.element_at(turn, (F.col("__turn") % len(weights) + 1).cast("int")).cast("bigint").alias("w"),
        (F.col("source_size") * cap).alias("most"),
        "__turn",
    )
    order = W.orderBy(F.col("most").cast("double") / F.col("w"), "__turn")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = ranked.withColumns(
        {
            "left": F.sum("source_size").over(every) - (F.sum("most").over(upto) - F.col("most")),
            "heft": F.sum("w").over(onward),
        }
    )
    stopped = left.withColumn("stopped", F.col("most") * F.col("heft") <= F.col("left") * F.col("w"))
    free = F.when(~F.col("stopped"), F.struct("left", "heft"))
    level = stopped.withColumn("level", F.first(free, ignorenulls=True).over(every))
    share = (F.col("level.left") * F.col("w")).cast("double") / F.col("level.heft")
    return level.select("source", "source_size", F.when(F.col("stopped"), F.col("most")).otherwise(share).alias("target"))


def mixing_plan(keyed: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: its target, the complete epochs, and the place in the order of keys where its fractional
    epoch is cut: (key, doc_id, size) of the document that is cut, how many rows are equal in that, and the words taken of them.

    Sizes are summed up per source and bin within each task first, so a source with a third of all documents is
    some ten thousand rows, and only the rows of the bin with the cut are sorted, equal ones as one. ``keyed``
    should be stored, as it is read three times.
    """
    bins = keyed.groupBy("source", "__bin").agg(F.sum("__size").alias("n"))
    sizes = bins.groupBy("source").agg(F.sum("n").alias("source_size"))
    targets = source_targets(sizes, weights, cap)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    planned = targets.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))

    def before(words: str, *order: str) -> Column:
        upto = W.partitionBy("s").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return F.sum(words).over(upto) - F.col(words)

    def reached(words: str) -> Column:
        return (F.col("before") < F.col("rest")) & (F.col("before") + F.col(words) >= F.col("rest"))

    same_source = F.col("source").eqNullSafe(F.col("s"))
    placed = bins.withColumnRenamed("source", "s").withColumn("before", before("n", "__bin"))
    cut_bins = planned.join(placed, same_source).where(reached("n"))
    cut_bins = cut_bins.select("s", "rest", F.col("__bin").alias("cut_bin"), F.col("before").alias("start"))
    near = keyed.join(cut_bins, same_source & (F.col("__bin") == F.col("cut_bin")))
    rows = near.groupBy("s", "rest", "start", "__key", "doc_id", "__size").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("words", F.col("copies") * F.col("__size"))
    rows = rows.withColumn("before", F.col("start") + before("words", "__key", "doc_id", "__size")).where(reached("words"))
    cut = rows.select("s", F.struct("__key", "doc_id", "__size").alias("cut"), "copies", (F.col("rest") - F.col("before")).alias("cut_words"))
    return planned.join(cut, same_source, "left").drop("s")


def _with_taken(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """``keyed`` with the plan's columns as __plan and with __extra, the words of the fractional epoch.

    Rows that are equal at a cut are numbered: the first ones are taken whole, the next one is cut, the others are left. They
    can be a large part of all rows, so they are numbered by a sort over all tasks; mostly there are none.
    """
    named = plan.select(F.col("source").alias("__s"), F.struct(*plan.columns).alias("__plan"))
    rows = keyed.join(named, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    here, cut = F.struct("__key", "doc_id", "__size"), F.col("__plan.cut")
    extra = F.when(here < cut, F.col("__size")).when(here == cut, F.col("__plan.cut_words")).otherwise(0)
    alone = rows.withColumn("__extra", extra.cast("bigint"))
    if plan.where("copies > 1").isEmpty():
        return alone
    tied = F.coalesce((here == cut) & (F.col("__plan.copies") > 1), F.lit(False))
    placed = with_global_position(rows.where(tied), F.asc_nulls_last("source"), name="__place")
    first = placed.groupBy(F.col("source").alias("__s")).agg(F.min("__place").alias("__first"))
    placed = placed.join(first, F.col("source").eqNullSafe(F.col("__s")))
    left = F.col("__plan.cut_words") - (F.col("__place") - F.col("__first")) * F.col("__size")
    shared = placed.withColumn("__extra", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("__size"), left)))
    return alone.where(~tied).unionByName(shared.select(*alone.columns))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, and taken, the words that the mix takes of it.

    A source's target is made of complete epochs of all its documents, then of documents in ascending order of
    their keys, a document of twice the weight coming first twice as often; the last of these is cut so that the
    source meets its target's whole words exactly. NULL and blank texts have size 0 and give nothing; a NULL source
    is a source; repeated rows and NULL ids share their draw, and of equal rows at the cut some are taken whole and one
    in part. An empty table gives no rows.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    if weight is not None:
        slim = docs.withColumn("__w", weight).select("doc_id", "text", "source", "__w")
    keyed = landed(with_keys(slim, None if weight is None else F.col("__w"), seed).select("doc_id", "source", *OWN), "mix-keys")[0]
    taken = _with_taken(keyed, landed(mixing_plan(keyed, weights, cap), "mix-plan")[0])
    return taken.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__plan.source_size").alias("source_size"),
        F.col("__plan.target").alias("target"),
        (F.col("__plan.epochs") * F.col("__size") + F.col("__extra")).alias("taken"),
    )


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word."""
    ends = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
    return F.array_join(F.slice(F.split(text, ends), F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The documents of the mix, columns as in ``docs``: a row per epoch, the cut document with its first words only.

    The documents themselves are neither shuffled nor sorted: each is held against its source's row of the stored
    plan, which Spark broadcasts if it is small. n_chars, where there is one, follows the text.
    """
    packed = docs.select(
        whole_row(docs).alias("__row"), "doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")
    )
    keyed = with_keys(packed, None, seed)
    slim = landed(keyed.select("doc_id", "source", *OWN), "mix-keys")[0]
    rows = _with_taken(keyed, landed(mixing_plan(slim, weights, cap), "mix-plan")[0])
    extra = F.col("__extra")
    part = F.when(extra == F.col("__size"), F.col("text")).otherwise(first_words(F.col("text"), extra))
    parts = F.when(extra > 0, F.array(part)).otherwise(F.array().cast("array<string>"))
    copies = F.concat(F.array_repeat("text", F.col("__plan.epochs").cast("int")), parts)
    out = rows.where("__size > 0").select("__row", F.explode(copies).alias("__text"))
    changed = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType)
    return out.select(*fields(docs, "__row", **changed))


#: DuckDB
MIX_SQL = rf"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
z as (select *, len(regexp_extract_all(t, '{WORD}'))::bigint as size from d),
k as (select doc_id, source, size,
             -ln((('0x' || substr(md5('{SEED}|' || coalesce(doc_id::varchar, '') || '|' || size), 1, 13))::bigint::double + 0.5)
                 / 4503599627370496.0)
             / greatest({LEAST_WEIGHT}, (length(t) + 1 - len(regexp_extract_all(t, '{SYMBOLS}')))::double / (length(t) + 1)) as key
      from z),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as turn
      from k group by source),
w as (select *, [5, 2, 1][turn % 3 + 1] as w from s),
o as (select *, sum(source_size) over ()
             - coalesce(sum(3 * source_size) over (order by 3.0 * source_size / w, turn
                        rows between unbounded preceding and 1 preceding), 0) as remains,
             sum(w) over (order by 3.0 * source_size / w, turn
                          rows between current row and unbounded following) as heft from w),
l as (select arg_max(remains, remains / heft)::bigint as remains, arg_max(heft, remains / heft)::bigint as heft from o),
t as (select source, source_size, least(3.0 * source_size, (l.remains * w)::double / l.heft) as target from w, l),
e as (select *, case when source_size > 0 then floor(target)::bigint // source_size else 0 end as epochs from t),
r as (select k.*, e.source_size, e.target, e.epochs, floor(e.target)::bigint - e.epochs * e.source_size as rest,
             coalesce(sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.size
                      rows between unbounded preceding and 1 preceding), 0) as before
      from k join e on k.source is not distinct from e.source)
select doc_id, size, source_size, target::double as target,
       (epochs * size + greatest(0, least(size, rest - before)))::bigint as taken
from r
"""
