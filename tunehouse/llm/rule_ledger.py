"""Quality rules as a ledger: every rule evaluated once, its failures kept as bits, policies applied afterwards."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_capitals")
WINDOW = 5

# A rule fails where its condition holds. Bits are never given to another rule, so that old ledgers stay readable.
# Conditions are in whole numbers, so that every engine decides alike.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 10"),
    "repeated_words": (1, "100 * n_repeat_words > 20 * n_words"),
    "symbols": (2, "4 * n_symbols > n_words"),
    "exclamations": (3, "4 * n_bangs > n_words"),
    "capitals": (4, "2 * n_capitals > word_chars"),
    "repeated_lines": (5, "100 * n_dup_lines > 30 * n_lines"),
    "long_words": (6, "word_chars > 15 * n_words"),
    "short_words": (7, "word_chars < 2 * n_words"),
}
# A policy is a set of rules; a version is never changed, a new one is added.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_words"),
    "v2": ("few_words", "repeated_words", "symbols", "exclamations", "capitals", "repeated_lines", "long_words", "short_words"),
}
CURRENT = "v2"


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five words that occur twice or more in the text, the first occurrence included."""
    n = len(words) - WINDOW + 1
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if n < 2 or len(numbers) == len(words):
        return 0
    # numbers for ever longer windows, exact: a number stands for a pair of numbers of shorter windows
    two = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    four = np.unique(two[:-2] * len(words) + two[2:], return_inverse=True)[1]
    five, count = np.unique(four[:-1] * len(words) + ids[4:], return_inverse=True, return_counts=True)[1:]
    again = (count > 1)[five]
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[WINDOW:] -= again
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The values of MEASURES for one whole text; all 0 for NULL."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]

    def among(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    return (
        len(words),
        len(text) - among(b" \t\n\v\f\r"),
        among(b"#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        among(b"!"),
        among(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    )


def fail_bits() -> Column:
    """One bit per rule, set where the rule fails."""
    bits = F.lit(0).cast("bigint")
    for bit, condition in RULES.values():
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def mask(policy: str, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> int:
    return sum(1 << RULES[name][0] for name in policies[policy])


def passes(policy: str = CURRENT, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> Column:
    """Over a ledger: no rule of the policy fails."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, policies))) == 0


def build_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, the measurements and fail_bits. No shuffle.

    NULL texts measure 0 throughout (and so fail few_words); repeated rows and NULL ids each keep their row; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(1)]
            values = np.array(rows, np.int64).reshape(-1, len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, values)], names=["id", *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    measured = slim.mapInArrow(run, f"id {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))
    return measured.withColumn("fail_bits", fail_bits()).withColumnRenamed("id", id_col)


def ablations(ledger: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """(policy, rule, bit, n_docs, n_failing, n_only): documents the rule fails, and those that no other rule of the
    policy would drop, so leaving the rule out brings exactly these back.

    The ledger is first summed up per bit pattern, at most 2^rules rows, within each task before the shuffle.
    """
    patterns = ledger.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cases = [
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(p, policies)).alias("mask"), F.lit(1 << RULES[r][0]).alias("bit"))
        for p, rules in policies.items()
        for r in rules
    ]
    each = patterns.select("*", F.explode(F.array(*cases)).alias("c")).select("fail_bits", "n", "c.*")
    n = F.col("n")
    return each.groupBy("policy", "rule", "bit").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(F.expr("fail_bits & bit") != 0, n).otherwise(0)).alias("n_failing"),
        F.sum(F.when(F.expr("fail_bits & mask") == F.col("bit"), n).otherwise(0)).alias("n_only"),
    )


def with_ablations(judged: DataFrame, ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """``judged`` with n_only: for a document that a single rule of the policy drops, how many documents that rule alone
    drops, itself included, which are those that come back without the rule; NULL for the others."""
    only = ablations(ledger, {policy: POLICIES[policy]}).select(F.col("bit").alias("__bit"), "n_only")
    # one row per rule
    return judged.join(F.broadcast(only), F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == F.col("__bit"), "left").drop("__bit")


def rules_in_common(ledger: DataFrame, by: str, policy: str = CURRENT) -> DataFrame:
    """Per group: rules that fail for some rejected document, and rules that fail for all of them, as bits."""
    rejected = ledger.where(~passes(policy))
    return rejected.groupBy(by).agg(
        F.count("*").alias("n_rejected"), F.bit_or("fail_bits").alias("some"), F.bit_and("fail_bits").alias("all")
    )


def judged(ledger: DataFrame, policy: str = CURRENT, base: str = "v1") -> DataFrame:
    """The ledger with base_failed and kept."""
    return ledger.withColumn("base_failed", ~passes(base)).withColumn("kept", passes(base) & passes(policy))


#: DuckDB
JUDGED_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
u as (select r, unnest(ws) as x, generate_subscripts(ws, 1) as i from w),
g as (select r, i, x, lead(x, 1) over o as x1, lead(x, 2) over o as x2, lead(x, 3) over o as x3, lead(x, 4) over o as x4
      from u window o as (partition by r order by i)),
c as (select r, i, count(*) over (partition by r, x, x1, x2, x3, x4) as n from g where x4 is not null),
p as (select r, count(distinct j) as n_repeat_words
      from (select r, unnest(range(i, i + 5)) as j from c where n > 1) group by r),
m as (select w.doc_id, len(ws) as n_words,
             coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
             len(ls) - len(list_distinct(ls)) as n_dup_lines,
             coalesce(p.n_repeat_words, 0) as n_repeat_words,
             len(ls) as n_lines,
             length(t) - length(regexp_replace(t, '!', '', 'g')) as n_bangs,
             length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals
      from w left join p using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 as base_failed,
       fail_bits = 0 as kept, fail_bits::bigint as fail_bits,
       case when bit_count(fail_bits) = 1 then count(*) over (partition by fail_bits) end as n_only
from (select *, case when n_words < 10 then 1 else 0 end + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
                + case when 4 * n_symbols > n_words then 4 else 0 end + case when 4 * n_bangs > n_words then 8 else 0 end
                + case when 2 * n_capitals > word_chars then 16 else 0 end + case when 100 * n_dup_lines > 30 * n_lines then 32 else 0 end
                + case when word_chars > 15 * n_words then 64 else 0 end + case when word_chars < 2 * n_words then 128 else 0 end as fail_bits
      from m)
"""
