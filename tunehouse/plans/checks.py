"""Data-quality checks in place of key constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.operators.sets import union_all


def _as_rows(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts ``_0, _1, …`` as rows of ``check_name, violations``."""
    pairs = (F.struct(F.lit(n).alias("check_name"), F.col(f"_{i}").alias("violations")) for i, n in enumerate(names))
    return counts.select(F.inline(F.array(*pairs)))


def check_table(
    df: DataFrame, table: str, key: list[str], required: list[str], lengths: dict[str, int] | None = None
) -> DataFrame:
    """Rows beyond the first of each key, NULLs per required column, and texts over their length, in one scan.

    Bad values are counted while the rows are grouped by key, so only keys and
    counts are shuffled, combined within each task.
    """
    bad = {f"{table}: {c} not null": F.col(c).isNull() for c in required}
    bad |= {f"{table}: {c} at most {n} characters": F.length(c) > n for c, n in (lengths or {}).items()}
    names = [f"{table}: unique {', '.join(key)}", *bad]
    counts = [F.count(F.lit(1)) - 1, *map(F.count_if, bad.values())]
    per_key = df.groupBy(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(key)))
    per_key = per_key.agg(*(n.alias(f"_{i}") for i, n in enumerate(counts)))
    sums = per_key.agg(*(F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(names))))
    return _as_rows(sums, names)


def check_keys(tables: dict[str, tuple]) -> DataFrame:
    """``check_name, violations`` for tables given as the arguments of ``check_table`` after the name."""
    return union_all(*(check_table(df, name, *rest) for name, (df, *rest) in tables.items()))


def check_load_counts(tables: dict[str, tuple[DataFrame, DataFrame, T.StructType]]) -> DataFrame:
    """Rows that were to be loaded against rows stored, per warehouse table.

    Each table comes as the rows expected of it, intended deletions taken off,
    as the stored table read back, and as the columns it should have. A missing,
    surplus or differently typed column is a violation, as is each missing or
    surplus row.
    """

    def count(df: DataFrame, table: str, side: str, columns: int) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("_rows")).select(
            F.lit(table).alias("table_name"), F.lit(side).alias("_side"), "_rows", F.lit(columns).alias("_columns")
        )

    counts = union_all(
        *(
            count(df, table, side, column_differences(stored.schema, schema))
            for table, (expected, stored, schema) in tables.items()
            for side, df in (("staged", expected), ("loaded", stored))
        )
    )
    of = lambda side: F.sum(F.when(F.col("_side") == side, F.col("_rows")))
    return counts.groupBy("table_name").agg(
        of("staged").alias("staged_rows"),
        of("loaded").alias("loaded_rows"),
        (F.abs(of("staged") - of("loaded")) + F.max("_columns")).alias("violations"),
    )


def column_differences(stored: T.StructType, expected: T.StructType) -> int:
    """Columns that only one side has, or that have another type on the other."""
    a, b = ({f.name.lower(): f.dataType.simpleString() for f in s.fields} for s in (stored, expected))
    return len(dict(a.items() ^ b.items()))


ALL_COLUMNS = "*"
_PIECE = 21  # bits of a hash that are added up at a time: 2^42 rows then fit a BIGINT


def _checksums(df: DataFrame, columns: list[str], key: tuple[str, ...]) -> DataFrame:
    """(column_name, rows, high, low, mixed) per column and for whole rows, in one scan without a shuffle of rows.

    The hash of a value together with its row's key is added up and XORed, so the order of rows does not matter, a
    repeated row counts as often as it is there, and two values that changed rows do not cancel out.
    """
    per_row = {c: F.xxhash64(*[F.col(f"`{k}`") for k in key], F.isnull(f"`{c}`"), F.col(f"`{c}`")) for c in columns}
    per_row[ALL_COLUMNS] = F.xxhash64(*[F.col(f"`{c}`") for c in columns], *[F.isnull(f"`{c}`") for c in columns])
    hashed = df.select(*[h.alias(f"h{i}") for i, h in enumerate(per_row.values())])

    def sums(i: int):
        h = F.col(f"h{i}")
        none = F.lit(0).cast("bigint")
        return [
            F.coalesce(F.sum(F.shiftright(h, 64 - _PIECE)), none).alias(f"high{i}"),
            F.coalesce(F.sum(h.bitwiseAND((1 << _PIECE) - 1)), none).alias(f"low{i}"),
            F.coalesce(F.bit_xor(h), none).alias(f"mixed{i}"),
        ]

    totals = hashed.agg(F.count(F.lit(1)).alias("rows"), *[s for i in range(len(per_row)) for s in sums(i)])
    each = [
        F.struct(F.lit(c).alias("column_name"), "rows", F.col(f"high{i}").alias("high"), F.col(f"low{i}").alias("low"), F.col(f"mixed{i}").alias("mixed"))
        for i, c in enumerate(per_row)
    ]
    return totals.select(F.inline(F.array(*each)))


def check_contents(tables: dict[str, tuple[DataFrame, DataFrame, tuple[str, ...]]]) -> DataFrame:
    """``table_name, column_name, staged_rows, loaded_rows, violations`` per table and column, and per table for whole rows (``*``).

    Each table comes as the rows expected of it, the stored table read back, and its key (or none). A violation is a missing
    or surplus row, or else 1 where the values differ; a column that only one side has, or has in another type, differs too.
    Only one row per column leaves each scan.
    """
    sides = []
    for table, (expected, stored, key) in tables.items():
        of_expected, of_stored = ({f.name.lower(): f.dataType.simpleString() for f in d.schema.fields} for d in (expected, stored))
        both = [c for c, t in of_expected.items() if of_stored.get(c) == t]
        own_key = tuple(k for k in key if k.lower() in both)
        for side, df, types in (("staged", expected, of_expected), ("loaded", stored, of_stored)):
            sums = _checksums(df, both, own_key)
            sides.append(sums.select(F.lit(table).alias("table_name"), F.lit(side).alias("_side"), "*"))
            alone = [c for c in types if c not in both]
            if alone:
                rows = df.agg(F.count(F.lit(1)).alias("rows"))
                row = [F.lit(table).alias("table_name"), F.lit(side).alias("_side"), F.explode(F.array(*map(F.lit, alone))).alias("column_name"), "rows"]
                odd = F.lit(0 if side == "staged" else 1).cast("bigint")  # so that two types of one name differ as well
                sides.append(rows.select(*row, *[odd.alias(n) for n in ("high", "low", "mixed")]))
    of = lambda side, name: F.max(F.when(F.col("_side") == side, F.col(name)))
    rows = [F.coalesce(of(side, "rows"), F.lit(0).cast("bigint")) for side in ("staged", "loaded")]
    differ = ~F.lit(True)
    for name in ("high", "low", "mixed"):
        differ = differ | ~of("staged", name).eqNullSafe(of("loaded", name))
    return union_all(*sides).groupBy("table_name", "column_name").agg(
        rows[0].alias("staged_rows"),
        rows[1].alias("loaded_rows"),
        F.greatest(F.abs(rows[0] - rows[1]), differ.cast("bigint")).alias("violations"),
    )
