"""Expressions against Python on many random values, and queries on rows in another order."""

import datetime
import os
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import TABLES, connect, oracle_rows, spark_rows
from tunehouse.functions import dates, numbers, text

SMALL = "/root/testdata/sf0.001"
RNG = random.Random(20)


def evaluate(spark, ddl, data, column):
    rows = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], f"i int, {ddl}").select("i", column.alias("v"))
    return [r.v for r in sorted(rows.collect(), key=lambda r: r.i)]


def test_percentages_round_half_up(spark):
    data = [(Decimal(RNG.randint(-10**6, 10**6)) / 100, Decimal(RNG.randint(1, 10**4)) / 100) for _ in range(3000)]
    data += [(Decimal(n) / 100, Decimal("4.00")) for n in range(-50, 50)]  # many of these are halves of a hundredth
    got = evaluate(spark, "a decimal(20,2), b decimal(20,2)", data, numbers.percent_text(numbers.percent_of(F.col("a"), F.col("b"))))

    def expected(a, b):
        rounded = (a * 100 / b).quantize(Decimal("0.01"), ROUND_HALF_UP)
        return f"{abs(rounded) if rounded == 0 else rounded}%"

    assert got == [expected(a, b) for a, b in data]


def test_completed_years(spark):
    as_of = datetime.date(2023, 2, 28)
    start = datetime.date(1996, 1, 1)
    data = [(start + datetime.timedelta(days=d),) for d in range(0, 9900, 3)]
    got = evaluate(spark, "d date", data, dates.completed_years(F.col("d"), as_of))
    assert got == [as_of.year - d.year - ((as_of.month, as_of.day) < (d.month, d.day)) for (d,) in data]


def test_durations(spark):
    data = [(RNG.randint(0, 9_000_000),) for _ in range(2000)]
    got = evaluate(spark, "ms int", data, text.minutes_seconds(F.col("ms")))
    assert got == [f"{ms // 60_000 % 100:02d}:{ms // 1000 % 60:02d}" for (ms,) in data]


def test_domains_and_names(spark):
    data = [("".join(RNG.choice("aB@. ") for _ in range(RNG.randint(0, 8))),) for _ in range(2000)]
    assert evaluate(spark, "s string", data, text.email_domain(F.col("s"))) == [s[max(s.find("@"), 0) :] for (s,) in data]
    assert evaluate(spark, "s string", data, text.capitalize_first(F.col("s"))) == [s[:1].upper() + s[1:].lower() for (s,) in data]


@pytest.fixture(scope="module")
def shuffled_dir(spark, tmp_path_factory):
    """The same tables as folders of several files, rows in random order."""
    folder = str(tmp_path_factory.mktemp("shuffled"))
    for name in TABLES:
        rows = spark.read.parquet(f"{SMALL}/{name}.parquet")
        rows.repartition(5, F.rand(3)).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "an_country_tiers",
        "an_customer_totals",
        "an_duration_ticks",
        "an_playlist_breakdown",
        "an_playlist_extremes",
        "an_recommendations",
        "an_top_artists_by_albums",
        "an_top_customers",
        "an_top_genres_by_tracks",
        "dim_track",
        "op_head_rest_split",
        "op_update_from",
        "src_json_columns",
    ],
)
def test_row_order_and_files_do_not_matter(spark, shuffled_dir, name):
    assert spark_rows(entry.queries()[name](spark, shuffled_dir)) == oracle_rows(connect(SMALL), entry.oracle_sql()[name])
