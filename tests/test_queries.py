"""Every named query against its SQL oracle, and properties of the plans."""

import pytest

import __spark_entry__ as entry
from compare import connect, oracle_rows, spark_rows
from oracles import sql
from tunehouse import catalog

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, sql.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) == 53
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle_and_joins_on_keys(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    assert spark_rows(df) == oracle_rows(con, ORACLES[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "rank_by_presentege", "genre_name", "presentege_from_total_country_rev"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["an_country_genre_share", "an_manager_share", "an_playlist_breakdown", "an_top_artists_by_albums"])
def test_same_result_without_broadcast(spark, con, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert spark_rows(QUERIES[name](spark, SMALL)) == oracle_rows(con, ORACLES[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_tiers_add_up_to_all_tracks(spark):
    tiers = QUERIES["an_track_sales_buckets"](spark, SMALL).collect()
    assert sum(r["total_tracks_per_quartr"] for r in tiers) == spark.read.parquet(f"{SMALL}/part.parquet").count()


def test_scan_reads_needed_columns_only(spark):
    plan = QUERIES["an_country_tiers"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


def test_revenue_is_aggregated_once_for_both_tiers(spark):
    df = QUERIES["an_country_tiers"](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
