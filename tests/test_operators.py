"""Operators against brute force, also with one key that holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tunehouse.operators import joins, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows and more in one group."""
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.6 else rng.choice("abc"), k, rng.randint(1, 4)) for k in rng.sample(range(10_000), 3000)]
    return data, spark.createDataFrame(data, "g string, k bigint, n bigint").repartition(5)


def test_global_position(skewed):
    data, df = skewed
    got = ranking.with_global_position(df, "g", "k", name="at")
    expect = {(g, k): i for i, (g, k, _) in enumerate(sorted(data))}
    assert {(r.g, r.k): r["at"] for r in got.collect()} == expect


def test_global_position_of_nothing(spark):
    assert ranking.with_global_position(spark.range(0), "id").count() == 0


@pytest.mark.parametrize("step", [1, 7, 350, 5000])
@pytest.mark.parametrize("chunk", [3, 100_000])
def test_stride_of_counts_equals_sorting_all_rows(skewed, step, chunk):
    data, df = skewed
    counts = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    got = ranking.stride_of_counts(counts, "g", "n", step, chunk)
    assert [r.g for r in got.orderBy("position").collect()] == sorted(g for g, _, _ in data)[::step]


@pytest.mark.parametrize("block", [1, 64, 65_536])
@pytest.mark.parametrize("lead", [None, "n"])
def test_position_in_group(skewed, block, lead):
    data, df = skewed
    got = ranking.position_in_group(df, ["g"], "k", "at", lead, block)
    groups = {}
    for g, k, n in sorted(data, key=lambda r: (r[0], -r[2] if lead else 0, r[1])):
        groups.setdefault(g, []).append(k)
    expect = {(g, k): i for g, keys in groups.items() for i, k in enumerate(keys, 1)}
    assert {(r.g, r.k): r["at"] for r in got.collect()} == expect


def test_position_in_group_spreads_a_group(spark):
    """Even below a join that partitions by the whole group."""
    df = spark.range(1000).select(F.when(F.col("id") >= 0, "hot").otherwise("cold").alias("g"), F.col("id").alias("k"))
    joined = df.hint("merge").join(spark.createDataFrame([("hot",)], "g string"), "g")
    got = ranking.position_in_group(joined, ["g"], "k", "at", block=10)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "ReusedExchange" in plan


def test_head_rest_split(skewed):
    data, df = skewed
    head, rest = ranking.head_rest_split(df, 25, "n", "k")
    ordered = sorted(data, key=lambda r: (r[2], r[1]))
    assert rows(head) == sorted(ordered[:25], key=repr)
    assert rows(rest) == sorted(ordered[25:], key=repr)


def test_head_rest_split_by_a_key_moves_only_the_head(spark, skewed):
    data, df = skewed
    for n in (0, 1, 25, len(data) + 1):
        head, rest = ranking.head_rest_split(df, n, "n", key="k")
        ordered = sorted(data, key=lambda r: (r[2], r[1]))
        assert rows(head) == sorted(ordered[:n], key=repr) and rows(rest) == sorted(ordered[n:], key=repr)
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "numbered-rows" not in plan


def test_top_k_breaks_ties_by_key_whatever_the_row_order(spark):
    data = [(c, 1) for c in "hgfedcba"]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "g string, n int").repartition(4)
        assert [r.g for r in ranking.top_k(df, 3, F.desc("n"), F.asc("g")).collect()] == ["a", "b", "c"]


def test_group_best_keeps_ties_and_group_top_n_does_not(spark):
    df = spark.createDataFrame([("x", "a", 2), ("x", "b", 2), ("x", "c", 1), ("y", None, 0)], "p string, g string, n int")
    assert rows(ranking.group_best(df, ["p"], F.desc("n"))) == [("x", "a", 2), ("x", "b", 2), ("y", None, 0)]
    assert rows(ranking.group_top_n(df, 1, ["p"], F.desc("n"), F.asc("g"))) == [("x", "a", 2), ("y", None, 0)]


def test_rank_filter_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("p"), F.col("id").alias("n"))
    plan = ranking.group_top_n(df, 2, ["p"], F.desc("n"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_semi_and_anti_with_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    other = spark.createDataFrame([(1,), (1,), (None,)], "o int")
    assert rows(joins.semi_join(df, other, {"k": "o"})) == [(1, "a")]
    assert rows(joins.anti_join(df, other, {"k": "o"})) == [(2, "b"), (None, "c")]


def test_flag_is_zero_when_the_list_holds_null(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 1)], "id int, boss int")
    assert rows(joins.flag_member(df, df, {"id": "boss"}, "is_manager").select("id", "is_manager")) == [(1, 1), (2, 0), (3, 0)]


def test_update_from_keeps_unmatched_rows_and_never_multiplies(spark):
    target = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (None, 30, "c"), (3, 40, "d")], "id int, price int, name string")
    source = spark.createDataFrame([(1, 99), (1, 50), (3, None), (7, 1), (None, 5)], "key int, price int")
    got = joins.update_from(target, source, {"id": "key"}, ["price"])
    assert got.columns == ["id", "price", "name"]
    assert rows(got) == sorted([(1, 99, "a"), (2, 20, "b"), (None, 30, "c"), (3, None, "d")], key=repr)


def test_broadcast_only_within_a_bound(spark):
    def plan(bound):
        small = joins.broadcast_within(spark.range(50), bound, rows=50)
        return spark.range(1000).join(small, "id")._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(50) and "strategy=broadcast" not in plan(51)


def test_head_and_rest_hold_every_row_once(spark):
    """Rows with NULL keys and repeated rows are in one of the two parts, as often as in the table."""
    data = [(None, 1), (None, 1), (1, 1), (1, 1), (1, 1), (2, None), (2, 2), (None, 9)]
    df = spark.createDataFrame(data, "k int, n int").repartition(3)
    for n in range(len(data) + 2):
        head, rest = ranking.head_rest_split(df, n, "n", "k")
        assert head.count() == min(n, len(data))
        assert sorted(map(tuple, head.collect() + rest.collect()), key=repr) == sorted(data, key=repr)
