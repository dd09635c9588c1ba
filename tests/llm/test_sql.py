"""Each query with SQL against that SQL; all queries keep one row per input row where they promise it."""

import pytest

import __spark_entry__ as entry
from compare import oracle_rows, spark_rows
from tunehouse.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, small, name):
    assert spark_rows(QUERIES[name](spark, small)) == oracle_rows(con, ORACLES[name])


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


NATIVE = ["op1_licenses", "op5_mixing", "op7_pii_surrogates"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan
