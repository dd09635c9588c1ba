"""All queries again on data where single keys hold a third of the rows and more."""

import os

import duckdb
import pytest

from compare import TABLES, connect, oracle_rows, spark_rows
from oracles.sql import ORACLES
from tunehouse.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"

# one customer and one day for a third of the orders; one order, part and supplier for a third of the lines
HOT = {
    "orders": """* replace (case when hash(o_orderkey) % 3 = 0 then 8 else o_custkey end as o_custkey,
                             case when hash(o_orderkey + 1) % 3 = 0 then timestamp '1997-03-05' else o_orderdate end as o_orderdate)""",
    "lineitem": """* replace (case when hash(l_partkey, l_orderkey, l_shipdate) % 3 = 0 then 5 else l_orderkey end as l_orderkey,
                               case when hash(l_orderkey, l_shipdate, l_partkey) % 3 = 1 then 24 else l_partkey end as l_partkey,
                               case when hash(l_orderkey) % 3 = 0 then 4 else l_suppkey end as l_suppkey)""",
    "part": """* replace (case when p_partkey % 2 = 0 then 'PROMO' else p_type end as p_type,
                           case when p_partkey % 2 = 0 then 7 else p_size end as p_size)""",
    "customer": "* replace (case when c_custkey % 2 = 0 then 3 else c_nationkey end as c_nationkey)",
}


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    for name in TABLES:
        source, target = os.path.join(SMALL, f"{name}.parquet"), os.path.join(folder, f"{name}.parquet")
        duckdb.execute(f"copy (select {HOT.get(name, '*')} from '{source}') to '{target}' (format parquet)")
    return folder


@pytest.fixture(scope="module")
def con(hot_dir):
    return connect(hot_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle_on_hot_keys(spark, con, hot_dir, name):
    assert spark_rows(QUERIES[name](spark, hot_dir)) == oracle_rows(con, ORACLES[name])
