"""The warehouse loaded into tables gives the same answers."""

import datetime
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tunehouse import catalog
from tunehouse.plans.load import LoadedWarehouse, check_loaded, load_warehouse
from tunehouse.plans.warehouse import Warehouse
from tunehouse.sinks.tables import refresh_table
from tunehouse.sources.tables import StagingTables
from tunehouse.staging import Staging

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    wh = Warehouse(Staging(spark, SMALL), datetime.date(2024, 2, 28))
    root = str(tmp_path_factory.mktemp("dwh"))
    load_warehouse(wh, "dwh_test", root, buckets=4)
    load_warehouse(wh, "dwh_test", root, buckets=4)  # a full refresh, not an append
    yield LoadedWarehouse(spark, "dwh_test", wh)
    spark.sql("DROP DATABASE dwh_test CASCADE")


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if n.split("_")[0] in ("an", "dim", "fact", "chk")))
def test_same_answers_on_tables(spark, loaded, name):
    assert rows(catalog.comparable(getattr(catalog, name)(loaded))) == rows(catalog.QUERIES[name](spark, SMALL))


def test_row_counts(spark, loaded):
    assert loaded.invoiceline().count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert loaded.invoice().count() == spark.read.parquet(f"{SMALL}/orders.parquet").count()


def test_lines_meet_invoices_without_a_shuffle(loaded):
    lines = loaded.invoiceline("invoice_id", "track_id").withColumnRenamed("invoice_id", "invoiceid")
    joined = lines.hint("merge").join(loaded.invoice("invoiceid", "customerid"), "invoiceid")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_warehouse_over_staging_tables(spark, tmp_path):
    """Staging tables stored by name give the same warehouse as the ones derived on the fly."""
    derived = Staging(spark, SMALL)
    stored = StagingTables(spark, lambda name: spark.read.parquet(str(tmp_path / name)))
    for name in (n for n in vars(StagingTables) if not n.startswith("_")):
        getattr(derived, name)().write.parquet(str(tmp_path / name))
    as_of = datetime.date(2024, 2, 28)
    for table in ("track", "playlist", "customer", "employee", "invoice", "invoiceline", "currencies"):
        assert rows(getattr(Warehouse(stored, as_of), table)()) == rows(getattr(Warehouse(derived, as_of), table)())


def test_what_is_not_stored_needs_the_source(spark, loaded):
    alone = LoadedWarehouse(spark, "dwh_test")
    assert rows(alone.playlist("playlist_id").distinct()) == rows(loaded.source.playlist("playlist_id").distinct())
    assert 1 not in {r[0] for r in rows(alone.playlist(drop_ids=(1, 8, 10)).select("playlist_id"))}
    with pytest.raises(ValueError):
        alone.playlist(drop_ids=())
    with pytest.raises(ValueError):
        alone.staging.track()


def test_staging_follows_its_files(spark, tmp_path):
    """Look-ups are derived anew once a table's files are replaced."""
    for name in ("part", "lineitem", "orders", "customer", "nation", "region", "supplier"):
        shutil.copyfile(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    query = catalog.QUERIES["an_top_genres_by_tracks"]
    before = rows(query(spark, str(tmp_path)))
    part = spark.read.parquet(f"{SMALL}/part.parquet")
    part.withColumn("p_type", F.concat(F.lit("NEW "), "p_type")).toPandas().to_parquet(tmp_path / "part.parquet")
    spark.catalog.refreshByPath(str(tmp_path))
    after = rows(query(spark, str(tmp_path)))
    assert len(after) == len(before) and all(r[0].startswith("NEW ") for r in after)


def test_albums_are_joined_only_where_wanted(spark):
    wh = Warehouse(Staging(spark, SMALL), datetime.date(2024, 2, 28))
    plan = wh.track("trackid", "genre_name")._jdf.queryExecution().optimizedPlan().toString()
    assert "albumid" not in plan and "genreid" in plan
    assert "albumid" in wh.track("trackid", "album_name")._jdf.queryExecution().optimizedPlan().toString()


def test_facts_are_stored_by_date_and_columns_are_checked(spark, tmp_path):
    wh = Warehouse(Staging(spark, SMALL), datetime.date(2024, 2, 28))
    load_warehouse(wh, "dwh_sorted", str(tmp_path))
    try:
        for file in (tmp_path / "dwh_sorted" / "fact_invoice").glob("load-*/part-*.parquet"):
            dates = pq.read_table(file, columns=["invoicedate"])["invoicedate"].to_pylist()
            assert dates == sorted(dates)
        loaded = LoadedWarehouse(spark, "dwh_sorted", wh)
        assert {r["violations"] for r in check_loaded(loaded).collect()} == {0}
        # a half-written and a wrongly defined table are both noticed
        refresh_table(spark.table("dwh_sorted.fact_invoice").limit(7), "dwh_sorted.fact_invoice", str(tmp_path))
        refresh_table(spark.table("dwh_sorted.dim_customer").drop("email"), "dwh_sorted.dim_customer", str(tmp_path))
        found = {r["table_name"]: r["violations"] for r in check_loaded(loaded).collect() if r["violations"]}
        assert found == {"fact_invoice": wh.invoice().count() - 7, "dim_customer": 1}
    finally:
        spark.sql("DROP DATABASE dwh_sorted CASCADE")
