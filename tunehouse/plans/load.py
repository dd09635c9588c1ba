"""Load the whole warehouse into tables, and read it back from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunehouse.plans.checks import check_contents, check_load_counts
from tunehouse.plans.warehouse import REPEATED_PLAYLISTS, Warehouse
from tunehouse.schemas import (
    CUSTOMER_EXTRA,
    DIM_PLAYLIST,
    DIM_TRACK,
    EMPLOYEE_EXTRA,
    FACT_INVOICE,
    FACT_INVOICELINE,
    clone_schema,
)
from tunehouse.sinks.tables import delete_where, refresh_table, save_bucketed

SORT_KEYS = {"fact_invoice": "invoicedate", "fact_invoiceline": "last_update"}
ROW_KEYS = {
    "dim_playlist": ("playlist_id", "track_id"),
    "dim_customer": ("customerid",),
    "dim_employee": ("employeeid",),
    "dim_track": ("trackid",),
    "dim_currencies": (),
    "fact_invoice": ("invoiceid",),
    "fact_invoiceline": ("invoiceline_id",),
}
BUCKET_KEYS = {"fact_invoice": "invoiceid", "fact_invoiceline": "invoice_id"}


def table_builds(wh: Warehouse) -> dict[str, Callable[[], DataFrame]]:
    """What builds each stored table."""
    return {
        "dim_playlist": wh.playlist,
        "dim_customer": wh.customer,
        "dim_employee": wh.employee,
        "dim_track": wh.track,
        "dim_currencies": wh.currencies,
        "fact_invoice": wh.invoice,
        "fact_invoiceline": wh.invoiceline,
    }


def load_warehouse(wh: Warehouse, database: str, root: str, buckets: int | None = None) -> None:
    """Full refresh of all dimensions and facts as tables of ``database`` below ``root``.

    With ``buckets`` the facts are bucketed by invoice, so that every later join
    of lines to their invoices needs no shuffle. Only a shuffled join can split
    the lines of one invoice among tasks, and one task writes a bucket: take it
    only where single invoices are small and a bucket fits a task.
    """
    spark = wh.staging.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/{database}'")
    builds = table_builds(wh)

    def load(name: str) -> None:
        table = f"{database}.{name}"
        if buckets and name in BUCKET_KEYS:
            location = f"{root.rstrip('/')}/{database}/{name}/load-{uuid.uuid4().hex}"
            save_bucketed(builds[name](), table, BUCKET_KEYS[name], buckets, location)
        else:
            rows = builds[name]()
            if name in SORT_KEYS:  # within each file, without a shuffle: a year's report then skips row groups
                rows = rows.sortWithinPartitions(SORT_KEYS[name])
            refresh_table(rows, table, root)

    # the tables do not depend on each other, so small ones fill the gaps that large ones leave on the cluster
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(load, builds))


class LoadedWarehouse:
    """The same frames as ``Warehouse``, read from loaded tables.

    ``source`` is the warehouse they were loaded from; it is asked only for what
    is not stored: the staging tables, and playlists that the load leaves out.
    """

    def __init__(self, spark: SparkSession, database: str, source: Warehouse | None = None):
        self.spark = spark
        self.database = database
        self.source = source

    @property
    def staging(self):
        if self.source is None:
            raise ValueError("the staging tables are not stored; give the warehouse they come from as source")
        return self.source.staging

    def _table(self, name: str, columns: tuple[str, ...]) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}").select(*(columns or "*"))

    def playlist(self, *columns: str, drop_ids: tuple[int, ...] = REPEATED_PLAYLISTS) -> DataFrame:
        if not set(REPEATED_PLAYLISTS) <= set(drop_ids):
            if self.source is None:
                raise ValueError("the repeated playlists are not stored; give the warehouse they come from as source")
            return self.source.playlist(*columns, drop_ids=drop_ids)
        rows = self._table("dim_playlist", ())
        return delete_where(rows, F.col("playlist_id").isin(*drop_ids)).select(*(columns or "*"))

    def customer(self, *columns: str) -> DataFrame:
        return self._table("dim_customer", columns)

    def employee(self, *columns: str) -> DataFrame:
        return self._table("dim_employee", columns)

    def track(self, *columns: str) -> DataFrame:
        return self._table("dim_track", columns)

    def invoice(self, *columns: str) -> DataFrame:
        return self._table("fact_invoice", columns)

    def invoiceline(self, *columns: str) -> DataFrame:
        return self._table("fact_invoiceline", columns)

    def currencies(self, *columns: str) -> DataFrame:
        return self._table("dim_currencies", columns)


def check_loaded(loaded: LoadedWarehouse) -> DataFrame:
    """The stored tables against the staging tables they come from: rows and columns."""
    s, built = loaded.staging, loaded.source
    kept = delete_where(s.playlisttrack(), F.col("playlistid").isin(*REPEATED_PLAYLISTS))
    return check_load_counts(
        {
            "dim_playlist": (kept, loaded.playlist(), DIM_PLAYLIST),
            "dim_customer": (s.customer(), loaded.customer(), clone_schema(s.customer().schema, CUSTOMER_EXTRA)),
            "dim_employee": (s.employee(), loaded.employee(), clone_schema(s.employee().schema, EMPLOYEE_EXTRA)),
            "dim_track": (s.track(()), loaded.track(), DIM_TRACK),
            "dim_currencies": (s.invoice(), loaded.currencies(), built.currencies().schema),
            "fact_invoice": (s.invoice(), loaded.invoice(), FACT_INVOICE),
            "fact_invoiceline": (s.invoiceline(), loaded.invoiceline(), FACT_INVOICELINE),
        }
    )


def check_loaded_contents(loaded: LoadedWarehouse) -> DataFrame:
    """The stored tables against the rows built anew: every column, and whole rows, whatever their order."""
    tables = {}
    for name, build in table_builds(loaded.source).items():
        tables[name] = (build(), loaded._table(name, ()), ROW_KEYS[name])
    return check_contents(tables)
