"""Sales reports kept up to date from new files alone: daily states that add up, and a ledger of the files counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.operators.bitmaps import bitmap_states, distinct_counts, merged, with_new_numbers
from tunehouse.plans.customers import _sums, millionths, monthly_sales
from tunehouse.session import land
from tunehouse.sinks.manifests import announce, claim, loads, manifest, read_entry

#: What a source file holds of an invoice; more columns may be there.
COLUMNS = ("customerid", "invoicedate", "total", "usd_price", "ils_price", "billingcountry")

#: Rows that one task adds up at most before the shuffle: its states are nearly as many where customers come seldom.
ROWS_PER_TASK = 1 << 19


def in_short_tasks(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` dealt out evenly to tasks of about ``most`` rows, unless no task of the scan reads more.

    A row group of a file is read by one task, however many rows it holds, and a split holds more of them as the files
    grow. The rows are counted from the files' footers. They are dealt by their place, so a frequent key or repeated
    rows are spread as well.
    """
    per_task = rows.groupBy(F.spark_partition_id().alias("_task")).count()
    longest, total = per_task.agg(F.max("count"), F.sum("count")).first()
    if not total or longest <= most:
        return rows
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    return placed.repartition(-(-total // most), "_place").drop("_place")


class SalesStates:
    """States below ``root``: per day, per day and customer, per day and country, each added to by every load.

    All come from one manifest, so a reader sees every table after the same load. One writer at a time: of two that
    start from the same load the second one fails and changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _entries(self) -> dict[str, dict]:
        return manifest(self.spark, self.root)["tables"] if loads(self.spark, self.root) else {}

    def _table(self, name: str) -> DataFrame:
        return read_entry(self.spark, self._entries()[name])

    def add(self, folder: str) -> int:
        """Count the Parquet files of ``folder`` that no load has counted yet; gives how many there were.

        A file is known by path, length and time of change; one that has changed since it was counted fails the load, as
        its old rows cannot be taken back. Only the names of new files come to the driver. Only new files are read.
        """
        spark, before = self.spark, self._entries()
        if before and read_entry(spark, before["country_days"]).schema["bitmap"].dataType != T.LongType():
            raise ValueError(f"{self.root} holds the longer bitmaps of earlier versions; build the states anew")
        based_on = (loads(spark, self.root) or [0])[-1]
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        found = land(listing.load(folder).select("path", "length", "modificationTime"), "source-files")
        fresh = found
        if before:
            ledger = read_entry(spark, before["files"])
            changed = found.join(ledger.select("path", F.col("length").alias("l"), F.col("modificationTime").alias("m")), "path")
            changed = changed.where("l != length or m != modificationTime").select("path").first()
            if changed:
                raise ValueError(f"{changed['path']} has changed since it was counted")
            fresh = found.join(ledger, "path", "left_anti")
        fresh = land(fresh, "new-files")
        paths = sorted(r["path"] for r in fresh.select("path").toLocalIterator())
        if not paths:
            return 0
        rows = spark.read.parquet(*paths).select(*COLUMNS).withColumn("day", F.col("invoicedate").cast("date"))
        spread = in_short_tasks(rows, ROWS_PER_TASK)
        numbers = read_entry(spark, before["customers"]) if before else None
        new_numbers = land(with_new_numbers(numbers, spread.select("customerid")), "customer-numbers")
        every = new_numbers if numbers is None else numbers.unionByName(new_numbers)
        numbered = spread.join(every, spread["customerid"] == every["key"], "left")
        money = [F.sum(millionths(F.col(c))).alias(c) for c in ("usd_price", "ils_price")]
        states = {
            "files": fresh,
            "customers": new_numbers,
            # few days, so few sums in a task of any length
            "days": rows.groupBy("day").agg(F.sum("total").cast("decimal(38,2)").alias("total"), F.count(F.lit(1)).alias("invoices"), *money),
            "customer_days": spread.where("customerid is not null and day is not null").groupBy("day", "customerid").agg(F.count(F.lit(1)).alias("invoices")),
            "country_days": bitmap_states(numbered, ["day", "billingcountry"]),
        }
        number = claim(spark, self.root)
        tables = {}
        for name, state in states.items():
            path = f"{self.root}/{name}/load-{number:012d}"
            state.write.parquet(path)
            entry = before.get(name, {"paths": [], "schema": state.schema.jsonValue()})
            tables[name] = {**entry, "paths": [*entry["paths"], path]}
        announce(spark, self.root, number, tables, based_on)
        return len(paths)

    def compact(self) -> None:
        """All loads of a state as one, added up; the reports do not change, the ledger stays as it is."""
        spark, before = self.spark, self._entries()
        based_on = loads(spark, self.root)[-1]
        add_up = {"days": ["day"], "customer_days": ["day", "customerid"]}
        number, tables = claim(spark, self.root), dict(before)
        for name, entry in before.items():
            state = read_entry(spark, entry)
            if name in add_up:
                sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in state.schema.fields if f.name not in add_up[name]]
                state = state.groupBy(*add_up[name]).agg(*sums)
            elif name == "country_days":
                state = merged(state, ["day", "billingcountry"])
            path = f"{self.root}/{name}/load-{number:012d}"
            state.write.parquet(path)
            tables[name] = {**entry, "paths": [path]}
        announce(spark, self.root, number, tables, based_on)

    # ---- reports, from the states alone

    def monthly_sales(self) -> DataFrame:
        """As ``customers.monthly_sales`` over all invoices."""
        return monthly_sales(self._table("days").select(F.col("day").alias("invoicedate"), "total"))

    def customer_totals(self) -> DataFrame:
        """As ``customers.customer_totals``: k invoices of a customer on a day count all currency rows of that day k times."""
        days = self._table("days").where("day is not null").groupBy("day").agg(F.sum("usd_price").alias("_usd"), F.sum("ils_price").alias("_ils"))
        visits = self._table("customer_days")
        # a row per calendar day
        joined = visits.join(F.broadcast(days), "day")
        return joined.groupBy("customerid").agg(*_sums(*[F.col(c) * F.col("invoices") for c in ("_usd", "_ils")]))

    def customers_per_country(self) -> DataFrame:
        """Distinct customers per billing country over all days."""
        return distinct_counts(self._table("country_days"), ["billingcountry"], "customers")

    def customers_per_month(self) -> DataFrame:
        """Distinct customers per year and month."""
        by_month = self._table("country_days").where("day is not null").select(F.year("day").alias("year"), F.month("day").alias("month"), "bucket", "bitmap")
        return distinct_counts(by_month, ["year", "month"], "customers")

