"""Whole-table reads; Catalyst pushes filters and columns into them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table by path; a known ``schema`` saves reading a file footer."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


class StagingTables:
    """The staging tables wherever they lie; ``read`` turns a table name into its rows.

    For example ``StagingTables(spark, lambda name: spark.table(f"stg.{name}"))``,
    or the same with ``read_jdbc``. ``rates`` has ``rate_date, usd_pln, ils_pln``.
    """

    def __init__(self, spark: SparkSession, read: Callable[[str], DataFrame]):
        self.spark = spark
        self.read = read

    def track(self, keys: tuple[str, ...] = ("genreid", "albumid")) -> DataFrame:
        return self.read("track")

    def genre(self) -> DataFrame:
        return self.read("genre")

    def mediatype(self) -> DataFrame:
        return self.read("mediatype")

    def album(self) -> DataFrame:
        return self.read("album")

    def artist(self) -> DataFrame:
        return self.read("artist")

    def playlist(self) -> DataFrame:
        return self.read("playlist")

    def playlisttrack(self) -> DataFrame:
        return self.read("playlisttrack")

    def customer(self) -> DataFrame:
        return self.read("customer")

    def employee(self) -> DataFrame:
        return self.read("employee")

    def department(self) -> DataFrame:
        return self.read("department")

    def invoice(self) -> DataFrame:
        return self.read("invoice")

    def invoiceline(self) -> DataFrame:
        return self.read("invoiceline")

    def rates(self) -> DataFrame:
        return self.read("rates")


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read, split into ranges of a numeric ``key`` if one is given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value:
            options[name] = value
    if key:
        if not bounds or not partitions:
            raise ValueError("a split read needs key, bounds and partitions")
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, one_task: bool = False, **split: object) -> DataFrame:
    """A database table, read in ranges of ``key``. Credentials come from the caller, never from this library.

    A table without a numeric key comes over one connection into one task, which has to be asked for.
    """
    if not one_task and not split.get("key"):
        raise ValueError("give key, bounds and partitions to split the read, or one_task=True for a small table")
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()
