"""Table sinks: create if absent, full refresh, insert by name, drop rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    """Create an external Parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")


def clone_table(spark: SparkSession, name: str, like: str, location: str, extra: T.StructType | None = None) -> None:
    """A new table with the columns of ``like`` plus ``extra``."""
    schema = spark.table(like).schema
    ensure_table(spark, name, T.StructType(list(schema.fields) + (list(extra.fields) if extra else [])), location)


def same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Equal names (in any case) and types, in order; whether a column may be NULL is not compared."""
    return [(f.name.lower(), f.dataType.simpleString()) for f in a] == [(f.name.lower(), f.dataType.simpleString()) for f in b]


def refresh_table(df: DataFrame, name: str, root: str) -> DataFrame:
    """Replace all rows of ``name``.

    The rows go to a new folder first and the table is then pointed at it, so
    readers see the old rows or the new ones, never an empty table, and ``df``
    may read the table it replaces. A table of other columns is defined anew, so
    that none is lost; only then is it gone for a moment. The load before stays
    for readers that are still at it, older ones are removed.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{name.replace('.', '/')}"
    location = f"{folder}/load-{uuid.uuid4().hex}"
    df.write.parquet(location)
    if spark.catalog.tableExists(name) and not same_columns(spark.table(name).schema, df.schema):
        spark.sql(f"DROP TABLE {name}")
    before = _location(spark, name) if spark.catalog.tableExists(name) else None
    ensure_table(spark, name, df.schema, location)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    _remove_loads(spark, folder, keep={location, before})
    return spark.table(name)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _remove_loads(spark: SparkSession, folder: str, keep: set[str | None]) -> None:
    """Delete the load folders of a table but for some."""
    kept = {path.rsplit("/", 1)[-1] for path in keep if path}
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("load-") and name not in kept:
            files.delete(status.getPath(), True)


def jdbc_refresh_options(
    url: str, table: str, user: str | None = None, password: str | None = None, connections: int = 16, batch: int = 10_000
) -> dict[str, str]:
    """Options of a full refresh that empties the database table rather than dropping it."""
    options = {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "numPartitions": str(connections),
        "batchsize": str(batch),
    }
    return options | {k: v for k, v in (("user", user), ("password", password)) if v}


def refresh_jdbc(df: DataFrame, url: str, table: str, **more: object) -> None:
    """Replace all rows of a database table over at most ``connections`` connections."""
    df.write.format("jdbc").options(**jdbc_refresh_options(url, table, **more)).mode("overwrite").save()


def insert_by_name(df: DataFrame, name: str) -> None:
    """Append rows matching columns by name; columns that ``df`` lacks become NULL."""
    view = f"_rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows a DELETE leaves: those where ``condition`` is false or unknown."""
    return df.filter(F.coalesce(~condition, F.lit(True)))


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, location: str) -> DataFrame:
    """Write a table bucketed and sorted on ``key``; two such tables join without a shuffle.

    One task writes a bucket, and one task joins it later: not for a key of which
    single values hold a large part of the rows. The rows are written under
    another name, which then takes the table's place.
    """
    spark, fresh = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    bucketed = df.repartition(buckets, key).write.option("path", location).bucketBy(buckets, key).sortBy(key)
    bucketed.saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)
