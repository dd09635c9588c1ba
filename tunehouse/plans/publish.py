"""Loads of the whole warehouse that appear all at once, and stay readable."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.plans.load import SORT_KEYS, LoadedWarehouse, table_builds
from tunehouse.plans.warehouse import Warehouse
from tunehouse.sinks.manifests import announce, claim, manifest, read_entry, remove_folder
from tunehouse.sinks.tables import delete_where


def publish(wh: Warehouse, root: str) -> int:
    """Build and write all tables of a new load, and then its manifest; gives the load's number.

    Readers resolve all tables through one manifest, so they see this load whole or not at all, whatever table
    fails; files of a failed load are removed. Loads before it stay until ``expire`` takes them.
    """
    spark = wh.staging.spark
    number = claim(spark, root)
    folders = {name: f"{root.rstrip('/')}/{name}/load-{number:012d}" for name in table_builds(wh)}

    def write(name: str) -> dict:
        rows = table_builds(wh)[name]()
        if name in SORT_KEYS:  # within each file, without a shuffle: a year's report then skips row groups
            rows = rows.sortWithinPartitions(SORT_KEYS[name])
        rows.write.parquet(folders[name])
        return {"paths": [folders[name]], "schema": rows.schema.jsonValue()}

    try:
        with ThreadPoolExecutor(max_workers=4) as pool:
            written = dict(zip(folders, pool.map(write, folders), strict=True))
    except BaseException:
        for folder in folders.values():
            remove_folder(spark, folder)
        raise
    announce(spark, root, number, written)
    return number


class PublishedWarehouse(LoadedWarehouse):
    """The tables of one published load, the newest one unless ``load`` says which; later loads do not change it."""

    def __init__(self, spark: SparkSession, root: str, load: int | None = None, source: Warehouse | None = None):
        super().__init__(spark, root, source)
        self.manifest = manifest(spark, root, load)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self._table(name, ()) for name in self.manifest["tables"]}

    def _table(self, name: str, columns: tuple[str, ...]) -> DataFrame:
        return read_entry(self.spark, self.manifest["tables"][name]).select(*(columns or "*"))


def delete_rows(spark: SparkSession, root: str, table: str, condition: Column) -> int:
    """Delete rows of a published table as a new load: only files with such a row are written anew.

    Files without one stay as they are, bytes and names, and belong to both loads; the other tables are those of the
    load before. The list of hit files is gathered on the driver, which lists the table's files anyway to read it. A
    row stays where ``condition`` is NULL.
    """
    before = manifest(spark, root)
    entry = before["tables"][table]
    schema = T.StructType.fromJson(entry["schema"])
    has = F.max(F.coalesce(condition, F.lit(False)))
    files = read_entry(spark, entry).groupBy(F.col("_metadata.file_path").alias("file")).agg(has.alias("hit"))
    found = {r["file"]: r["hit"] for r in files.toLocalIterator()}
    hit = sorted(f for f, is_hit in found.items() if is_hit)
    number = claim(spark, root)
    paths = sorted(f for f, is_hit in found.items() if not is_hit)
    if hit:
        folder = f"{root.rstrip('/')}/{table}/load-{number:012d}"
        delete_where(spark.read.schema(schema).parquet(*hit), condition).write.parquet(folder)
        paths.append(folder)
    announce(spark, root, number, {**before["tables"], table: {**entry, "paths": paths}})
    return number
