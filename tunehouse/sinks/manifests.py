"""Loads of several tables that are announced by one manifest, written last.

A manifest names the folders and files of every table of a load. Readers resolve all tables through one of them, so they
see a load whole or not at all; a load that is never announced is never seen.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tunehouse.session import file_system

MANIFESTS = "_loads"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def loads(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published loads, ascending."""
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    files = file_system(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(_path(spark, folder))]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def manifest(spark: SparkSession, root: str, load: int | None = None) -> dict:
    """The manifest of a load, the newest by default: ``{"load": …, "tables": {name: {"paths": […], "schema": …}}}``."""
    known = loads(spark, root)
    if not known or load is not None and load not in known:
        raise FileNotFoundError(f"no {'load' if load is None else f'load {load}'} published in {root}")
    file = f"{root.rstrip('/')}/{MANIFESTS}/{known[-1] if load is None else load:012d}.json"
    return json.loads("".join(r["value"] for r in spark.read.text(file, wholetext=True).collect()))


def remove_folder(spark: SparkSession, folder: str) -> None:
    file_system(spark, folder).delete(_path(spark, folder), True)


def claim(spark: SparkSession, root: str) -> int:
    """A load number that no other writer has or gets."""
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    files = file_system(spark, folder)
    files.mkdirs(_path(spark, folder))
    taken = [status.getPath().getName() for status in files.listStatus(_path(spark, folder))]
    number = max([int(n.split(".")[0]) for n in taken if n[0].isdigit()], default=0) + 1
    while not files.createNewFile(_path(spark, f"{folder}/{number:012d}.claim")):  # fails where the file exists
        number += 1
    return number


def announce(spark: SparkSession, root: str, number: int, tables: dict[str, dict], based_on: int | None = None) -> None:
    """Write the manifest under another name and rename it, so that nobody reads half of it.

    A load that adds to load ``based_on`` (0 for none) fails if another one has come in between.
    """
    if based_on is not None and (loads(spark, root) or [0])[-1] != based_on:
        raise RuntimeError(f"another load than {based_on} is the newest of {root} by now")
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    files = file_system(spark, folder)
    hidden = _path(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = files.create(hidden)
    out.write(bytearray(json.dumps({"load": number, "tables": tables}, indent=1).encode()))
    out.close()
    if not files.rename(hidden, _path(spark, f"{folder}/{number:012d}.json")):
        raise OSError(f"load {number} could not be published in {root}")


def read_entry(spark: SparkSession, entry: dict) -> DataFrame:
    """A table of a manifest."""
    schema = T.StructType.fromJson(entry["schema"])
    if not entry["paths"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*entry["paths"])


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Take back all but the newest ``keep`` loads and remove the files that no other load names; gives their numbers.

    Readers of a load that goes fail from then on, so keep as many as the longest report outlives.
    """
    if keep < 1:
        raise ValueError("the newest load stays")
    known = loads(spark, root)
    old, kept = known[:-keep], known[-keep:]
    named = {p for n in kept for t in manifest(spark, root, n)["tables"].values() for p in t["paths"]}
    for number in old:
        tables = manifest(spark, root, number)["tables"]
        file = f"{root.rstrip('/')}/{MANIFESTS}/{number:012d}.json"
        file_system(spark, root).delete(_path(spark, file), False)
        for path in {p for t in tables.values() for p in t["paths"]} - named:
            # a folder of which a kept load still names some files loses only the others
            _remove_unnamed(spark, path, named)
    return old


def _remove_unnamed(spark: SparkSession, path: str, named: set[str]) -> None:
    files = file_system(spark, path)
    where = _path(spark, path)
    if not files.exists(where):
        return
    full = files.makeQualified(where).toString()
    inside = [p for p in named if _local(p).startswith(_local(full) + "/")]
    if not inside:
        files.delete(where, True)
        return
    for status in files.listStatus(where):
        if _local(status.getPath().toString()) not in {_local(p) for p in inside}:
            files.delete(status.getPath(), False)


def _local(path: str) -> str:
    """A path without the slashes in which its writers differ (file:/x, file:///x, /x)."""
    scheme, marked, rest = path.partition(":")
    return "/" + (rest if marked else scheme).lstrip("/")
