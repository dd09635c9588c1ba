"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
DEFAULTS = {
    **ADAPTIVE,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "tunehouse", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this library's defaults; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder. On a cluster a folder of the ``file:``
    file system brings a warning: it works only if it is mounted on all machines, which cannot be seen from here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        scheme, marked, _ = folder.partition("://" if "://" in folder else ":")
        local = scheme == "file" if marked else not spark.sparkContext.master.startswith("local") and (
            file_system(spark, folder).getScheme() == "file"
        )
        if local and not spark.sparkContext.master.startswith("local"):
            warnings.warn(f"{folder} is on a local file system; it has to be mounted on all machines", stacklevel=2)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tunehouse-")
    return _local_roots[app]


def file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def own_scratch(spark: SparkSession) -> str:
    """This application's part of the scratch folder."""
    return f"{scratch_root(spark)}/tunehouse/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the scratch folder."""
    return f"{own_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove all that this application has put below the scratch folder; frames that read it end with it."""
    file_system(spark, own_scratch(spark)).delete(spark._jvm.org.apache.hadoop.fs.Path(own_scratch(spark)), True)


def listing(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """Path, length and time of change of every file below ``folder``, in any file system Spark can read."""
    files = file_system(spark, folder).listFiles(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst a real file
    size, so it broadcasts the table exactly when it is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
