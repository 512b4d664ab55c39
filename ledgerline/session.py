"""Session settings the results depend on, and the shared folder that staged files go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here relies on: entry times are rendered in UTC, casts raise instead of
# wrapping, joins whose key is hot are split by adaptive execution even if that costs a shuffle, and a batch
# for a Python worker holds some megabytes, however long its rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local master may run without it; it then gets one temporary folder per application.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ledgerline-")
    return _local_roots[app]


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh subfolder path of the shared folder; never reused, so jobs cannot meet in it."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, folder: str | None = None, by: str | None = None) -> DataFrame:
    """``df`` stored as a table and read back, in the shared folder or below ``folder``.

    For results that several later steps read: they are computed once, a lost executor costs no more
    than reading them again, and readers still prune columns and push filters into the scan. A table
    below ``folder`` takes the place of an earlier one of its name. ``by`` names a column to partition by.
    """
    path = workspace(df.sparkSession, name) if folder is None else f"{folder}/{name}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if by is not None:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    folder, files = _located(spark, path)
    return files.exists(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly below ``path`` in any store Spark can write to; none if it does not exist."""
    folder, files = _located(spark, path)
    if not files.exists(folder):
        return []
    return [f"{path}/{one.getPath().getName()}" for one in files.listStatus(folder)
            if one.isDirectory() and not one.getPath().getName().startswith("_")]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with everything in it; nothing happens if it does not exist."""
    folder, files = _located(spark, path)
    files.delete(folder, True)


def _located(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())
