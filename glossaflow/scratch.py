"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows that a Parquet scan decodes at once, and rows handed to a Python worker at once.
BATCH_SETTINGS = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
BATCH_ROWS = 512
# Folders handed out in each open scope.
_scopes: list[list[str]] = []


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="glossaflow-")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the one named in ``spark.checkpoint.dir`` (or set on the context).

    A session without either gets a temporary folder in local mode (tests) and an error elsewhere, since
    executors on other machines could not read it.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        root = _local_root()
    folder = f"{root.rstrip('/')}/glossaflow/{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(folder)
    return folder


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders that were handed out inside the scope when it ends.

    Collect or write what was read from them before: frames from inside a scope are of no use after it.
    """
    folders: list[str] = []
    _scopes.append(folders)
    try:
        yield
    finally:
        _scopes.remove(folders)
        for folder in folders:
            system, path = file_system(spark, folder)
            system.delete(path, True)


def file_system(spark: SparkSession, folder: str):
    """The file system that holds ``folder``, and ``folder`` as a path of it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, folder: str) -> bool:
    system, path = file_system(spark, folder)
    return system.exists(path)


def discard(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete tables that :func:`stage` wrote to ``folder``, once all that reads them has been written itself."""
    for name in names:
        system, path = file_system(spark, f"{folder}/{name}")
        system.delete(path, True)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of each query of this session as soon as it ends, not when the driver happens to
    collect its garbage. Versions of Spark without that setting go on as before."""
    known = spark.conf.isModifiable(SHUFFLE_CLEANUP_SETTING)
    before = spark.conf.get(SHUFFLE_CLEANUP_SETTING) if known else None
    if known:
        spark.conf.set(SHUFFLE_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if known:
            spark.conf.set(SHUFFLE_CLEANUP_SETTING, before)


def take_small_batches(spark: SparkSession) -> dict[str, str]:
    """From now on have scans and Python workers of this session take ``BATCH_ROWS`` rows at a time, or fewer if it is set so: rows
    with long texts or lists by the thousand are arrays of many megabytes, several at once for every running task. Returns
    the settings before."""
    before = {name: spark.conf.get(name) for name in BATCH_SETTINGS}
    for name, rows in before.items():
        if not 0 < int(rows) <= BATCH_ROWS:
            spark.conf.set(name, str(BATCH_ROWS))
    return before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """:func:`take_small_batches` for a while, and the settings before again."""
    before = take_small_batches(spark)
    try:
        yield
    finally:
        for name, rows in before.items():
            spark.conf.set(name, rows)


def stage(df: DataFrame, name: str, folder: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later steps neither repeat its work nor depend on its lineage."""
    spark = df.sparkSession
    path = f"{folder or scratch_folder(spark)}/{name}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
