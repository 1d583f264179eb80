"""Sessions for tests and benches, and staged data in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders that this process has staged and not yet removed.
_staged: list[str] = []


def local_session(
    name: str = "clearwell", cores: str = "8", partitions: int = 8, folder: str | None = None
) -> SparkSession:
    """A session for tests and benches; on a cluster the submitted session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: ``spark.checkpoint.dir``, or else one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.staging"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is created or overwritten."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on the plan that made it, so a lost executor
    costs a re-read instead of a recomputation, and values that depend on where
    a row was processed are fixed once the write has been committed. The data
    stay until :func:`discard`, the end of :func:`staging`, or the retention of
    the shared folder.
    """
    path = new_folder(df.sparkSession, label)
    _staged.append(path)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that no later plan reads, in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _remove(spark: SparkSession, path: str) -> None:
    remove_folder(spark, path)
    _staged.remove(path)


def discard(df: DataFrame) -> None:
    """Remove the data of a staged DataFrame that no later plan reads."""
    _remove(df.sparkSession, df.staged_path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside send Python at most ``rows`` rows at a time, for rows that hold whole texts or more.

    A batch is in memory several times, in the JVM and in each worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was staged inside; results must have been written or collected by then."""
    before = set(_staged)
    try:
        yield
    finally:
        for path in [p for p in _staged if p not in before]:
            _remove(spark, path)
