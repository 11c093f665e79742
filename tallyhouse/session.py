"""Session settings: the shared work folder and the size of shuffles."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"

# One reducer is sized for this much data, counted as rows in memory, so the number of
# reducers grows with the input without a limit. A session may set its own.
REDUCER_BYTES = 512 << 20
_REDUCER_BYTES = "spark.tallyhouse.reducerBytes"
# Rows in memory against compressed columns.
EXPANSION = 96

_local_folders: dict[str, str] = {}
_announced: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, private to this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    where driver and executors are one process, falls back to a folder of
    its own.
    """
    application = spark.sparkContext.applicationId
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return f"{configured.rstrip('/')}/tallyhouse-{application}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"set {_CHECKPOINT_DIR} to a folder that every executor can reach"
        )
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local_folders[application]


def file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, and ``path`` as it wants it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, the way Spark reports the files below it."""
    files, target = file_system(spark, path)
    return files.makeQualified(target).toString()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark can write."""
    files, target = file_system(spark, path)
    files.delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; what is still there goes with the application."""
    folder = shared_folder(spark)
    if folder not in _announced:
        files, target = file_system(spark, folder)
        files.mkdirs(target)
        files.deleteOnExit(target)
        _announced.add(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch path that is deleted when the work on it is done."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        drop_folder(spark, path)


def source_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files below ``paths``; lists them, reads none."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(paths))
    )
    return files.agg(F.sum("length")).first()[0] or 0


def row_bytes(spark: SparkSession, *paths: str) -> int:
    """About the memory that the rows of the columnar files below ``paths`` take in a shuffle: order lines of 14
    compressed bytes become rows of 170 to 400, and the sorts, hash tables and keys beside them need as much again
    several times."""
    return EXPANSION * source_bytes(spark, *paths)


def shuffle_partitions_for(num_bytes: int, reducer_bytes: int = REDUCER_BYTES) -> int:
    return max(1, math.ceil(num_bytes / reducer_bytes))


def spread(frame: DataFrame, *columns: str) -> DataFrame:
    """``frame`` dealt by ``columns`` over as many partitions as its rows need in memory, if the session has fewer.

    For queries that run with the session's own width. A grouping by these columns then
    takes no shuffle of its own; ``frame`` scans files, so the planner knows their size.
    """
    spark = frame.sparkSession
    scanned = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    needed = shuffle_partitions_for(EXPANSION * scanned, _number(spark.conf.get(_REDUCER_BYTES, str(REDUCER_BYTES))))
    return frame.repartition(needed, *columns) if needed > int(spark.conf.get(_SHUFFLE_PARTITIONS)) else frame


@contextmanager
def sized_for(spark: SparkSession, num_bytes: int) -> Iterator[None]:
    """Widen shuffles for an input of this size while a job runs, then restore.

    Adaptive execution merges partitions that turn out small but never adds
    any, so the width has to start high enough. A larger setting stays. The
    setting is the session's: jobs that run at the same time need sessions of
    their own (``spark.newSession()``).
    """
    reducer = _number(spark.conf.get(_REDUCER_BYTES, str(REDUCER_BYTES)))
    needed = shuffle_partitions_for(num_bytes, reducer)
    before = spark.conf.get(_SHUFFLE_PARTITIONS)
    if needed > int(before):
        spark.conf.set(_SHUFFLE_PARTITIONS, needed)
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_PARTITIONS, before)


_UNITS = {"b": 0, "k": 10, "m": 20, "g": 30, "t": 40}


def _number(setting: str) -> int:
    """A count, or a size such as 134217728b or 128MB."""
    text = setting.strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits):][:1] or "b"
    return int(digits) << _UNITS[unit]


def local_session(cores: str = "8", app_name: str = "tallyhouse", **extra: str) -> SparkSession:
    """Session used by the tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TALLYHOUSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(_SHUFFLE_PARTITIONS, "8")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
