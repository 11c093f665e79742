"""Written tables between the steps of an operator, and state kept by a Python worker."""

from __future__ import annotations

import sys
import types
import weakref

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import drop_folder, scratch_path

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_written: dict[str, None] = {}  # folders not deleted yet, in order


def land(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows starts from files: a lost executor costs no recomputation, and
    ids drawn while writing stay as they are. The files go with :func:`release`, or when the session ends.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    stored = spark.read.schema(df.schema).parquet(path)
    _folders[stored] = path
    _written[path] = None
    return stored


def release(spark: SparkSession, *stored: DataFrame) -> None:
    """Delete the files of tables that :func:`land` returned; nothing may read them any more."""
    for frame in stored:
        path = _folders.pop(frame)
        drop_folder(spark, path)
        _written.pop(path, None)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows travel to a Python worker together while a table is written; for wide rows.

    A batch is held by the executor and by the worker, each with room to grow, beside the one before.
    The setting is the session's.
    """
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, rows if int(before) <= 0 else min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


class Steps:
    """Steps that each read the written result of the one before; steps of one process run one after the other."""

    def __init__(self) -> None:
        self.left: list[str] = []  # landed by the steps so far

    def run(self, spark: SparkSession, docs: DataFrame, step: Callable[[], DataFrame]) -> DataFrame:
        """What ``step`` returns; before it, tables that earlier steps landed are deleted, but for those ``docs`` reads."""
        paths = [path for path in self.left if path in _written]
        read = docs.inputFiles() if paths else []
        self.left = [path for path in paths if any(path.rsplit("/", 1)[1] in file for file in read)]
        for path in set(paths) - set(self.left):
            drop_folder(spark, path)
            del _written[path]
        before = set(_written)
        try:
            return step()
        finally:
            self.left += [path for path in _written if path not in before]


def worker_state(key: str, make):
    """``make()``, once per Python worker process and key."""
    holder = sys.modules.setdefault("tallyhouse_worker_state", types.ModuleType("tallyhouse_worker_state"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)
