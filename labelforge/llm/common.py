"""Helpers shared by the operators: reading, cutting lineage, exact identity of rows."""

from __future__ import annotations

import ctypes
import gc
import os
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from labelforge.session import fresh_path, written

__all__ = ["arrow_batches", "discard", "fresh_path", "partitions", "raw_texts", "read", "release_memory", "unused", "written"]


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A given table, pruned to ``cols`` (all columns without them)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a written table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def unused(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def raw_texts(column) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column (None for null)."""
    return column.cast(pa.binary()).to_pylist()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))



@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Jobs planned inside hand at most ``rows`` rows at a time to Python workers: what a worker and
    its executor hold of long texts shrinks with it.  The session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release_memory() -> None:
    """Hands freed memory back to the system.  Python workers serve one task after another,
    beside the executor's heap, and would keep what their largest task took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # a GNU library has it
    if trim:
        trim(0)
