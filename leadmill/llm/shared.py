"""What several operators need: columns by exact name, written tables, bounded pieces of batches."""

from __future__ import annotations

import atexit
import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text that is worked on at a time inside a task, unless one text alone is longer.
PIECE_BYTES = 4 << 20
# The same where a task holds many numbers for each byte.
HASHED_BYTES = 1 << 19
# What Spark hands to a Python worker at a time, about; its own bound is 64 MB, held by the executor and its worker both.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

# Ids that may be broadcast, eight bytes each.
BROADCAST_IDS = 1_000_000


def worker_memory(name: str) -> dict:
    """A dictionary that a Python worker keeps from one task to the next.

    Tasks get this package by value, so its own variables begin anew in each of them.
    """
    return vars(sys.modules.setdefault(f"_leadmill_{name}", ModuleType(f"_leadmill_{name}")))


def small_batches(spark: SparkSession) -> None:
    """Have the session hand out Arrow batches of at most BATCH_BYTES and a row; a lower setting stays."""
    told = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if told(spark.conf.get(BATCH_SETTING, f"{BATCH_BYTES + 1}b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, handed to Python in small batches; others that differ by case only, or repeat a name, do no harm."""
    small_batches(df.sparkSession)
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{df.columns.index(name)}").alias(name) for name in names])


def without_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose id is not among ``ids``, which are broadcast if they are few enough."""
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, column, "left_anti")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors and the driver see.

    Local mode may use a temporary folder instead, a cluster may not.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/leadmill-llm-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts the lineage.

    The folder is removed by :func:`unstage`, or else when the driver's Python ends.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    df.write.parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    _folders[id(written)] = written, folder
    return written


# Tables that are there, by the identity of the frame that reads them.
_folders: dict[int, tuple[DataFrame, str]] = {}


def unstage(df: DataFrame) -> None:
    """Remove a staged table that no plan reads any more."""
    _, folder = _folders.pop(id(df))
    _remove(df.sparkSession, folder)


@atexit.register
def _unstage_all() -> None:
    for df, _ in list(_folders.values()):
        if df.sparkSession.sparkContext._jsc is not None:  # else stopped before
            unstage(df)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pieces(batches: Iterator[pa.RecordBatch], column: str | int,
           most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a column of text holds at most so many bytes, or one row.

    After the last one the memory that the task has used goes back to the system: a worker waits for its next task
    while other stages need it.
    """
    for batch in batches:
        text = batch.column(column)
        start = 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(text), 0).to_pylist()
        held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
        del batch, text, sizes  # not held while the next one is read
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)
