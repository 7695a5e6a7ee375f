"""Small files and folders wherever Spark's paths point to."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _opened(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path, and the path as it writes it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = named.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(named)


def exists(spark: SparkSession, path: str) -> bool:
    system, named = _opened(spark, path)
    return system.exists(named)


def remove(spark: SparkSession, path: str) -> None:
    system, named = _opened(spark, path)
    system.delete(named, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, none if it is not there."""
    system, named = _opened(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(named)) if system.exists(named) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, null if it is not there."""
    system, named = _opened(spark, path)
    if not system.exists(named):
        return None
    stream = system.open(named)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there whole or not at all, in place of an earlier one."""
    system, named = _opened(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = system.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    replace = getattr(fs, "Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = replace
    fs.FileContext.getFileContext(named.toUri(), spark._jsc.hadoopConfiguration()).rename(
        system.makeQualified(part), named, options)


def fingerprint(spark: SparkSession, source: str | list[str]) -> dict[str, str]:
    """What a listing says of input files: how many, and a sum over their paths, lengths and times.

    The listing is a distributed scan that opens no file.
    """
    files: DataFrame = spark.read.format("binaryFile").load(source)
    of_file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, total = files.agg(F.count(F.lit(1)), F.sum(of_file)).first()
    return {"files": str(n), "sum": str(total)}
