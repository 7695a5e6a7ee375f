"""CSV files whose quoted cells hold line breaks, read by many tasks a file.

Where a line lies inside or outside of quotes depends on all lines before it in its file. Lines with an
odd number of quotes turn one into the other, so it is enough to count these: first per split of a
file, whose running total is a window over one row for each split, then line by line within a split,
in the task that reads it. A line outside of quotes that has an even number of them is a record, and stays
where it was read. Only the other lines are grouped, by file and half the count, into records of several
lines. The files are read three times and only records of several lines are shuffled for this; one
more shuffle, by ranges of their places, puts all records back in input order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadmill.sources.leads import (
    MALFORMED, MAX_BROADCAST_BYTES, POSITION, SPLIT_BYTES, checked_rows, is_malformed,
)

# A record of several lines that has more characters is no record but quotes that do not belong together.
MAX_RECORD_CHARACTERS = 4 << 20

_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",\r\n]*+)'
WHOLE_RECORD = rf"\A{_CELL}(?:,{_CELL})*+\z"

_LINES = "file string, split bigint, text string, line bigint, first boolean, odd_before bigint, odd boolean"


def read_split_csv_leads(spark: SparkSession, path: str | list[str], write: Callable[[DataFrame, str], DataFrame],
                         malformed: str = "fail") -> DataFrame:
    """The rows of CSV files as ``read_csv_leads`` with ``multiline`` reads them, by many tasks a file, in order.

    ``write`` writes a table and reads it back. Lines end with a line feed, which may come after a
    carriage return, and then such pairs in the record's cells become line feeds, as that reader makes them;
    the header is one line, alike in all files. Empty lines outside of quotes are skipped.
    Malformed, besides what ``read_csv_leads`` names, are records of several lines in which
    a quoted cell does not fill its cell, and, each line by itself, the lines that would belong to a
    record longer than MAX_RECORD_CHARACTERS, or to any record of several lines in a file that ends inside
    quotes. So a stray quote neither hides rows nor makes one task collect a file.
    """
    names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    if any("\n" in n for n in names):
        raise ValueError("the CSV header must be one line")
    scanned = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").alias("text"))
    splits = write(_split_states(scanned), "quote_states")
    few = splits.count() * SPLIT_BYTES <= MAX_BROADCAST_BYTES
    lines = scanned.mapInArrow(_counted, _LINES).join(F.broadcast(splits) if few else splits, ["file", "split"], "left")
    # Without a state no line may go on: the files are split in another way than when they were counted.
    unknown = F.raise_error(F.concat(F.lit("no state of quotes for a split of "), F.col("file"))).cast("bigint")
    before = F.coalesce(F.col("before"), unknown) + F.col("odd_before")
    alone = (before % 2 == 0) & ~F.col("odd")
    single = lines.filter(alone).select(
        "file", "split", "line", _without_return("text").alias("text"), F.lit(False).alias("bad"),
        (F.col("first") & (F.col("split") == 0)).alias("header")).filter("text != ''")

    parts = write(lines.filter(~alone).select(
        "file", F.floor(before / 2).alias("record"), "split", "line", "text", "ends_open"), "quoted_lines")
    key = ["file", "record"]
    long = write(parts.filter("NOT ends_open").groupBy(*key).agg(F.sum(F.length("text") + 1).alias("n")).filter(
        F.col("n") > MAX_RECORD_CHARACTERS).select(*key), "long_records")  # at most one for so many characters
    long = F.broadcast(long) if long.count() * SPLIT_BYTES <= MAX_BROADCAST_BYTES else long
    trusted = parts.filter("NOT ends_open")
    loose = parts.filter("ends_open").select("file", "split", "line", "text").unionByName(
        trusted.join(long, key, "left_semi").select("file", "split", "line", "text"))
    place = F.struct("split", "line", "text")
    joined = trusted.join(long, key, "left_anti").groupBy(*key).agg(F.sort_array(F.collect_list(place)).alias("p"))
    text = F.array_join(F.transform("p", lambda p: p["text"]), "\n")
    several = joined.select("file", F.col("p")[0]["split"].alias("split"), F.col("p")[0]["line"].alias("line"), text.alias("text"))
    windows = F.col("text").endswith("\r")
    several = several.withColumn("text", _without_return(F.when(windows, F.replace("text", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))))
    several = several.withColumn("bad", ~F.col("text").rlike(WHOLE_RECORD))
    loose = loose.withColumns({"text": _without_return("text"), "bad": F.lit(True)}).filter("text != ''")
    records = single.unionByName(several.unionByName(loose).withColumn("header", F.lit(False)))
    return _parsed(records, names, malformed)


def _split_states(scanned: DataFrame) -> DataFrame:
    """Per split the number of odd lines before it in its file, and whether the file ends inside quotes."""
    per_split = scanned.groupBy("file", "split").agg(F.sum((_quotes("text") % 2).cast("bigint")).alias("odd_lines"))
    file = Window.partitionBy("file")
    earlier = file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return per_split.select("file", "split", F.coalesce(F.sum("odd_lines").over(earlier), F.lit(0)).alias("before"),
                            (F.sum("odd_lines").over(file) % 2 == 1).alias("ends_open"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line with its number in its split, whether it is the first that is not empty, and the odd lines before it there."""
    last, lines, filled, odd_lines = None, 0, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split, text = (batch.column(c) for c in ("file", "split", "text"))
        odd = np.asarray(pa.compute.count_substring(text, '"')) % 2
        full = _not_empty(text)
        changes = pa.compute.or_(pa.compute.not_equal(file[1:], file[:-1]), pa.compute.not_equal(split[1:], split[:-1]))
        starts = [0, *(np.flatnonzero(np.asarray(changes)) + 1).tolist()]
        made = []
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            here = file[a].as_py(), split[a].as_py()
            if here != last:
                last, lines, filled, odd_lines = here, 0, 0, 0
            odd_upto, full_upto = odd_lines + np.cumsum(odd[a:b]), filled + np.cumsum(full[a:b])
            made.append((lines + np.arange(b - a), (full_upto == 1) & (full[a:b] == 1), odd_upto - odd[a:b]))
            lines, filled, odd_lines = lines + b - a, int(full_upto[-1]), int(odd_upto[-1])
        line, first, before = (np.concatenate(m) for m in zip(*made, strict=True))
        yield pa.RecordBatch.from_arrays(
            [file, split, text, pa.array(line, pa.int64()), pa.array(first), pa.array(before, pa.int64()), pa.array(odd == 1)],
            names=["file", "split", "text", "line", "first", "odd_before", "odd"])


def _not_empty(text: pa.Array) -> np.ndarray:
    empty = pa.compute.is_in(text, pa.array(["", "\r"], text.type))
    return 1 - np.asarray(empty).astype(np.int64)


def _parsed(records: DataFrame, names: list[str], malformed: str) -> DataFrame:
    """Cells of all records but the headers, which must be alike."""
    cells = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in [*cells, MALFORMED])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "multiLine": "true"}
    rows = records.withColumn("row", F.from_csv("text", schema, options))
    same = F.lit(True)
    for i, (cell, name) in enumerate(zip(cells, names, strict=True)):
        # The reader numbers names that are missing or there twice.
        value = F.col("row")[cell]
        numbered = F.concat(F.when(F.coalesce(value, F.lit("")) == "", "_c").otherwise(value), F.lit(str(i)))
        same = same & (F.coalesce(value == name, F.lit(False)) | (numbered == name))
    other = F.raise_error(F.concat(F.lit("CSV header does not conform to the first file's: "), F.left("text", F.lit(200))))
    alike = same & F.col("row")[MALFORMED].isNull()
    rows = rows.repartitionByRange("file", "split", "line").sortWithinPartitions("file", "split", "line")
    # What fails on a row must not be pushed down to lines that are no rows; it is not, below a column like this.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    here = F.col("place") >= 0
    rows = rows.filter(F.when(~(F.col("header") & here), True).when(alike, False).otherwise(other.cast("boolean")))
    whole = F.when(F.col("bad"), F.col("text")).otherwise(F.col("row")[MALFORMED])
    raw = rows.select(*[F.col("row")[c].alias(n) for c, n in zip(cells, names, strict=True)], whole.alias(MALFORMED),
                      F.struct("file", "split").alias(POSITION), F.col("bad").alias("_bad"), here.alias("_here"))
    return checked_rows(raw, names, F.col("_here") & (F.col("_bad") | is_malformed(names)), malformed)


def _quotes(column: str) -> Column:
    return F.length(column) - F.length(F.replace(F.col(column), F.lit('"'), F.lit("")))


def _without_return(text: Column | str) -> Column:
    return F.regexp_replace(text, r"\r\z", "")
