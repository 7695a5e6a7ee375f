"""Raw leads: reading, checking the contract, numbering the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.fixed_values import LEAD_FIELDS, NULL_TOKENS, RAW_TO_LEAD
from leadmill.schema import NORMALIZED_COLUMNS, ROW_NUMBER, with_missing_as_null

POSITION = "_position"

# Text of a malformed CSV row; null in all other rows.
MALFORMED, WELL_FORMED = "_malformed", "_well_formed"

# Bytes of the table of splits that may be broadcast, and of one of its rows with a long file name.
MAX_BROADCAST_BYTES, SPLIT_BYTES = 64 << 20, 400


def read_csv_leads(spark: SparkSession, path: str | list[str], multiline: bool = False,
                   malformed: str = "fail") -> DataFrame:
    """Scan CSV files with a header; every column is text and null tokens become null.

    Columns are named by the header, which all files must have alike. A row with more cells than
    the header, or with a quote that is not closed, is malformed: with ``malformed="fail"`` the job
    that reads it fails and shows it, with "reject" its text is in the column MALFORMED. Rows with
    fewer cells are completed with nulls. ``multiline`` allows line breaks inside quotes but makes
    each file one task (``read_split_csv_leads`` does not); without it a row with such a cell is malformed, and a quote that is left
    open in the last cell of a line ends with the line, so that nothing is lost.
    """
    read = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)  # a file whose header differs is an error, not a mix-up
    )
    names = read.csv(path).columns
    if not names:
        return read.csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, MALFORMED]])
    raw = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)
    raw = raw.select(*map(_named, [*names, MALFORMED]), _file_position())
    bad = is_malformed(names)
    if multiline:
        raw = raw.join(_files_with_open_quotes(spark, path), F.col(POSITION).getField("file") == F.col("_file"), "left")
        bad = bad | (F.col("_file").isNotNull() & F.concat_ws("", *map(_named, names)).contains("\n"))
    return checked_rows(raw, names, bad, malformed)


def checked_rows(raw: DataFrame, names: list[str], bad: Column, malformed: str) -> DataFrame:
    """The cells with null tokens as null; rows that are ``bad`` fail the job, or have their text in MALFORMED."""
    if malformed not in ("fail", "reject"):
        raise ValueError("malformed must be 'fail' or 'reject'")
    if malformed == "fail":
        shown = F.concat(F.lit("malformed CSV row: "), F.left(F.coalesce(MALFORMED, _named(names[0]), F.lit("")), F.lit(200)))
        raw = raw.filter(F.when(bad, F.raise_error(shown).cast("boolean")).otherwise(True))
    cells = [F.when(~_named(c).isin(NULL_TOKENS), _named(c)).alias(c) for c in names]
    text = [] if malformed == "fail" else [
        F.when(bad, F.coalesce(MALFORMED, F.concat_ws(",", *map(_named, names)))).alias(MALFORMED)]
    return raw.select(*cells, *text, POSITION)


def is_malformed(names: list[str]) -> Column:
    """Too many cells, or a quote that is not closed; rows that are only short do not count.

    The reader keeps the text of every row whose number of cells differs from the header's.
    """
    outside = F.regexp_replace(MALFORMED, r'"(?:[^"]|"")*"', "")
    commas = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    odd = F.col(MALFORMED).isNotNull() & (outside.contains('"') | (commas >= len(names)))
    return F.coalesce(odd, F.lit(False))


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _files_with_open_quotes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Names of the files with an odd number of quotes.

    Where cells may have several lines, an open quote takes the lines that follow into its cell and
    leaves no other trace; so rows with a line break in a cell are not trusted in such files.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), _quotes(F.col("value")).alias("n"))
    return lines.groupBy("_file").agg(F.sum("n").alias("n")).filter("n % 2 = 1").select("_file")


def spread(rows: DataFrame, tasks: int | None, key: str = ROW_NUMBER) -> DataFrame:
    """Deal rows out to so many tasks by a unique key; None leaves them where they were read.

    For input that one or a few tasks read, such as one small or unsplittable file.
    """
    return rows.repartition(tasks, key) if tasks else rows


def check_contract(df: DataFrame) -> None:
    """Fail before any job runs when a contract column is missing."""
    missing = [c for c in RAW_TO_LEAD if c not in df.columns]
    if missing:
        raise ValueError(f"Missing expected input columns: {', '.join(missing)}")


def prepare_leads(raw: DataFrame, row_number: Column | str | None = None) -> DataFrame:
    """Select and rename the contract columns, number the rows, add the columns still to fill.

    ``row_number`` is a unique integer column that gives the input order. Without one the rows
    get their position in the input, which :func:`number_rows` turns into 1..n once the rows
    are written down.
    """
    check_contract(raw)
    renamed = [_named(old).alias(new) for old, new in RAW_TO_LEAD.items()]
    if row_number is not None:
        key = F.col(row_number) if isinstance(row_number, str) else row_number
        number = key.cast("bigint")
        missing = F.raise_error(F.lit("row numbers must not be null")).cast("bigint")
        identity = [F.when(number.isNull(), missing).otherwise(number).alias(ROW_NUMBER)]
    else:
        anywhere = F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("split"))
        identity = [
            F.monotonically_increasing_id().alias(ROW_NUMBER),
            (_named(POSITION) if POSITION in raw.columns else anywhere).alias(POSITION),
        ]
    # Null in malformed rows, as a rule of acceptance sees it.
    formed = [F.when(F.col(MALFORMED).isNull(), "yes").alias(WELL_FORMED)] if MALFORMED in raw.columns else []
    prepared = raw.select(*identity, *renamed, _named("Email").alias("raw_email"), *formed)
    prepared = with_missing_as_null(prepared, LEAD_FIELDS)
    kept = [POSITION] if row_number is None else []
    return prepared.select(*NORMALIZED_COLUMNS, *kept, *[c for c in [WELL_FORMED] if c in prepared.columns])


def number_rows(written: DataFrame, offsets: DataFrame, splits: int) -> DataFrame:
    """Replace the row number by 1..n in input order.

    ``offsets`` comes from :func:`split_offsets` over the same written rows. It has one row per
    input split and is broadcast while its counted rows, of some hundred bytes each with the
    file's name, are bounded; beyond that the join shuffles by split, and no split is bigger than
    one task's input.
    """
    rows = written.withColumns(_split_key())
    few = splits * SPLIT_BYTES <= MAX_BROADCAST_BYTES
    numbered = rows.join(F.broadcast(offsets) if few else offsets, list(_split_key()))
    dense = F.col("_before") + F.col(ROW_NUMBER) - F.col("_first") + 1
    return numbered.withColumn(ROW_NUMBER, dense).drop(
        "_before", "_first", *_split_key(), POSITION
    )


def split_offsets(written: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Per input split: its first id and the number of rows in all splits before it.

    Running totals are taken in two levels: splits are dealt to groups by ranges of their order, each
    group's running total is one task's, and only one row for each group meets in one task.
    ``write`` writes a table and reads it back: the groups must not change between their two uses.
    """
    key = _split_key()
    per_split = written.groupBy(*[c.alias(name) for name, c in key.items()]).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(ROW_NUMBER).alias("_first")
    )
    ordered = write(per_split.repartitionByRange(*key).withColumn("_group", F.spark_partition_id()), "splits")
    inside = Window.partitionBy("_group").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    groups = ordered.groupBy("_group").agg(F.sum("_rows").alias("_group_rows"))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = groups.select("_group", F.coalesce(F.sum("_group_rows").over(earlier), F.lit(0)).alias("_groups_before"))
    return ordered.join(totals, "_group").select(*key, "_first", (
        F.col("_groups_before") + F.coalesce(F.sum("_rows").over(inside), F.lit(0))).alias("_before"))


def check_row_numbers(df: DataFrame) -> None:
    """Fail if a row number is null or there twice; moves one number per row, counted map-side first."""
    wrong = df.groupBy(ROW_NUMBER).agg(F.count(F.lit(1)).alias("rows")).filter(
        F.col(ROW_NUMBER).isNull() | (F.col("rows") > 1)).limit(1).collect()
    if wrong:
        number, rows = wrong[0]
        raise ValueError(f"row numbers must be unique and not null; {rows} rows have {number}")


def _split_key() -> dict[str, Column]:
    """What a run of successive ids belongs to: a split of a file, read by one task.

    The task is in the upper bits of the id.
    """
    position = F.col(POSITION)
    return {
        "_file": position.getField("file"),
        "_split": position.getField("split"),
        "_task": F.shiftright(F.col(ROW_NUMBER), 33),
    }


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def _file_position() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
    ).alias(POSITION)
