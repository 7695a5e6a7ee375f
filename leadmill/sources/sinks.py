"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.operators.export import reasons_text


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write parquet and return the written table."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_reason(rejected: DataFrame, path: str) -> DataFrame:
    """Write rejects with a folder for each reason, and return the whole table.

    Only the reasons that ``rejected`` has are replaced; those that lie there already stay, so one reason can
    be written anew alone, and a reader of one reason opens the files of no other.
    """
    (rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("drop_reason").parquet(path))
    return rejected.sparkSession.read.schema(rejected.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write CSV with a header that reads back as written: padding kept, null as an empty cell.

    CSV holds no lists, so lists of reasons become text.
    """
    flat = [
        reasons_text(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name)
        for f in df.schema
    ]
    (
        df.select(*flat).write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_summary(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the one-row report as one indented JSON document."""
    document = F.to_json(F.struct(*summary.columns), {"pretty": "true", "ignoreNullFields": "false"})
    summary.select(document.alias("value")).coalesce(1).write.mode(mode).text(path)
