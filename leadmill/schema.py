"""Column contracts as Spark types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.fixed_values import CLEAN_COLUMNS, LEAD_FIELDS

ROW_NUMBER = "source_row_number"

# Everything that is not listed here is a nullable string.
_TYPES = {
    ROW_NUMBER: T.LongType(),
    "lead_score": T.IntegerType(),
    "score_reasons": T.ArrayType(T.StringType()),
    "salesforce_ready": T.BooleanType(),
}


def type_of(column: str) -> T.DataType:
    return _TYPES.get(column, T.StringType())


def struct_of(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, type_of(c)) for c in columns])


NORMALIZED_COLUMNS = [ROW_NUMBER, *LEAD_FIELDS]
NORMALIZED_LEAD = struct_of(NORMALIZED_COLUMNS)
CLEAN_LEAD = struct_of(CLEAN_COLUMNS)
REJECTED_LEAD = struct_of([*NORMALIZED_COLUMNS, "drop_reason"])


def with_missing_as_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Append the columns of the contract that ``df`` lacks, as typed nulls."""
    absent = {c: column_or_null(df, c) for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def column_or_null(df: DataFrame, column: str) -> Column:
    """The column, or a typed null where ``df`` lacks it."""
    return F.col(column) if column in df.columns else F.lit(None).cast(type_of(column))
