"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import without_blanks


def parse_number(column: Column) -> Column:
    """Double of a value such as "16 800"; text that is no number raises under ANSI."""
    return without_blanks(column.cast("string")).cast("double")


def number(df: DataFrame, column: str, strict: bool = True) -> Column:
    """`column` as double: a cast for numbers, blanks removed first for text.

    Text that is no number raises under ANSI if `strict`, else becomes null.
    """
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, T.NumericType):
        value = without_blanks(value.cast("string"))
    return value.cast("double") if strict else value.try_cast("double")


def is_finite(column: Column) -> Column:
    return ~F.isnan(column) & (F.abs(column) != float("inf"))


def rescale(df: DataFrame, column: str, slope: float, intercept: float = 0.0) -> DataFrame:
    """`column` as double, times `slope` plus `intercept`."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")
    if not all(abs(v) < float("inf") for v in (slope, intercept)):
        raise ValueError("slope and intercept must be finite")
    return df.withColumn(column, F.col(column).cast("double") * slope + intercept)


def numeric_view(column: str, data_type: T.DataType) -> Column | None:
    """The column as a number if it is numeric, boolean or a date; None for other types."""
    if isinstance(data_type, T.BooleanType):
        return F.col(column).cast("int").cast("double")
    if isinstance(data_type, T.DateType):
        return F.unix_date(F.col(column)).cast("double")
    if isinstance(data_type, T.NumericType):
        return F.col(column).cast("double")
    return None
