"""Column selection by type and the single definition of "missing"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def columns_of(df: DataFrame, kinds: type | tuple[type, ...]) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, kinds)]


def string_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def timestamp_columns(df: DataFrame) -> list[str]:
    return columns_of(df, (T.TimestampType, T.TimestampNTZType))


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, and also NaN on floating-point columns."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, FLOATING):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL, so that no measure sees it."""
    return F.when(~is_missing(df, name), F.col(f"`{name}`")) if isinstance(df.schema[name].dataType, FLOATING) else F.col(f"`{name}`")


def missing_count(df: DataFrame, name: str) -> Column:
    return F.count_if(is_missing(df, name))
