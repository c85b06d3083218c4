"""Date, numeric and categorical features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    day_of_week,
    is_missing,
    is_weekend,
    log1p_value,
    parse_timestamp,
    reciprocal,
    sqrt_value,
    string_columns,
    timestamp_columns,
)
from ..session import materialize, pin
from .joins import join_on
from .ordering import chunk_borders, in_chunks
from .windows import HOT_ROWS

NUMERIC_OPERATIONS = ("sqrt", "log", "square", "reciprocal", "abs")


def create_date_features(df: DataFrame, date_column: str, prefix: str = "") -> DataFrame:
    """Add year, month, day, hour, minute, quarter, dayofweek (Monday 0) and is_weekend.

    Text columns are parsed; unreadable text gives NULL features.
    """
    ts = parse_timestamp(date_column) if date_column in string_columns(df) else F.col(date_column)
    head = f"{prefix}_" if prefix else ""
    return df.withColumns(
        {
            f"{head}year": F.year(ts),
            f"{head}month": F.month(ts),
            f"{head}day": F.dayofmonth(ts),
            f"{head}hour": F.hour(ts),
            f"{head}minute": F.minute(ts),
            f"{head}quarter": F.quarter(ts),
            f"{head}dayofweek": day_of_week(ts),
            f"{head}is_weekend": is_weekend(ts),
        }
    )


def create_first_date_features(df: DataFrame, prefix: str = "") -> DataFrame:
    """Date features of the first timestamp column, if there is one."""
    names = timestamp_columns(df)
    return create_date_features(df, names[0], prefix) if names else df


def create_numerical_features(
    df: DataFrame,
    columns: Sequence[str],
    operations: Sequence[str] = ("sqrt", "log", "square"),
    use_abs: bool = False,
) -> DataFrame:
    """Add ``{col}_{operation}``; ``use_abs`` takes root and logarithm of the absolute value."""
    unknown = set(operations) - set(NUMERIC_OPERATIONS)
    if unknown:
        raise ValueError(f"unknown operations {sorted(unknown)}")

    def feature(name: str, operation: str) -> Column:
        column = F.col(name)
        if operation == "sqrt":
            return sqrt_value(column, use_abs)
        if operation == "log":
            return log1p_value(column, use_abs)
        if operation == "square":
            return F.try_multiply(column, column)  # NULL beyond the range of whole numbers
        return reciprocal(column) if operation == "reciprocal" else F.abs(column)

    return df.withColumns({f"{c}_{o}": feature(c, o) for c in columns for o in operations})


def label_index(df: DataFrame, column: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(column, label_index)``: 0 for the most frequent label, ties in alphabetical order.

    The labels are put in order of count and name by ranges, ``hot_rows`` to a task, and each range is shifted by
    the labels before it. Runs jobs at once; the ordered labels are stored in the shared folder.
    """
    counts = df.filter(~is_missing(df, column)).groupBy(column).agg(F.count(F.lit(1)).alias("_count"))
    counts = materialize(counts, "label-counts")
    ordered = in_chunks(counts, [F.desc("_count"), F.col(column)], counts.count(), hot_rows, "labels")
    shifts = pin(chunk_borders(ordered, []).select("_chunk", "_offset"), "label-shifts")
    index = (F.col("_offset") + F.col("_place")).cast("double")
    return join_on(ordered, shifts, ["_chunk"]).select(column, index.alias("label_index"))


def create_categorical_features(df: DataFrame, column: str, method: str = "onehot") -> DataFrame:
    """Add ``{column}_encoded``: the label index, or a sparse 0/1 vector without the last label.

    Rows with a missing label get a NULL index, and are rejected by ``onehot``.
    """
    if method not in ("label", "onehot"):
        raise ValueError(f"unknown method {method!r}")
    encoded = f"{column}_encoded"
    labels = label_index(df, column).withColumnRenamed("label_index", encoded)
    # No hint: the planner broadcasts a short label list and otherwise splits hot labels.
    indexed = df.join(labels, column, "left").select(*df.columns, encoded)
    if method == "label":
        return indexed
    # The number of labels travels as the column's attribute, so that the encoder needs no pass of its own.
    size = {"ml_attr": {"type": "nominal", "num_vals": labels.count()}}
    indexed = indexed.withColumn("_index", F.col(encoded).alias("_index", metadata=size)).drop(encoded)
    encoder = OneHotEncoder(inputCol="_index", outputCol=encoded)
    return encoder.fit(indexed).transform(indexed).drop("_index")
