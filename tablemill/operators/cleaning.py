"""Duplicates, missing values, string cleaning, range rules and type conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    duration_minutes,
    day_of_week,
    is_missing,
    is_weekend,
    missing_count,
    numeric_columns,
    parse_timestamp,
    string_columns,
    strip_special,
    strip_whitespace,
)
from ..functions.columns import FLOATING
from ..session import materialize
from .quantiles import exact_quantiles

# The trip key, the columns a trip must have, the passenger limit.
TRIP_KEY = ["trip_id"]
TRIP_REQUIRED = ["pickup_datetime", "vendor_id", "passenger_count"]
MAX_PASSENGERS = 8


# Duplicates


def remove_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    keep: str = "first",
    order_by: Sequence[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per distinct row, or per distinct ``subset``.

    A table has no row order, so ``keep`` only acts together with ``order_by``; without it any
    row of each key survives. Both forms reduce on the map side before the shuffle (partial
    aggregation, or a partial group limit of one row), so a hot key sends one row per task.

    ``copies`` names a column that tells how many rows each distinct row stands for; for a ``subset`` see
    ``with_copies``.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    if copies is not None:
        if subset is not None:
            raise ValueError("copies are counted for whole rows")
        return df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias(copies))
    if subset is None:
        return df.dropDuplicates()
    if order_by is None:
        return df.dropDuplicates(list(subset))
    order = [F.asc(c) if keep == "first" else F.desc(c) for c in order_by]
    window = Window.partitionBy(*subset).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(~is_missing(df, column)).distinct().orderBy(column)


# Missing values


def handle_missing_values(
    df: DataFrame,
    strategy: str = "drop",
    fill_value: Mapping[str, object] | None = None,
    columns: Sequence[str] | None = None,
    whole_numbers: str | None = None,
) -> DataFrame:
    """Strategies ``drop``, ``fill``, ``median`` and ``mean``; see ``forward_fill`` for the ordered one.

    ``whole_numbers`` fixes what a median or mean does to whole-number columns: ``"double"`` makes all of them
    double, ``"keep"`` keeps their types and rounds the filled number; without it a column becomes double only
    when it has gaps and its median or mean a fraction.

    ``columns`` limits the strategy to some columns (all columns, or all numeric ones, by default).
    """
    if strategy == "drop":
        return df.dropna("any", subset=list(columns) if columns else None)
    if strategy == "fill":
        return df.fillna(dict(fill_value)) if fill_value else df
    if strategy in ("median", "mean"):
        if whole_numbers not in (None, "double", "keep"):
            raise ValueError(f"unknown rule {whole_numbers!r}")
        wanted = list(columns or numeric_columns(df))
        if whole_numbers == "double":
            whole = [c for c in wanted if isinstance(df.schema[c].dataType, T.IntegralType)]
            df = df.withColumns({c: F.col(c).cast("double") for c in whole})
        names = _with_missing(df, wanted)
        return _fill(df, (_medians if strategy == "median" else _means)(df, names), whole_numbers == "keep") if names else df
    raise ValueError(f"unknown strategy {strategy!r}")


def _with_missing(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns with at least one missing cell; the others need no statistics.

    A single floating-point column skips this pass: filling it cannot change its type.
    """
    if not columns or (len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, FLOATING)):
        return columns
    counts = df.agg(*[missing_count(df, c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c]]


def _medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    rows = exact_quantiles(df, columns, [0.5]).collect()  # one row per column
    return {row["column"]: row["quantiles"][0] for row in rows if row["quantiles"]}


def _means(df: DataFrame, columns: list[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.when(~is_missing(df, c), F.col(c).cast("double"))).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns if row[c] is not None}


def _fill(df: DataFrame, values: Mapping[str, float], rounds: bool = False) -> DataFrame:
    """Replace missing cells; decimals keep their type, a whole-number column that receives a fraction becomes double.

    With ``rounds`` whole-number columns keep theirs, too, and receive the rounded number.
    """
    filled = {}
    for name, value in values.items():
        kind = df.schema[name].dataType
        whole = isinstance(kind, T.IntegralType)
        value = float(round(value)) if whole and rounds else value
        keeps = isinstance(kind, (*FLOATING, T.DecimalType)) or (whole and float(value).is_integer())
        target = kind if keeps else T.DoubleType()
        filled[name] = F.when(is_missing(df, name), F.lit(value).cast(target)).otherwise(F.col(name).cast(target))
    return df.withColumns(filled) if filled else df


# Strings


def clean_string_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    lowercase: bool = True,
    trim_whitespace: bool = True,
    remove_special_chars: bool = False,
) -> DataFrame:
    """Trim, lower-case and strip special characters, in that order; absent columns are skipped."""
    names = string_columns(df) if columns is None else [c for c in columns if c in df.columns]
    cleaned = {}
    for name in names:
        text = F.col(name)
        if trim_whitespace:
            text = strip_whitespace(text)
        if lowercase:
            text = F.lower(text)
        if remove_special_chars:
            text = strip_special(text)
        cleaned[name] = text
    return df.withColumns(cleaned) if cleaned else df


# Range rules and filters


def valid_trip(with_total: bool = False) -> Column:
    """Passengers in 1..8, distance and fare not negative; NULL and NaN fail the test."""

    def not_negative(name: str) -> Column:
        amount = F.col(name).cast("double")
        return (amount >= 0) & ~F.isnan(amount)

    passengers = F.col("passenger_count")
    rules = [(passengers > 0) & (passengers <= MAX_PASSENGERS), not_negative("trip_distance"), not_negative("fare_amount")]
    if with_total:
        rules.append(not_negative("total_amount"))
    return reduce(lambda a, b: a & b, rules)


def filter_valid_trips(df: DataFrame, with_total: bool = False) -> DataFrame:
    return df.filter(valid_trip(with_total))


def filter_by_age(df: DataFrame, column: str, as_of: Column, days: tuple[int, int]) -> DataFrame:
    """Rows between ``days[1]`` and ``days[0]`` days before ``as_of``, both ends included."""
    low, high = days
    start = as_of - F.expr(f"INTERVAL {int(high)} DAYS")
    end = as_of - F.expr(f"INTERVAL {int(low)} DAYS")
    return df.filter(F.col(column).between(start, end))


def apply_filters(
    df: DataFrame,
    as_of: Column | None = None,
    days: tuple[int, int] | None = None,
    vendors: Sequence[int] | None = None,
    passengers: tuple[int, int] | None = None,
) -> DataFrame:
    """Date window, vendor list and passenger range; an argument left out does not filter.

    ``as_of`` defaults to the start time of the query.
    """
    if days is not None:
        df = filter_by_age(df, "pickup_datetime", F.localtimestamp() if as_of is None else as_of, days)
    if vendors is not None:
        df = df.filter(F.col("vendor_id").isin(*vendors))
    if passengers is not None:
        df = df.filter(F.col("passenger_count").between(*passengers))
    return df


def convert_types(df: DataFrame) -> DataFrame:
    """Both trip times to timestamp (text only; timestamps pass through) and passengers to int."""
    times = [c for c in ("pickup_datetime", "dropoff_datetime") if c in string_columns(df)]
    return df.withColumns(
        {**{c: parse_timestamp(c) for c in times}, "passenger_count": F.col("passenger_count").try_cast("int")}
    )


def try_convert(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not convert becomes NULL and is named in ``type_errors``."""
    errors = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.lit(f"{c}: not {kind}"))
        for c, kind in types.items()
    ]
    return df.withColumns(
        {**{c: F.col(c).try_cast(kind) for c, kind in types.items()}, "type_errors": F.array_compact(F.array(*errors))}
    )


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(df, column))


# Whole cleaning flows over trips


def clean_trips(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Deduplicate on the trip id, require the critical columns, check ranges, convert types."""
    unique = remove_duplicates(df, TRIP_KEY, order_by=order_by)
    return convert_types(filter_valid_trips(unique.dropna("any", subset=TRIP_REQUIRED)))


def with_copies(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order_by`` (then by the other columns), with its number of rows in ``_copies``.

    Both come out of one aggregate, reduced on the map side, so the number counts each row once however often a
    task is repeated. NULL keys are one key.
    """
    names = list(df.columns)
    order = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], *names)
    kept = df.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    return kept.select(*(f"_first.{c}" for c in names), "_copies")


def clean_data(df: DataFrame, order_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Cleaned trips and their before / after / removed counts.

    The deduplicated rows are written once to the shared folder with the sizes of their groups. Both counts come
    from these files, so they hold when tasks, or whole stages, are repeated.
    """
    unique = materialize(with_copies(df, TRIP_KEY, order_by), "unique")
    cleaned = convert_types(filter_valid_trips(unique.dropna("any", subset=TRIP_REQUIRED))).drop("_copies")
    before = unique.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    return cleaned, removal_counts(df.sparkSession, before, cleaned.count())


def removal_counts(spark, before: int, after: int) -> DataFrame:
    """One row: counts, rows removed, removal rate and success rate in percent (0 for empty input)."""
    removed = before - after
    return spark.createDataFrame(
        [(before, after, removed, 100.0 * removed / before if before else 0.0, 100.0 * after / before if before else 0.0)],
        "before_count long, after_count long, rows_removed long, removal_rate double, success_rate double",
    )


def add_trip_features(df: DataFrame) -> DataFrame:
    """Duration in minutes, hour of day, day of week (Monday 0) and weekend flag."""
    return df.withColumns(
        {
            "trip_duration_minutes": duration_minutes("pickup_datetime", "dropoff_datetime"),
            "hour_of_day": F.hour("pickup_datetime"),
            "day_of_week": day_of_week("pickup_datetime"),
            "is_weekend": is_weekend("pickup_datetime"),
        }
    )


def prepare_trips(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Deduplicate, fill missing tips with their median, require, validate, convert, derive.

    The deduplicated rows are written out once, as the median and the result both read them.
    """
    unique = materialize(remove_duplicates(df, TRIP_KEY, order_by=order_by), "unique")
    filled = handle_missing_values(unique, "median", columns=["tip_amount"])
    required = filled.dropna("any", subset=TRIP_REQUIRED)
    return add_trip_features(convert_types(filter_valid_trips(required, with_total=True)))
