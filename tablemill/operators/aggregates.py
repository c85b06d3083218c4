"""Grouped aggregates, pivots, counts, histograms and column statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing, numeric_columns, present
from ..session import pin
from .joins import join_on
from .quantiles import approximate_quantiles, exact_quantiles

AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev,
    "std": F.stddev,
    "variance": F.variance,
    "var": F.variance,
}


def simple_aggregation(
    df: DataFrame, group_cols: Sequence[str], agg_specs: Mapping[str, str | Sequence[str]]
) -> DataFrame:
    """Aggregates named ``{column}_{function}``; missing group keys form a group of their own."""
    wanted = [(c, f) for c, fs in agg_specs.items() for f in ([fs] if isinstance(fs, str) else fs)]
    unknown = {f for _, f in wanted} - set(AGGREGATES)
    if unknown:
        raise ValueError(f"unknown aggregates {sorted(unknown)}")
    return df.groupBy(*group_cols).agg(
        *[AGGREGATES[f](F.when(~is_missing(df, c), F.col(c))).alias(f"{c}_{f}") for c, f in wanted]
    )


def percentile_aggregation(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    percentiles: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int | None = None,
) -> DataFrame:
    """Columns ``p25``, ``p50``, …: exact and interpolated, or approximate when ``accuracy`` is given."""
    if accuracy is None:
        found = exact_quantiles(df, [value_col], percentiles, group_cols)
    else:
        found = approximate_quantiles(df, [value_col], percentiles, group_cols, accuracy)
    named = [F.col("quantiles")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(percentiles)]
    return found.select(*group_cols, *named)


def pivot_aggregation(
    df: DataFrame,
    group_cols: Sequence[str],
    pivot_col: str,
    value_col: str,
    agg_func: str = "sum",
    values: Sequence[object] | None = None,
) -> DataFrame:
    """One column per value of ``pivot_col``; an unknown function means ``sum``.

    Listing the ``values`` saves the job that looks them up; without them Spark refuses more than 10,000 columns.
    """
    aggregate = AGGREGATES[agg_func if agg_func in ("sum", "avg", "count", "min", "max") else "sum"]
    return df.groupBy(*group_cols).pivot(pivot_col, list(values) if values else None).agg(aggregate(present(df, value_col)))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[object] | None = None) -> DataFrame:
    """Counts per pair of keys, 0 where a pair does not occur; rows with a missing key are left out."""
    present = df.filter(~is_missing(df, rows) & ~is_missing(df, columns))
    table = present.groupBy(rows).pivot(columns, list(values) if values else None).count()
    return table.fillna(0, subset=[c for c in table.columns if c != rows])


def value_counts(df: DataFrame, columns: str | Sequence[str], by_key: bool = False) -> DataFrame:
    """Rows per key, most frequent first or in key order; missing keys are left out."""
    names = [columns] if isinstance(columns, str) else list(columns)
    for name in names:
        df = df.filter(~is_missing(df, name))
    order = names if by_key else [F.desc("n"), *names]
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*order)


def grouped_measure(
    df: DataFrame, key: str, value: str, function: str, name: str, by_key: bool = False
) -> DataFrame:
    """One aggregate per key, largest first or in key order; missing keys are left out."""
    measured = df.filter(~is_missing(df, key)).groupBy(key).agg(AGGREGATES[function](present(df, value)).alias(name))
    return measured.orderBy(*([key] if by_key else [F.desc_nulls_last(name), key]))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins over [min, max], empty ones included; the last bin is closed."""
    return histogram_by_group(df, column, [], bins)


def histogram_by_group(df: DataFrame, column: str, group_cols: Sequence[str], bins: int = 30) -> DataFrame:
    """As ``histogram``, with the range taken within each group; missing group keys are left out."""
    values = df.filter(~is_missing(df, column))
    for name in group_cols:
        values = values.filter(~is_missing(values, name))
    values = values.select(*group_cols, F.col(column).cast("double").alias("_value"))
    spans = values.groupBy(*group_cols).agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    spans = pin(spans.filter("_low IS NOT NULL"), "spans")
    width = (F.col("_high") - F.col("_low")) / bins

    placed = _with_spans(values, spans, group_cols).select(*group_cols, bin_number(F.col("_value"), F.col("_low"), width, bins).alias("bin"))
    counts = placed.groupBy(*group_cols, "bin").agg(F.count(F.lit(1)).alias("_n"))
    every_bin = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every_bin.join(counts, [*group_cols, "bin"], "left").select(
        *group_cols,
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def bin_number(value: Column, low: Column, width: Column, bins: int) -> Column:
    """The bin of a value, from 0; the last one is closed, and NULL has none."""
    position = F.coalesce(F.try_divide(value - low, width), F.lit(0.0))
    return F.when(value.isNotNull(), F.least(F.floor(position), F.lit(bins - 1)).cast("int"))


def _with_spans(values: DataFrame, spans: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    if group_cols:
        return join_on(values, spans, group_cols)
    span = spans.first()  # the single row of a global range
    low, high = (span["_low"], span["_high"]) if span else (None, None)
    return values.withColumns({"_low": F.lit(low).cast("double"), "_high": F.lit(high).cast("double")})


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, sample stddev, min, max, as typed columns."""
    return _describe(df, list(columns or numeric_columns(df)))


def describe_quartiles(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``describe`` plus interpolated 25 %, 50 % and 75 % quantiles."""
    names = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75]).select(
        "column", *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q25", "q50", "q75"))]
    )
    return _describe(df, names).join(quartiles, "column", "left")


def _describe(df: DataFrame, names: list[str]) -> DataFrame:
    def summary(name: str) -> Column:
        value = F.when(~is_missing(df, name), F.col(name).cast("double"))
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    return df.agg(F.array(*[summary(c) for c in names]).alias("_all")).select(F.inline("_all"))


def sort_limit(df: DataFrame, sort_by: str, unique: str, rows: int = 50, ascending: bool = True) -> DataFrame:
    """First rows in order of one column, missing values last, ties broken by ``unique``."""
    order = F.asc_nulls_last(sort_by) if ascending else F.desc_nulls_last(sort_by)
    return df.orderBy(order, F.asc(unique)).limit(rows)


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)


def append_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """All rows of both tables, matched by column name; absent columns become NULL."""
    return df.unionByName(other, allowMissingColumns=True)
