"""Outlier removal by quartile range or z-score.

Bounds are one row of numbers, computed first and put into the filter as literals, so the filter
reaches the file scan and every task uses the same bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing
from ..session import materialize
from .quantiles import approximate_quantiles, exact_quantiles


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "iqr",
    threshold: float = 1.5,
    sequential: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """Keep rows inside the bounds of every column; a missing value is outside.

    ``iqr`` keeps ``q1 - t * iqr <= x <= q3 + t * iqr``; ``zscore`` keeps ``|x - mean| / std < t``.
    By default all bounds come from the input. With ``sequential`` the bounds of a column come
    from the rows that survived the columns before it. Its passes, two per column for exact quartiles and one for
    the result, read a copy that is stored once, so that a join below ``df`` is not run for each of them.
    ``accuracy`` switches the quartiles to ``percentile_approx``.
    """
    rules = {"iqr": lambda d, c: _iqr_rules(d, c, threshold, accuracy), "zscore": lambda d, c: _z_rules(d, c, threshold)}
    if method not in rules:
        raise ValueError(f"unknown method {method!r}")
    if sequential and columns:
        df = materialize(df, "outliers")
    for batch in [[c] for c in columns] if sequential else [list(columns)]:
        df = df.filter(reduce(lambda a, b: a & b, rules[method](df, batch)))
    return df


def _iqr_rules(df: DataFrame, columns: list[str], threshold: float, accuracy: int | None) -> list[Column]:
    if accuracy is None:
        quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    else:
        quartiles = approximate_quantiles(df, columns, [0.25, 0.75], accuracy=accuracy)
    by_column = {row["column"]: row["quantiles"] for row in quartiles.collect()}  # one row per column
    rules = []
    for name in columns:
        if by_column.get(name) is None:
            rules.append(F.lit(False))
            continue
        q1, q3 = by_column[name]
        spread = threshold * (q3 - q1)
        rules.append(F.col(name).cast("double").between(q1 - spread, q3 + spread))
    return rules


def _z_rules(df: DataFrame, columns: list[str], threshold: float) -> list[Column]:
    def present(name: str) -> Column:
        return F.when(~is_missing(df, name), F.col(name).cast("double"))

    moments = df.agg(
        *[F.struct(F.avg(present(c)).alias("mean"), F.stddev(present(c)).alias("std")).alias(c) for c in columns]
    ).first()
    return [
        F.abs(F.try_divide(F.col(c).cast("double") - F.lit(moments[c]["mean"]), F.lit(moments[c]["std"]))) < threshold
        for c in columns
    ]
