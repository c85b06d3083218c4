"""Exact quantiles that never hold one group's values in one task. The input is read twice.

The first read makes one small sketch per column and group, without a row per cell. It brackets each wanted quantile
of a large group. The second read counts the distinct values inside the brackets and collapses all others to one
count per gap on the map side. What is left is stored, put in order by ranges of real values, and ranked chunk by
chunk; the sketch steers the work, it never decides a result. Groups of a counted, bounded size keep all their
values, which go to ``percentile`` with their counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, pin
from .joins import join_on, match_rows
from .ordering import in_chunks

SKETCH_K = 4096  # rank error about 0.13 % of the rows
MARGIN = 0.005  # half width of a bracket, as a fraction of the rows
SMALL_GROUP = 100_000  # values of a group that one task may hold
CHUNK = 1_000_000  # distinct values that one task ranks
SALTS = 256  # partial sketches per group before the last merge


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    group_cols: Sequence[str] = (),
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Interpolated quantiles as rows ``(*group_cols, column, n, quantiles)``.

    ``quantiles`` follows the order of ``probabilities``. Missing values do not count; a group
    without values gets NULL. Jobs run at once: the counted values are stored in the shared folder.
    """
    probabilities = [float(p) for p in probabilities]
    keys = [*group_cols, "column"]
    brackets = _brackets(df, columns, probabilities, list(group_cols), small_group)
    counts = materialize(_value_counts(df, columns, list(group_cols), brackets), "value-counts")
    small = counts.filter("n IS NULL").groupBy(*keys).agg(
        F.sum(F.when(F.col("_value").isNotNull(), F.col("_count")).otherwise(0)).alias("n"),
        F.percentile("_value", probabilities, F.col("_count")).alias("quantiles"),
    )
    if brackets.isEmpty():
        return small
    large = counts.filter("n IS NOT NULL AND _segment IS NOT NULL")
    return _interpolate(_values_at_ranks(large, keys, probabilities), keys, probabilities).unionByName(small)


def approximate_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    group_cols: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Same shape as ``exact_quantiles``, from one pass with a rank error of ``1 / accuracy``."""
    values = _long_form(df, columns, group_cols)
    return values.groupBy(*group_cols, "column").agg(
        F.count("_value").alias("n"),
        F.percentile_approx("_value", list(probabilities), accuracy).alias("quantiles"),
    )


def _long_form(df: DataFrame, columns: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """One row per cell, NULL where the cell is missing."""

    cells = F.array(*[F.struct(F.lit(c).alias("column"), _present(c).alias("_value")) for c in columns])
    return df.select(*group_cols, F.inline(cells))


def _present(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _brackets(df: DataFrame, columns: Sequence[str], probabilities: list[float], group_cols: list[str], small_group: int) -> DataFrame:
    """``(*group_cols, column, n, lows, highs)`` of the large groups: values surely at or around each rank.

    Sketches merge in two steps, so that the last task of a large group reads ``SALTS`` of them
    and not one per input split.
    """
    fields = ("n", "low", "high", "sketch")
    partial = [
        F.struct(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("sketch")).alias(f"_{i}")
        for i, v in enumerate(map(_present, columns))
    ]
    salted = df.groupBy(*group_cols, (F.spark_partition_id() % SALTS).alias("_salt")).agg(*partial)
    merge = (F.sum, F.min, F.max, lambda c: F.kll_merge_agg_double(c, F.lit(SKETCH_K)))
    merged = [
        F.struct(F.lit(name).alias("column"), *(by(F.col(f"_{i}.{f}")).alias(f) for by, f in zip(merge, fields))).alias(f"_{i}")
        for i, name in enumerate(columns)
    ]
    rows = salted.groupBy(*group_cols).agg(*merged).select(*group_cols, F.inline(F.array(*(f"_{i}" for i in range(len(columns))))))

    def at(rank: float, edge: str) -> Column:
        if rank <= 0 or rank >= 1:
            return F.col(edge)
        wide = F.col("n") * MARGIN >= 5  # room for both neighbours of the quantile
        return F.when(wide, F.kll_sketch_get_quantile_double("sketch", F.lit(rank))).otherwise(F.col(edge))

    ordered = sorted(probabilities)
    large = rows.filter(F.col("n") > small_group).select(
        *group_cols,
        "column",
        "n",
        F.array(*[at(p - MARGIN, "low") for p in ordered]).alias("lows"),
        F.array(*[at(p + MARGIN, "high") for p in ordered]).alias("highs"),
    )
    if group_cols:
        return pin(large, "brackets")
    return df.sparkSession.createDataFrame(large.collect(), large.schema)  # a row per column


def _value_counts(df: DataFrame, columns: Sequence[str], group_cols: list[str], brackets: DataFrame) -> DataFrame:
    """Counts per distinct value of small groups (``n`` NULL) and inside brackets, and one count per gap between them.

    ``_segment`` rises with the value: it adds the brackets begun and the brackets ended. The two
    are equal exactly in a gap, where the value itself is dropped.
    """
    keys = [*group_cols, "column"]
    values = _long_form(df, columns, group_cols)
    if group_cols:
        joined = match_rows(values, brackets, keys, "left").drop(*(f"_r_{k}" for k in keys))
    else:  # the brackets of a few columns are literals
        found = {row["column"]: row for row in brackets.collect()}
        parts = {name: brackets.schema[name].dataType for name in ("n", "lows", "highs")}

        def known(part: str) -> Column:
            whens = [F.when(F.col("column") == c, _literal(row[part])) for c, row in found.items()]
            return F.coalesce(*whens, F.lit(None)).cast(parts[part])

        joined = values.withColumns({part: known(part) for part in parts})
    value = F.col("_value")
    begun = F.size(F.filter("lows", lambda low: low <= value))
    ended = F.size(F.filter("highs", lambda high: high < value))
    located = joined.withColumns({"_begun": begun, "_ended": ended})
    segment = F.when(F.col("n").isNotNull() & value.isNotNull(), F.col("_begun") + F.col("_ended"))
    kept = F.when(F.col("n").isNull() | (F.col("_begun") > F.col("_ended")), value)
    return located.select(*keys, "n", segment.alias("_segment"), kept.alias("_value")).groupBy(*keys, "n", "_segment", "_value").agg(
        F.count(F.lit(1)).alias("_count")
    )


def _literal(value: object) -> Column:
    return F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)


def _values_at_ranks(counts: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """``(*keys, n, _rank, _value)`` for the order statistics on both sides of each quantile."""
    chunks = in_chunks(counts, [*keys, "n", "_segment", "_value"], counts.count(), CHUNK, "ranked-values")
    totals = chunks.groupBy(*keys, "n", "_chunk").agg(F.sum("_count").alias("_in_chunk"))
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    position = [F.lit(p) * (F.col("n") - 1) for p in sorted(set(probabilities))]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") + 1 for p in position for f in (F.floor, F.ceil)]))
    targets = (
        totals.withColumn("_upto", F.sum("_in_chunk").over(by_chunk))
        .withColumn("_rank", F.explode(ranks))
        .filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_in_chunk")))
        .select(*keys, "_chunk", "_rank", (F.col("_upto") - F.col("_in_chunk")).alias("_before"))
    )
    hits = join_on(chunks, targets, [*keys, "_chunk"])
    by_value = Window.partitionBy(*keys, "_chunk", "_rank").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    reached = hits.withColumn("_upto", F.col("_before") + F.sum("_count").over(by_value))
    found = reached.filter(
        (F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_count"))
    )
    missed = F.raise_error(F.lit("quantile outside its bracket"))
    return found.withColumn("_value", F.when(F.col("_value").isNull(), missed).otherwise(F.col("_value")))


def _interpolate(found: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    at_rank = found.groupBy(*keys, "n").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at")  # two entries per probability
    )

    def quantile(p: float):
        position = F.lit(p) * (F.col("n") - 1)
        below = F.col("_at")[F.floor(position).cast("long") + 1]
        above = F.col("_at")[F.ceil(position).cast("long") + 1]
        # As the built-in percentile weighs them; equal neighbours, infinities too, are taken as they are.
        weighted = (F.ceil(position) - position) * below + (position - F.floor(position)) * above
        return F.when(below == above, below).otherwise(weighted)

    return at_rank.select(*keys, "n", F.array(*[quantile(p) for p in probabilities]).alias("quantiles"))
