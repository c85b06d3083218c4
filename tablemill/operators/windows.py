"""Ordered features within a partition: lag, lead, row number, rank, forward fill, rolling average.

A plain window sorts each partition in one task. Partitions above ``hot_rows`` are therefore put in order by
Spark's range partitioner over their keys and all order columns, and cut into chunks at real values (``in_chunks``),
of ``hot_rows`` rows or, where these would make needlessly many tasks, of more.
Each chunk runs its own window, and one row per chunk carries the offset, or the value at the border, over to the
next. Rows with equal order values share a chunk, so ranks stay right.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_missing, present
from ..session import pin
from .joins import join_on, match_rows
from .ordering import chunk_borders, in_chunks

HOT_ROWS = 10_000_000  # rows of one partition that one task may sort

# Output names.
SUFFIXES = {"lag": "lag1", "lead": "lead1", "row_number": "row_num", "rank": "rank"}


def create_window_features(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: Sequence[str],
    functions: Mapping[str, str | Sequence[str]],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``{col}_lag1``, ``{col}_lead1``, ``{col}_row_num`` or ``{col}_rank``, ascending.

    ``functions`` maps a column to one function or several. End ``order_cols`` with a unique
    column to make lag, lead and row number repeatable.
    """
    wanted = [(c, f) for c, fs in functions.items() for f in ([fs] if isinstance(fs, str) else fs)]
    for _, name in wanted:
        if name not in SUFFIXES:
            raise ValueError(f"unknown window function {name!r}")

    def plain(part: DataFrame, keys: list[str]) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order_cols)
        return part.withColumns({f"{c}_{SUFFIXES[f]}": _ranked(c, f, window) for c, f in wanted})

    def chunked(part: DataFrame, keys: list[str]) -> DataFrame:
        row = F.struct(*[F.col(c) for c in functions])
        chunks = Window.partitionBy(*keys).orderBy("_chunk")
        borders = chunk_borders(part, keys, row, row)
        borders = borders.withColumns({"_previous": F.lag("_last").over(chunks), "_next": F.lead("_first").over(chunks)})
        rows = join_on(part, pin(borders.drop("_first", "_last"), "chunk-borders"), [*keys, "_chunk"])
        within = Window.partitionBy(*keys, "_chunk")
        number = F.col("_place") - F.col("_start")

        def stitched(column: str, name: str) -> Column:
            if name == "row_number":
                return F.col("_offset") + number + 1
            if name == "rank":
                return F.col("_offset") + F.rank().over(within.orderBy(*order_cols))
            if name == "lag":
                local = F.lag(column).over(within.orderBy("_place"))
                return F.when(number == 0, F.col("_previous")[column]).otherwise(local)
            local = F.lead(column).over(within.orderBy("_place"))
            return F.when(number == F.col("_rows") - 1, F.col("_next")[column]).otherwise(local)

        return rows.withColumns({f"{c}_{SUFFIXES[f]}": stitched(c, f) for c, f in wanted})

    output = [*df.columns, *[f"{c}_{SUFFIXES[f]}" for c, f in wanted]]
    return _run(df, partition_cols, order_cols, hot_rows, plain, chunked).select(*output)


def forward_fill(
    df: DataFrame,
    order_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Replace a missing cell by the last value before it, per partition or over the whole table."""
    fixed = {*partition_cols, *order_cols}
    names = [c for c in (columns or df.columns) if c not in fixed]

    def present(name: str) -> Column:
        return F.when(~is_missing(df, name), F.col(name))

    def plain(part: DataFrame, keys: list[str]) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return part.withColumns({c: F.last(present(c), ignorenulls=True).over(window) for c in names})

    def chunked(part: DataFrame, keys: list[str]) -> DataFrame:
        last = part.groupBy(*keys, "_chunk").agg(
            *[F.max_by(c, F.when(~is_missing(df, c), F.col("_place"))).alias(f"_carry_{c}") for c in names]
        )
        before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        carried = last.withColumns(
            {f"_carry_{c}": F.last(f"_carry_{c}", ignorenulls=True).over(before) for c in names}
        )
        window = Window.partitionBy(*keys, "_chunk").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
        filled = part.withColumns({c: F.last(present(c), ignorenulls=True).over(window) for c in names})
        filled = join_on(filled, pin(carried, "chunk-borders"), [*keys, "_chunk"])
        return filled.withColumns({c: F.coalesce(c, f"_carry_{c}") for c in names})

    return _run(df, partition_cols, order_cols, hot_rows, plain, chunked).select(*df.columns)


def rolling_average(
    df: DataFrame,
    column: str,
    partition_cols: Sequence[str],
    order_cols: Sequence[str],
    preceding: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``{column}_rolling_avg`` over the current row and ``preceding`` rows before it.

    In a hot partition rows are numbered by their chunks and places and form blocks of equal size; each
    block also receives the last ``preceding`` rows of the block before it.
    """
    output = f"{column}_rolling_avg"

    def plain(part: DataFrame, keys: list[str]) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(-preceding, 0)
        return part.withColumn(output, F.avg(present(part, column)).over(window))

    def chunked(part: DataFrame, keys: list[str]) -> DataFrame:
        size = max(hot_rows, preceding, 1)
        numbered = join_on(part, pin(chunk_borders(part, keys), "chunk-borders"), [*keys, "_chunk"])
        numbered = numbered.withColumn("_number", F.col("_offset") + F.col("_place") - F.col("_start"))
        at = F.col("_number")
        block = F.floor(at / size)
        copies = F.when(at % size >= size - preceding, F.array(block, block + 1)).otherwise(F.array(block))
        spread = numbered.withColumns({"_home": block, "_block": copies}).withColumn("_block", F.explode("_block"))
        window = Window.partitionBy(*keys, "_block").orderBy("_number").rowsBetween(-preceding, 0)
        return spread.withColumn(output, F.avg(present(spread, column)).over(window)).filter("_home = _block")

    return _run(df, partition_cols, order_cols, hot_rows, plain, chunked).select(*df.columns, output)


def _ranked(column: str, name: str, window) -> Column:
    if name == "lag":
        return F.lag(column).over(window)
    if name == "lead":
        return F.lead(column).over(window)
    number = F.row_number() if name == "row_number" else F.rank()
    return number.over(window).cast("long")  # a hot partition may hold more rows than an int counts


def _run(df, partition_cols, order_cols, hot_rows, plain, chunked) -> DataFrame:
    """Apply ``plain`` to ordinary partitions and ``chunked`` to those above ``hot_rows``."""
    keys = list(partition_cols)
    if not keys:
        keys = ["_all"]
        df = df.withColumn("_all", F.lit(0))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = pin(sizes.filter(F.col("_n") > hot_rows), "hot-partitions")
    total = hot.agg(F.sum("_n")).first()[0]
    if total is None:
        return plain(df, keys)
    hot = hot.drop("_n")
    rows = match_rows(df, hot, keys, "left_semi")
    part = in_chunks(rows, [*keys, *(c for c in order_cols if c not in keys)], total, hot_rows, "chunks")
    result = chunked(part, keys)
    if keys == ["_all"]:
        return result
    cold = plain(match_rows(df, hot, keys, "left_anti"), keys)
    return cold.unionByName(result.select(*cold.columns))
