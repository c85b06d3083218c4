"""A table in order, spread over tasks by real values of its order columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PLACES = 33  # low bits of monotonically_increasing_id
TASKS = 200  # chunks of fewer than LARGE rows that one table is cut into
LARGE = 1_000_000  # rows that are worth a task of their own, however many tasks there are


def in_chunks(df: DataFrame, order: Sequence[str | Column], rows: int, chunk_rows: int, label: str = "ordered") -> DataFrame:
    """``df`` with ``_chunk`` and ``_place``: chunks follow one another along ``order``, places count from 0 in a chunk.

    Spark's range partitioner picks the borders from sampled values of the whole order tuple, so any type and
    collation that Spark can sort may be used, and rows that agree in every order column share a chunk. About
    ``chunk_rows`` of the ``rows`` rows go to each. A chunk is a task and a file, and the borders of all chunks are
    known to every task, so a small ``chunk_rows`` is raised until ``TASKS`` chunks, or chunks of ``LARGE`` rows, hold
    the table; beyond that there is no limit to their number. The result is written to the shared folder: every
    later step, and every repeated task, sees the same chunks.
    """
    wanted = max(1, chunk_rows, min(LARGE, math.ceil(rows / TASKS)))
    chunks = max(1, math.ceil(rows / wanted))
    ordered = df.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    stored = materialize(ordered.withColumn("_chunk", F.monotonically_increasing_id()), label)
    place = F.col("_chunk").bitwiseAND((1 << PLACES) - 1)
    return stored.withColumns({"_place": place, "_chunk": F.shiftright("_chunk", PLACES).cast("int")})


def chunk_borders(chunks: DataFrame, keys: Sequence[str], first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Per key and chunk its ``_rows``, first place ``_start``, and the rows of the key before it, ``_offset``.

    ``first`` and ``last`` name what is taken from the first and the last row.
    """
    values = {"_first": (F.min_by, first), "_last": (F.max_by, last)}
    taken = [by(value, "_place").alias(name) for name, (by, value) in values.items() if value is not None]
    borders = chunks.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_start"), *taken)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return borders.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("long")))
