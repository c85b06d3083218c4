"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20


def match_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys meet; the keys of ``right`` come back as ``_r_<key>``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], how)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that keeps one copy of the keys and of other columns the two share."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    return match_rows(left, right.drop(*shared), keys, "inner").drop(*[f"_r_{k}" for k in keys])


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only after measuring that ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes as text.

    The pass stops at ``max_rows + 1``. A larger table is left to the planner, which shuffles it.
    """
    width = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df
