"""Comparison of two tables by hashes of their rows, without shuffling the rows themselves.

Every row gets two independent 64-bit hashes. The first one deals rows into buckets, whose counts and sums of both
hashes are combined before the shuffle, so two tables meet as one small row per bucket. Only the rows of buckets
that differ are looked at again: their hashes are counted, and the rows of differing hashes are fetched last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import broadcast_if_small, join_on
from ..session import materialize

BUCKET_BITS = 16
HASHES = ["_h0", "_h1"]
LEAF = ["rows", "s0", "s1"]


def _normal(name: str, kind: T.DataType) -> Column:
    """The column with one zero, as 0.0 and -0.0 are equal."""
    column = F.col(f"`{name}`")
    return column + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else column


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row that depend on neither row nor column order, and notice which cells are NULL."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    values = [_normal(f.name, f.dataType) for f in fields]
    flags = [v.isNull() for v in values]  # the hash itself skips NULLs
    return F.xxhash64(*values, *flags), F.xxhash64(F.lit(1), *flags[::-1], *values[::-1])


def _sums(*hashes: Column) -> list[Column]:
    """A sum, unlike an exclusive or, notices rows that were repeated."""
    return [F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for h in hashes]


def checksum(df: DataFrame) -> DataFrame:
    """Row count and a sum of row hashes, both independent of row order."""
    first, _ = row_hashes(df)
    return df.agg(F.count(F.lit(1)).alias("row_count"), _sums(first)[0].alias("checksum"))


def hash_tree(df: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """Leaves of the tree: ``_bucket`` (first bits of the hash), ``rows`` and the sums ``s0``, ``s1`` of the hashes."""
    first, second = row_hashes(df)
    hashed = df.select(first.alias("_h0"), second.alias("_h1"))
    leaves = hashed.groupBy(F.shiftrightunsigned("_h0", 64 - bits).alias("_bucket"))
    sums = [s.alias(f"s{i}") for i, s in enumerate(_sums(F.col("_h0"), F.col("_h1")))]
    return leaves.agg(F.count(F.lit(1)).alias("rows"), *sums)


def compare_trees(left: DataFrame, right: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """The leaves of both trees side by side, written once to the shared folder: at most ``2 ** bits`` rows."""
    sides = {"l": hash_tree(left, bits), "r": hash_tree(right, bits)}
    marked = [tree.select("_bucket", *(F.col(c).alias(f"{side}_{c}") for c in LEAF)) for side, tree in sides.items()]
    both = marked[0].unionByName(marked[1], allowMissingColumns=True).groupBy("_bucket")
    return materialize(both.agg(*(F.coalesce(F.max(f"{s}_{c}"), F.lit(0)).alias(f"{s}_{c}") for s in sides for c in LEAF)), "leaves")


def differing_hashes(left: DataFrame, right: DataFrame, leaves: DataFrame | None = None, bits: int = BUCKET_BITS) -> DataFrame:
    """``_h0, _h1`` of the rows whose number of copies differs, with ``left_rows`` and ``right_rows``.

    ``leaves`` is a stored ``compare_trees(left, right, bits)``. Runs jobs at once.
    """
    leaves = compare_trees(left, right, bits) if leaves is None else leaves
    unequal = leaves.where(" OR ".join(f"l_{c} <> r_{c}" for c in LEAF)).select("_bucket")
    buckets = broadcast_if_small(unequal, max_rows=1 << bits)

    def hashes(df: DataFrame, one: str) -> DataFrame:
        first, second = row_hashes(df)
        counts = {c: F.lit(int(c == one)).cast("long") for c in ("left_rows", "right_rows")}
        hashed = df.select(first.alias("_h0"), second.alias("_h1")).withColumns(counts)
        return hashed.join(buckets, F.shiftrightunsigned("_h0", 64 - bits) == F.col("_bucket"), "left_semi")

    both = hashes(left, "left_rows").unionByName(hashes(right, "right_rows"))
    counted = both.groupBy(*HASHES).agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
    return counted.where("left_rows <> right_rows")


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between two tables, with both numbers.

    Rows are compared by 128 bits of hash; only the differing ones travel. Runs jobs at once.
    """
    names = left.columns
    found = materialize(differing_hashes(left, right), "differences")
    wanted = broadcast_if_small(found)

    def rows(df: DataFrame) -> DataFrame:
        first, second = row_hashes(df)
        return join_on(df.select(*names).withColumns({"_h0": first, "_h1": second}), wanted, HASHES)

    # The first row of equal ones stands for them; both sides may hold it.
    both = rows(left).unionByName(rows(right))
    return both.groupBy(*HASHES, "left_rows", "right_rows").agg(*(F.first(f"`{c}`").alias(c) for c in names)).select(*names, "left_rows", "right_rows")


def post_load_checks(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts, whether the checksums agree, and how many distinct rows differ. Runs jobs at once."""
    target = target.select(*source.columns)
    leaves = compare_trees(source, target)
    different = differing_hashes(source, target, leaves).agg(F.count(F.lit(1)).alias("different_rows"))
    total = lambda column: F.coalesce(F.sum(column), F.lit(0).cast("long"))
    totals = leaves.agg(
        total("l_rows").alias("source_rows"),
        total("r_rows").alias("target_rows"),
        *(_sums(F.col(f"l_{c}") - F.col(f"r_{c}"))[0].alias(c) for c in ("s0", "s1")),
    )
    return totals.select(
        "source_rows",
        "target_rows",
        (F.col("source_rows") == F.col("target_rows")).alias("counts_match"),
        ((F.col("s0") == 0) & (F.col("s1") == 0)).alias("checksums_match"),
        different.scalar().alias("different_rows"),
    )
