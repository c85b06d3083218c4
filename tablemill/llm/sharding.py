"""Sharding by extendible hashing.

A directory is indexed by leading bits of a hash of the key. Only a bucket whose bytes exceed the limit is
split, on its next bit, until every bucket fits. Bytes are summed per directory cell first, and splits are
decided on the cells; a cell that is still too large is read again with more bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Bits of the key's hash, and of the row number drawn for rows that share a hash.
KEY_BITS, ROW_BITS = 60, 60
# Bits that one pass adds to the directory, at most.
STEP = 18


def _bits(start: int, width: int) -> Column:
    """``width`` bits from bit ``start`` of key hash and row number together."""
    parts = []
    for name, low, size in (("_hash", 0, KEY_BITS), ("_row", KEY_BITS, ROW_BITS)):
        first, last = max(start, low), min(start + width, low + size)
        if first < last:
            taken = F.shiftright(F.col(name), low + size - last).bitwiseAND((1 << (last - first)) - 1)
            parts.append(F.shiftleft(taken, start + width - last))
    return parts[0] if len(parts) == 1 else parts[0].bitwiseOR(parts[1])


def _width(n_bytes: int, limit: int) -> int:
    """Bits for a pass over cells of at most ``n_bytes``: shards of the limit, and 4 more for uneven ones."""
    return max(1, min(STEP, math.ceil(math.log2(max(1.0, n_bytes / limit))) + 4))


def shard_documents(docs: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, depth, prefix, row_prefix, shard_docs, shard_bytes`` for each row of ``docs``.

    A shard is named by its ``depth`` and leading bits: ``prefix`` has those of the key's hash (60 at most).
    Rows that share a hash, as repeated rows do, are split by a number stored with each row, whose bits are
    ``row_prefix``. Every shard has at most ``limit`` bytes of UTF-8 text, save that a single larger document
    is a shard of its own. Null and empty texts have 0 bytes, a null key is hashed as empty text; other
    columns are ignored; an empty table gives an empty result. The first pass stores ids, hashes and sizes.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long").alias("_hash"),
        (F.rand(4) * (1 << 52)).cast("long").bitwiseAND((1 << 52) - 1).alias("_row"),
    )
    narrow = narrow.withColumn("_row", F.shiftleft("_row", ROW_BITS - 52).bitwiseOR(F.col("_row").bitwiseAND(255)))
    open_rows = materialize(narrow, "sizes")
    total = open_rows.agg(F.sum("n_bytes")).first()[0] or 0
    width = _width(total, limit)
    start, path, done = 0, [], []
    while start < KEY_BITS + ROW_BITS:
        width = min(width, KEY_BITS + ROW_BITS - start)
        cell = f"_c{start}"
        open_rows = open_rows.withColumn(cell, _bits(start, width))
        cells = open_rows.groupBy(*path, cell).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        # The cell's ancestors: itself without its last 0, 1, ... bits.
        up = cells.withColumn("_up", F.explode(F.sequence(F.lit(0), F.lit(width))))
        sums = up.withColumn("_top", F.expr(f"shiftright({cell}, _up)"))
        buckets = sums.groupBy(*path, "_up", "_top").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        last = start + width == KEY_BITS + ROW_BITS
        fits = buckets.where((F.col("b") <= limit) | (F.col("n") == 1) | (F.lit(last) & (F.col("_up") == 0)))
        on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*path, "_up", "_top"]]
        placed = sums.select(*path, cell, "_up", "_top").alias("l").join(fits.alias("r"), on)
        shard = placed.groupBy(*(F.col(f"l.{c}").alias(c) for c in [*path, cell])).agg(
            F.max_by(F.struct(F.col("r._up").alias("up"), F.col("r.b").alias("b"), F.col("r.n").alias("n")), F.col("r._up")).alias("shard")
        )
        shard = materialize(shard, "directory")
        joined = open_rows.join(shard, [*path, cell], "left")
        depth = F.lit(start + width) - F.col("shard.up")
        done.append(
            joined.where(F.col("shard").isNotNull()).select(
                "doc_id", "n_bytes", depth.cast("int").alias("depth"),
                F.expr(f"shiftright(_hash, greatest(0, {KEY_BITS} - {start + width} + shard.up))").alias("prefix"),
                F.expr(f"case when {start + width} - shard.up > {KEY_BITS} then shiftright(_row, cast({KEY_BITS + ROW_BITS - start - width} + shard.up as int)) else 0 end").cast("long").alias("row_prefix"),
                F.col("shard.n").alias("shard_docs"), F.col("shard.b").alias("shard_bytes"),
            )
        )
        open_rows, path, start = materialize(joined.where(F.col("shard").isNull()).drop("shard"), "open"), [*path, cell], start + width
        heaps = open_rows.groupBy(*path).agg(F.sum("n_bytes").alias("b"), (F.min("_hash") < F.max("_hash")).cast("int").alias("mixed"))
        largest, mixed = heaps.agg(F.max("b"), F.max("mixed")).first()
        if largest is None:
            break
        # Bits that the largest open cell needs; cells of one hash each differ in the row numbers only.
        width = _width(largest, limit)
        start = start if mixed else max(start, KEY_BITS)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
