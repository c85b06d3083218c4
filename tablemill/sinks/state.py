"""What a stored table holds, kept beside it: a Bloom filter of its keys and its high-water mark.

The filter is a table of 4 KB bitmaps, one per bucket of key hashes, so it is built, merged and asked by ordinary
aggregations and joins and never passes through the driver. It is brought up to date from the files it has not
seen, so loads by other means are noticed; after files went away, or beyond twice its capacity, it is built anew.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..session import scratch_path

PROPERTY = "load.state"
BITMAP, PROBES, BITS_PER_KEY = 1 << 15, 4, 12


@dataclass
class TableState:
    keys: list[str]
    modified: str | None
    buckets: int
    rows: int
    path: str

    def bitmaps(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/bitmaps")

    def mark(self, spark: SparkSession) -> object:
        """The largest mark of the table, None without any."""
        return spark.read.parquet(f"{self.path}/mark").agg(F.max("mark")).first()[0]


def _key_hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *(F.col(k) for k in keys), *(F.col(k).isNull() for k in keys))


def _places(keys: Sequence[str], buckets: int) -> tuple[Column, Column]:
    """Bucket of a key and its bits there."""
    bits = F.array(*(F.pmod(F.shiftrightunsigned(_key_hash(keys, 1), 15 * i), F.lit(BITMAP)) for i in range(PROBES)))
    return F.pmod(_key_hash(keys, 0), F.lit(buckets)).cast("long"), bits


def key_bitmaps(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``bucket, bitmap`` over all keys of ``rows``; NULL keys count as one."""
    bucket, bits = _places(keys, buckets)
    placed = rows.select(bucket.alias("bucket"), F.explode(bits).alias("bit"))
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def maybe_stored(rows: DataFrame, bitmaps: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``rows`` with ``_maybe``: false only where no stored row has the key."""
    bucket, bits = _places(keys, buckets)
    asked = rows.withColumns({"_bucket": bucket, "_bits": bits})
    joined = asked.join(broadcast_if_small(bitmaps), F.col("_bucket") == F.col("bucket"), "left")

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1

    found = F.col("bitmap").isNotNull() & F.forall("_bits", is_set)
    return joined.withColumn("_maybe", F.coalesce(found, F.lit(False))).drop("_bucket", "_bits", "bucket", "bitmap")


def set_property(spark: SparkSession, table: str, name: str, value: object) -> None:
    text = json.dumps(value).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{text}')")


def property_of(spark: SparkSession, table: str, name: str) -> object:
    """The value that ``set_property`` stored, None without one."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return json.loads(found[name]) if name in found else None


def _covered_files(spark: SparkSession, state: TableState) -> set[str] | None:
    try:
        return {r["path"] for r in spark.read.parquet(f"{state.path}/files").toLocalIterator()}
    except AnalysisException:  # the folder is gone
        return None


def table_state(spark: SparkSession, table: str, keys: Sequence[str], modified: str | None = None) -> TableState:
    """The state of ``table``, up to date with its files. Reads the key and mark columns of files not seen before."""
    spark.catalog.refreshTable(table)
    target = spark.table(table)
    files = set(target.inputFiles())
    stored = property_of(spark, table, PROPERTY)
    old = TableState(**stored) if stored else None
    seen = _covered_files(spark, old) if old and (old.keys, old.modified) == (list(keys), modified) else None
    if seen is not None and seen == files:
        return old
    merged = seen is not None and seen < files
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "file:///")  # as inputFiles writes it
    rows = target.where(path.isin(sorted(files - seen))) if merged else target
    total = rows.count() + (old.rows if merged else 0)
    if merged and total * BITS_PER_KEY > old.buckets * BITMAP:
        merged, rows = False, target
    buckets = old.buckets if merged else max(1, math.ceil(2 * total * BITS_PER_KEY / BITMAP))
    state = TableState(list(keys), modified, buckets, total, scratch_path(spark, "load-state"))
    bitmaps = key_bitmaps(rows, keys, buckets)
    marks = rows.select((F.max(modified) if modified else F.lit(None).cast("int")).alias("mark"))
    if merged:
        bitmaps = bitmaps.unionByName(old.bitmaps(spark)).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        marks = marks.unionByName(spark.read.parquet(f"{old.path}/mark"))
    bitmaps.write.parquet(f"{state.path}/bitmaps")
    marks.agg(F.max("mark").alias("mark")).write.parquet(f"{state.path}/mark")
    spark.createDataFrame([(f,) for f in sorted(files)], "path string").write.parquet(f"{state.path}/files")
    set_property(spark, table, PROPERTY, state.__dict__)
    return state
