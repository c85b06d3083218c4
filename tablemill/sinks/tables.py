"""Full, incremental and upsert loads into catalog tables, their checks, and the JDBC sink."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import broadcast_if_small, match_rows
from ..session import materialize, observed_rows
from .checks import checksum, post_load_checks, row_differences
from .state import maybe_stored, property_of, set_property, table_state

__all__ = [
    "checksum", "create_table_sql", "incremental_load", "incremental_rows", "keyed_table", "load_dataframe", "one_per_key", "post_load_checks",
    "row_differences", "sql_type", "text_types", "upsert_load", "upsert_partitions", "upsert_rows", "verified_columns", "verify_load", "write_jdbc",
]

MODES = ("overwrite", "append")
KEYED = "load.keyed"

LOAD_STATS = (
    "timestamp string, table_name string, mode string, status string, input_row_count long, "
    "output_row_count long, verified_row_count long, schema map<string,string>, message string"
)

# SQL types of the target database.
SQL_TYPES = {
    T.StringType: "TEXT",
    T.ByteType: "SMALLINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
    T.DateType: "DATE",
    T.DayTimeIntervalType: "INTERVAL",
}
DEFAULT_SQL_TYPE = "TEXT"


def load_dataframe(
    df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None, file_format: str = "parquet"
) -> DataFrame:
    """Write a catalog table and return one row of load statistics.

    A failed write is reported with status FAILED, not raised. ``path`` makes the table external.
    The input count is taken during the write, the output count from the files that this write added, and the
    verified count, read back once, is the whole table's. Rows that another load adds meanwhile do not disturb it.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = df.sparkSession
    started = datetime.now(timezone.utc).isoformat()
    schema = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = Observation("loaded")
    try:
        before = _stored_files(spark, table) if mode == "append" else set()
        writer = df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode(mode).format(file_format)
        (writer.option("path", path) if path else writer).saveAsTable(table)
        loaded = observed_rows(rows)
        written = _rows_written(spark, table, _stored_files(spark, table) - before, loaded)
        verified = verify_load(spark, table)
        complete = written == loaded
        status = "SUCCESS" if complete else "FAILED"
        message = "row counts agree" if complete else f"expected {loaded} rows in the new files, found {written}"
        record = (started, table, mode, status, loaded, written, verified, schema, message)
    except Exception as error:  # the statistics carry the failure
        record = (started, table, mode, "FAILED", None, None, None, schema, str(error))
    return spark.createDataFrame([record], LOAD_STATS)


def _stored_files(spark: SparkSession, table: str) -> set[str]:
    if not spark.catalog.tableExists(table):
        return set()
    spark.catalog.refreshTable(table)
    return set(spark.table(table).inputFiles())


# All files of one write carry its job's id in their names.
JOB = r"part-\d+-([0-9a-f-]{36})"


def _rows_written(spark: SparkSession, table: str, files: set[str], loaded: int) -> int:
    """Rows in the files of one write among the new ones: of several loads at once, the one with ``loaded`` rows."""
    jobs = sorted({found[1] for found in (re.search(JOB, f) for f in files) if found})
    job = F.regexp_extract("_metadata.file_name", JOB, 1)
    counts = spark.table(table).where(job.isin(jobs)).groupBy(job.alias("job")).agg(F.count(F.lit(1)).alias("n"))
    found = [r["n"] for r in counts.collect()]
    found += [0] * (len(jobs) - len(found) or not found)  # files without rows
    return loaded if loaded in found else max(found)


def verify_load(spark: SparkSession, table: str) -> int:
    """Rows of the stored table, read back."""
    spark.catalog.refreshTable(table)
    return spark.table(table).count()


def verified_columns(spark: SparkSession, table: str) -> list[str]:
    return spark.table(table).columns


def one_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, NULL keys included: the last by ``order_by``, then by all columns."""
    names = [f"`{c}`" for c in source.columns]
    last = F.max(F.struct(*(F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)), *names)).alias("_last")
    return source.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(last).select(*(f"_last.{c}" for c in names))


def _without_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return match_rows(rows, other.select(*keys).distinct(), keys, "left_anti")


def incremental_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], modified: str | None = None
) -> DataFrame:
    """Source rows whose key is new to the target or, with ``modified``, newer than the target's row.

    NULL keys meet. A NULL mark is older than any other: a row without one goes on only if its key is new, and a
    key whose stored rows have none is renewed by any mark. Of rows that repeat a key in the source one goes on:
    the newest, then the largest.
    """
    source = one_per_key(source, keys, [modified] if modified else [])
    if modified is None:
        return _without_keys(source, target, keys)
    newest = target.groupBy(*keys).agg(F.max(modified).alias("_newest"), F.lit(True).alias("_stored"))
    joined = match_rows(source, newest, keys, "left")
    mark = F.col(modified)
    newer = mark.isNotNull() & (F.col("_newest").isNull() | (mark > F.col("_newest")))
    return joined.filter(F.col("_stored").isNull() | newer).select(*source.columns)


def incremental_load(df: DataFrame, table: str, keys: Sequence[str], modified: str | None = None) -> DataFrame:
    """Append only new or modified rows to an existing table: those of ``incremental_rows``.

    The table's state tells most of them without reading the table: a key that its Bloom filter does not know is
    new, and a mark above its high-water mark is newer than any stored one. Only the other rows are looked up, by
    the target's key and mark columns, of which no more than the matching rows are shuffled.
    """
    spark = df.sparkSession
    state = table_state(spark, table, keys, modified)
    source = one_per_key(df, keys, [modified] if modified else [])
    asked = maybe_stored(source, state.bitmaps(spark), keys, state.buckets)
    above = F.lit(False)
    if modified:
        highest = spark.read.parquet(f"{state.path}/mark").select("mark").scalar()
        above = F.col(modified).isNotNull() & (highest.isNull() | (F.col(modified) > highest))
    asked = materialize(asked.withColumn("_sure", ~F.col("_maybe") | above), "asked")
    rest = asked.where("NOT _sure").select(*source.columns)
    result = asked.where("_sure").select(*source.columns)
    if not rest.isEmpty():
        columns = dict.fromkeys([*keys, *([modified] if modified else [])])
        matching = match_rows(spark.table(table).select(*columns), broadcast_if_small(rest.select(*keys)), keys, "left_semi")
        result = result.unionByName(incremental_rows(rest, matching, keys, modified))
    return load_dataframe(result, table, "append")


def upsert_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source, plus one source row per key; NULL keys meet.

    Columns that the source lacks keep their stored values; columns that the target lacks are refused.
    """
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    source = one_per_key(source, keys)
    absent = [c for c in target.columns if c not in source.columns]
    kept = _without_keys(target, source, keys)
    if absent:
        source = match_rows(source, one_per_key(target.select(*keys, *absent), keys), keys, "left")
    return kept.unionByName(source.select(*target.columns))


def upsert_load(df: DataFrame, table: str, keys: Sequence[str], path: str, file_format: str = "parquet") -> int:
    """Write the merged table to the unused folder ``path`` and point the external table there.

    Readers see the old files until the location changes. Returns the rows of the new table.
    """
    spark = df.sparkSession
    upsert_rows(df, spark.table(table), keys).write.mode("error").format(file_format).save(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    return verify_load(spark, table)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys, *(F.col(k).isNull() for k in keys)), F.lit(buckets)).cast("int")


def keyed_table(df: DataFrame, table: str, keys: Sequence[str], path: str, buckets: int = 64, file_format: str = "parquet") -> int:
    """Write a table whose rows lie in ``buckets`` partitions of their keys' hashes (column ``_bucket``).

    It can be changed by ``upsert_partitions``. Returns its rows.
    """
    spark = df.sparkSession
    spread = df.withColumn("_bucket", _bucket(keys, buckets)).hint("rebalance", "_bucket")  # splits a hot bucket
    spread.write.mode("overwrite").format(file_format).partitionBy("_bucket").option("path", path).saveAsTable(table)
    set_property(spark, table, KEYED, [buckets, list(keys), path, file_format])
    return verify_load(spark, table)


def upsert_partitions(df: DataFrame, table: str) -> list[int]:
    """Merge ``df`` into a ``keyed_table`` by the rules of ``upsert_rows``, writing only the partitions it touches.

    The merged partitions are staged in the shared folder and replace the stored ones from there; the files of all
    other partitions stay as they are. An interrupted call can be repeated. Returns the partitions replaced.
    """
    spark = df.sparkSession
    buckets, keys, path, file_format = property_of(spark, table, KEYED)
    changes = one_per_key(df, keys)
    changes = materialize(changes.withColumn("_bucket", _bucket(keys, buckets)), "changes")
    touched = sorted(r[0] for r in changes.select("_bucket").distinct().collect())  # at most ``buckets`` numbers
    if touched:
        stored = spark.table(table).where(F.col("_bucket").isin(touched))
        merged = materialize(upsert_rows(changes, stored, keys), "merged").select(*stored.columns)
        writer = merged.hint("rebalance", "_bucket").write.mode("overwrite").format(file_format).partitionBy("_bucket")
        writer.option("partitionOverwriteMode", "dynamic").save(path)
        spark.catalog.recoverPartitions(table)  # partitions that had no rows before
        spark.catalog.refreshTable(table)
    return touched


# JDBC


def sql_type(kind: T.DataType, text_length: int | None = None) -> str:
    """Text has no limit unless ``text_length`` sets one."""
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    known = SQL_TYPES.get(type(kind), DEFAULT_SQL_TYPE)
    return f"VARCHAR({text_length})" if text_length and known == "TEXT" else known


def column_types(schema: T.StructType, text_length: int | None = None) -> str:
    """Column definitions for ``CREATE TABLE``."""
    return ", ".join(f"{f.name} {sql_type(f.dataType, text_length)}" for f in schema.fields)


def create_table_sql(table: str, schema: T.StructType, text_length: int | None = None) -> str:
    return f"CREATE TABLE {table} ({column_types(schema, text_length)})"


def text_types(schema: T.StructType, text_length: int | None = None) -> str:
    """Text columns with a length for ``createTableColumnTypes``, which takes Spark type names only.

    Without a length they get the dialect's own unlimited text type, as the other columns get the types of
    ``SQL_TYPES``.
    """
    text = [f for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return ", ".join(f"`{f.name}` {sql_type(f.dataType, text_length)}" for f in text) if text_length else ""


def write_jdbc(
    df: DataFrame, table: str, options: Mapping[str, str], mode: str = "overwrite", batch_size: int = 10_000,
    text_length: int | None = None,
) -> None:
    """Batched inserts from all tasks; each task commits its own transaction."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    writer = df.write.format("jdbc").options(**options).options(dbtable=table, batchsize=str(batch_size))
    text = text_types(df.schema, text_length)
    if text:
        writer = writer.option("createTableColumnTypes", text)
    writer.mode(mode).save()
