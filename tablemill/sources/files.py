"""CSV, JSON and Parquet from local, shared or object-store paths."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .records import CsvDialect, csv_records

FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet"}
CORRUPT = "_corrupt_record"


def load_data(
    spark: SparkSession,
    path: str | None = None,
    source_type: str = "local",
    bucket: str | None = None,
    key: str | None = None,
    schema: T.StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """Read a file by its extension; ``options`` go to the Spark reader.

    With ``source_type="s3"`` give a URI, or ``bucket`` and ``key``. Pass ``schema`` for large
    text files: without one Spark reads them twice, the first time to infer types.
    """
    if source_type == "s3":
        path = s3a_path(path, bucket, key)
    elif source_type != "local":
        raise ValueError(f"unknown source type {source_type!r}")
    if not path:
        raise ValueError("no path given")
    extension = PurePosixPath(path.rstrip("/")).suffix.lower()
    if extension not in FORMATS:
        raise ValueError(f"unsupported file extension {extension!r}")
    loaders = {"csv": load_csv, "json": load_json, "parquet": load_parquet}
    return loaders[FORMATS[extension]](spark, path, schema, **options)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    """Header row, types from ``schema`` or inferred; quotes inside a value are doubled, as the exporter writes them.

    Quoted values may hold line breaks. With a ``schema`` large files are split all the same: a first read finds
    out whether such values occur, then Spark's own reader or ``csv_records`` reads the splits (both at once when
    called). Without a schema, or with ``multiLine=True``, one task reads a file; ``multiLine=False`` skips the
    first read for files whose values hold no line break.
    """
    dialect = _dialect(options)
    plain = {**dialect.options(), **options}
    if schema is None:
        return spark.read.options(**{"multiLine": True, **plain}).option("inferSchema", True).csv(path)
    if "multiLine" not in options and not (NOT_SPLIT & options.keys()):
        records = csv_records(spark, path, dialect)
        if records is not None:
            return _parsed(records, _struct(schema), options).select("_row.*")
        plain = {**plain, "multiLine": False}
    return spark.read.options(**{"multiLine": True, **plain}).schema(schema).csv(path)


# Reader options under which a line cannot be judged by the dialect alone.
NOT_SPLIT = {"escape", "lineSep", "encoding", "charset", "comment", "recursiveFileLookup", "pathGlobFilter"}


def _dialect(options: dict[str, object]) -> CsvDialect:
    header = str(options.get("header", True)).lower() == "true"
    return CsvDialect(str(options.get("sep", options.get("delimiter", ","))), str(options.get("quote", '"')), header)


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _parsed(records: DataFrame, schema: T.StructType, options: dict[str, object]) -> DataFrame:
    """``records`` with ``_row``, the fields of each record; those that do not convert are NULL."""
    text = {**_dialect(options).options(), "multiLine": True, "mode": "PERMISSIVE", **options}
    text = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in text.items() if k != "header"}
    return records.withColumn("_row", F.from_csv("record", _ddl(schema), text))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def load_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    """JSON lines, which Spark can split; ``multiLine=True`` reads files that are one document each."""
    reader = spark.read.options(**{"multiLine": False, **options})
    return (reader.schema(schema) if schema else reader).json(path)


def load_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).parquet(path)


def split_s3_uri(uri: str) -> tuple[str, str]:
    """``s3://bucket/key`` (or ``s3a://``) to bucket and key; both must be present."""
    scheme, _, rest = uri.partition("://")
    if scheme not in ("s3", "s3a"):
        raise ValueError(f"not an S3 URI: {uri}")
    bucket, _, key = rest.partition("/")
    if not bucket or not key:
        raise ValueError(f"bucket and key are both required: {uri}")
    return bucket, key


def s3a_path(uri: str | None = None, bucket: str | None = None, key: str | None = None) -> str:
    if uri and "://" in uri:
        bucket, key = split_s3_uri(uri)
    if not bucket or not key:
        raise ValueError("give an S3 URI, or both bucket and key")
    return f"s3a://{bucket}/{key.lstrip('/')}"


def load_csv_from_s3(spark: SparkSession, bucket: str, key: str, **options: object) -> DataFrame:
    return load_csv(spark, s3a_path(bucket=bucket, key=key), **options)


def load_json_from_s3(spark: SparkSession, bucket: str, key: str, **options: object) -> DataFrame:
    return load_json(spark, s3a_path(bucket=bucket, key=key), **options)


def list_objects(spark: SparkSession, prefix: str) -> DataFrame:
    """``(path, length, modificationTime)`` of every file below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
    return files.select("path", "length", "modificationTime")


def read_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "csv", **options: object
) -> tuple[DataFrame, DataFrame]:
    """Parsed records, and those that do not fit ``schema`` with their raw text.

    A CSV record may hold quoted line breaks and is judged, and kept, as a whole. The files are parsed once, into
    the shared folder: parsing text again for each side costs more.
    """
    defaults = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    extended = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = None
    if file_format == "csv":
        # A pruned scan would judge a record by the selected columns only.
        defaults |= {**_dialect(options).options(), "columnPruning": False, "multiLine": False}
        if "multiLine" not in options and not (NOT_SPLIT & options.keys()):
            lines = csv_records(spark, path, _dialect(options))
    if lines is not None:
        parsed = _parsed(lines, extended, {"columnNameOfCorruptRecord": CORRUPT, **options}).select("_row.*", "path")
    else:
        parsed = spark.read.format(file_format).schema(extended).options(**{**defaults, **options}).load(path)
        parsed = parsed.withColumn("path", F.input_file_name())
    records = materialize(parsed, "parsed")
    good = records.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "path")
    return good, records.filter(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "raw_record")
