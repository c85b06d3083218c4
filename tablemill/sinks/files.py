"""CSV and JSON exports. Every export is a folder of part files, written by all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.files import s3a_path
from ..sources.records import CsvDialect

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TIME_OPTIONS = {"timestampFormat": ISO_TIMESTAMP, "timestampNTZFormat": ISO_TIMESTAMP}


def export_csv(df: DataFrame, path: str, mode: str = "error") -> str:
    """With header; quotes inside a value are doubled, so that line breaks and quotes read back."""
    df.write.mode(mode).options(**CsvDialect().options(), **TIME_OPTIONS).csv(path)
    return path


def export_json(df: DataFrame, path: str, mode: str = "error") -> str:
    """One object per line, ISO timestamps, NULL fields kept."""
    df.write.mode(mode).options(ignoreNullFields=False, **TIME_OPTIONS).json(path)
    return path


EXPORTS = {"csv": export_csv, "json": export_json}


def upload_dataframe(df: DataFrame, bucket: str, key: str, format: str = "csv") -> str:
    """Write to the object store; any format but csv and json is refused."""
    if format not in EXPORTS:
        raise ValueError(f"unsupported format {format!r}")
    return EXPORTS[format](df, s3a_path(bucket=bucket, key=key))


def export_performance_report(report: DataFrame, path: str) -> str:
    """Counts and the nested ``statistics`` object, as JSON."""
    return export_json(report, path)


def export_statistics(report: DataFrame, path: str) -> str:
    """The ``statistics`` object of a performance report as one CSV row."""
    return export_csv(report.select("statistics.*"), path)
