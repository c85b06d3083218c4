"""Whole flows: load, clean, derive, store, verify, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import MAX_PASSENGERS, handle_missing_values, prepare_trips, remove_duplicates
from ..operators.features import create_first_date_features
from ..operators.profiling import quality_report, validate_data
from ..session import materialize
from ..sinks.files import export_csv, export_json
from ..sinks.tables import load_dataframe
from ..sources.files import load_csv_from_s3, load_data
from .metrics import StepLog, run_report
from .trips import NOTEBOOK, run_reports


@dataclass
class FlowResult:
    """What a flow leaves behind; ``table`` is None when the run ended before a complete load."""

    metrics: DataFrame
    report: DataFrame
    table: DataFrame | None = None
    quality: DataFrame | None = None
    load_stats: DataFrame | None = None


def transform(distinct: DataFrame) -> DataFrame:
    """Medians for missing numbers, passenger range, date features of the first timestamp."""
    filled = handle_missing_values(distinct, "median")
    if "passenger_count" in filled.columns:
        filled = filled.filter((F.col("passenger_count") > 0) & (F.col("passenger_count") <= MAX_PASSENGERS))
    return create_first_date_features(filled)


def run_flow(
    spark: SparkSession, source: DataFrame | str, table: str, path: str | None = None, **options: object
) -> FlowResult:
    """Load → transform → store → report.

    A failed load or transform ends the run; a failed store does not stop the report. The source is
    read once: its distinct rows are written to the shared folder with the number of rows each stands for,
    and the check, the count, the medians and the final write read them there.
    """
    log = StepLog(spark)
    result = FlowResult(log.frame(), log.frame())
    try:
        with log.step("load") as loaded:
            df = load_data(spark, source, **options) if isinstance(source, str) else source
            # The count comes from the files: a counter before the shuffle counts rows again when a task is repeated.
            distinct = materialize(remove_duplicates(df, copies="_copies"), "distinct")
            if not validate_data(distinct):
                raise ValueError("the source holds no rows")
            loaded.rows_in = loaded.rows_out = distinct.agg(F.sum("_copies")).first()[0]
        with log.step("transform") as transformed:
            transformed.rows_in = loaded.rows_out
            clean = transform(distinct.drop("_copies"))
        with log.step("db_load") as stored:
            result.load_stats = load_dataframe(clean, table, "overwrite", path)
            stats = result.load_stats.first()
            stored.status = stats["status"]
            written = stats["input_row_count"]
            # What was transformed does not depend on whether it could be stored.
            stored.rows_in = transformed.rows_out = clean.count() if written is None else written
            stored.rows_out = stats["verified_row_count"] or 0
            stored.rows_failed = max(0, stored.rows_in - stored.rows_out)
        if stored.status == "SUCCESS":
            result.table = spark.table(table)
        result.quality = quality_report(clean if result.table is None else result.table)
    except Exception:  # recorded in the failed step
        if all(step.status == "SUCCESS" for step in log.steps):
            raise
    result.metrics = log.frame()
    result.report = run_report(result.metrics)
    return result


def object_store_to_table(spark: SparkSession, bucket: str, key: str, table: str, **options: object) -> DataFrame:
    """CSV from the object store, distinct rows, full load; returns the load statistics."""
    return load_dataframe(remove_duplicates(load_csv_from_s3(spark, bucket, key, **options)), table)


def notebook_flow(
    spark: SparkSession, source: DataFrame | str, order_by: Sequence[str], out: str, **options: object
) -> dict[str, DataFrame]:
    """Load trips, prepare them, export trips, metrics and vendor summary below ``out``; return all reports.

    The prepared trips are exported once. ``prepare_trips`` has stored their deduplicated rows, which the export and the
    reports read; a second copy takes longer to write than the few derived columns to compute.
    """
    df = load_data(spark, source, **options) if isinstance(source, str) else source
    prepared = prepare_trips(df, order_by)
    reports = run_reports(prepared, NOTEBOOK)
    export_csv(prepared, f"{out}/transformed_data.csv")
    export_json(reports["metrics"], f"{out}/metrics.json")
    export_csv(reports["vendor_summary"], f"{out}/vendor_summary.csv")
    return reports
