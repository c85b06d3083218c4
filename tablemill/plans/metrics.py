"""Step metrics and the run report, as small DataFrames with a fixed schema."""

from __future__ import annotations

import time
import traceback
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAGE_SCHEMA = (
    "stage_name string, start_time string, end_time string, duration_seconds double, status string, "
    "row_count_input long, row_count_output long, row_count_processed long, row_count_failed long, "
    "error_message string, error_traceback string"
)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


@dataclass
class Step:
    """One step of a run; counts may be filled in after the step ended."""

    stage: str
    rows_in: int = 0
    rows_out: int = 0
    rows_failed: int = 0
    status: str = "SUCCESS"
    started: str = field(default_factory=_now)
    ended: str | None = None
    seconds: float = 0.0
    error: Exception | None = None

    def record(self) -> tuple:
        trace = "".join(traceback.format_exception(self.error)) if self.error else None
        return (
            self.stage,
            self.started,
            self.ended,
            self.seconds,
            self.status,
            self.rows_in,
            self.rows_out,
            self.rows_out,
            self.rows_failed,
            str(self.error) if self.error else None,
            trace,
        )


class StepLog:
    """The steps of one run; a record holds counts, never data."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.steps: list[Step] = []

    @contextmanager
    def step(self, stage: str) -> Iterator[Step]:
        """Time a step; an error marks it FAILED and is raised again."""
        step, clock = Step(stage), time.monotonic()
        self.steps.append(step)
        try:
            yield step
        except Exception as error:
            step.status, step.error = "FAILED", error
            raise
        finally:
            step.ended, step.seconds = _now(), time.monotonic() - clock

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame([step.record() for step in self.steps], STAGE_SCHEMA)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append step records to a JSON-lines folder."""
    metrics.write.mode("append").json(path)


def run_report(metrics: DataFrame) -> DataFrame:
    """Totals per kind of step (names starting with load, transform, db) and the success rate."""

    def rows(prefix: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stage_name").startswith(prefix), F.col("row_count_output"))), F.lit(0))

    totals = metrics.agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("total_duration_seconds"),
        F.when(F.count_if(F.col("status") == "FAILED") > 0, F.lit("FAILED")).otherwise("SUCCESS").alias("overall_status"),
        rows("load").alias("total_rows_loaded"),
        rows("transform").alias("total_rows_transformed"),
        rows("db").alias("total_rows_loaded_to_db"),
        F.coalesce(F.sum("row_count_failed"), F.lit(0)).alias("total_rows_failed"),
    )
    handled = F.col("total_rows_loaded") + F.col("total_rows_transformed") + F.col("total_rows_loaded_to_db")
    rate = F.try_divide((handled - F.col("total_rows_failed")).cast("double"), handled.cast("double")) * 100
    return totals.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))


def transformation_summary(metrics: DataFrame) -> DataFrame:
    """Per step: rows in, rows out and the change in percent."""
    change = F.try_divide(
        (F.col("row_count_output") - F.col("row_count_input")).cast("double"), F.col("row_count_input").cast("double")
    )
    return metrics.select("stage_name", "row_count_input", "row_count_output", (change * 100).alias("change_pct"))


def run_results_summary(
    runs: DataFrame, group_cols: Sequence[str] = ("source",), records: str = "records_processed"
) -> DataFrame:
    """Per source: runs, records, successes, failures and the share of all records in percent."""
    summed = runs.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(records).alias("records"),
        F.sum("success").alias("succeeded"),
        F.sum("failed").alias("failed"),
    )
    total = summed.agg(F.sum("records")).scalar()
    share = F.try_divide(F.col("records").cast("double"), total.cast("double")) * 100
    return summed.withColumn("share_pct", share)
