"""Whole flows over trips."""

import uuid

from pyspark.sql import functions as F

from tablemill.operators.cleaning import apply_filters, clean_trips
from tablemill.plans.etl import notebook_flow, run_flow
from tablemill.plans.metrics import run_results_summary, transformation_summary
from tablemill.plans.dashboard import dashboard_flow
from tablemill.plans.trips import DASHBOARD
from tablemill.session import scratch_path

from .aggregates import histogram_sql
from .common import TRIP_ORDER, WITH_PREPARED, WITH_TRIPS, round_doubles, table, trips
from .features import DATE_PARTS
from .trips import CASES as TRIP_CASES
from .trips import FULL_METRICS, WITH_FEATURES

WITH_FLOW = f"""{WITH_TRIPS}, distinct_trips AS (SELECT DISTINCT * FROM trips),
    stored AS (SELECT * REPLACE (coalesce(tip_amount, (SELECT median(tip_amount) FROM distinct_trips)) AS tip_amount),
        {DATE_PARTS.format(p='').replace('(ts)', '(pickup_datetime)')}
        FROM distinct_trips WHERE passenger_count > 0 AND passenger_count <= 8)"""


# The stored columns.
STORED_COLUMNS = [
    "trip_id",
    "pickup_datetime",
    "dropoff_datetime",
    "vendor_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "pickup_location",
    "dropoff_location",
    "speed_mph",
    "year",
    "month",
    "day",
    "hour",
    "minute",
    "quarter",
    "dayofweek",
    "is_weekend",
]


def _flow(spark, sf):
    return run_flow(spark, trips(spark, sf), f"flow_{uuid.uuid4().hex}", scratch_path(spark, "flow"))


def _report(spark, sf):
    return _flow(spark, sf).report.select(
        "overall_status",
        "total_rows_loaded",
        "total_rows_transformed",
        "total_rows_loaded_to_db",
        "total_rows_failed",
        "success_rate",
    )


def _steps(spark, sf):
    return transformation_summary(_flow(spark, sf).metrics).withColumn("change_pct", F.round("change_pct", 6))


def _quality(spark, sf):
    return _flow(spark, sf).quality.select("column", "missing_count", "total_rows", "duplicate_rows")


def _panel(name, digits=2):
    """One panel of the whole flow, which computes all of them."""

    def query(spark, sf):
        panel = dashboard_flow(trips(spark, sf), TRIP_ORDER, vendors=[1, 2], passengers=(1, 6))[name]
        return panel if name == "rows" else round_doubles(panel, digits)

    return query


def _run_results(group):
    def query(spark, sf):
        runs = table(spark, sf, "events").select(
            F.col("event_type").alias("source"),
            F.to_date("ts").alias("timestamp"),
            F.col("user_id").alias("records_processed"),
            (F.col("value") >= 10).cast("int").alias("success"),
            (F.col("value") < 10).cast("int").alias("failed"),
        )
        return run_results_summary(runs, [group]).withColumn("share_pct", F.round("share_pct", 6))

    return query


def _run_results_sql(expression, name):
    return f"""SELECT {expression} AS {name}, count(*) AS runs, CAST(sum(user_id) AS BIGINT) AS records,
        count(*) FILTER (WHERE value >= 10) AS succeeded, count(*) FILTER (WHERE value < 10) AS failed,
        round(100 * sum(user_id) / (SELECT sum(user_id) FROM events)::DOUBLE, 6) AS share_pct FROM events GROUP BY 1"""


def _dashboard(panel):
    def query(spark, sf):
        filtered = apply_filters(trips(spark, sf), vendors=[1, 2], passengers=(1, 6))
        return round_doubles(DASHBOARD[panel](clean_trips(filtered, TRIP_ORDER)))

    return query


def _notebook(report, digits=2):
    def query(spark, sf):
        reports = notebook_flow(spark, trips(spark, sf), TRIP_ORDER, scratch_path(spark, "notebook"))
        return round_doubles(reports[report], digits)

    return query


def _over(sql, head, source):
    """The SQL of a report over all trips, over ``source`` instead."""
    return head + sql.removeprefix(WITH_TRIPS).replace("FROM trips", f"FROM {source}").replace("FROM featured", f"FROM {source}")


# The panels clean the filtered rows, so the filter comes before the deduplication.
FILTERED_FIRST = f"""{WITH_TRIPS}, kept AS (
    SELECT * FROM trips WHERE vendor_id IN (1, 2) AND passenger_count BETWEEN 1 AND 6
    QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY dropoff_datetime, fare_amount, trip_distance, vendor_id,
        payment_type, total_amount, tip_amount NULLS FIRST) = 1)"""

# Each panel and report with the query whose SQL it shares, or its own.
PASSENGERS = ", ".join(f'count(*) FILTER (WHERE passenger_count = {i}) AS "{i}"' for i in range(1, 7))
PANELS = {
    "headline": TRIP_CASES["headline"][1],
    "rows": f"{WITH_TRIPS} SELECT * FROM trips ORDER BY pickup_datetime NULLS LAST, trip_id LIMIT 50",
    "vendor_aggregates": TRIP_CASES["vendor_agg"][1],
    "statistics": TRIP_CASES["kpi_row"][1],
    "revenue_by_vendor": TRIP_CASES["revenue_by_vendor"][1],
    "fare_by_passengers": TRIP_CASES["fare_by_passengers"][1],
    "payment_counts": TRIP_CASES["payment_counts"][1],
    "vendor_counts": TRIP_CASES["vendor_counts"][1],
    "first_routes": TRIP_CASES["routes_first10"][1],
    "daily_trips": TRIP_CASES["daily"][1],
    "vendor_passenger_table": f"{WITH_TRIPS} SELECT vendor_id, {PASSENGERS} FROM trips GROUP BY vendor_id",
    "distribution": TRIP_CASES["distribution"][1],
    "speed_by_vendor": TRIP_CASES["speed_by_vendor"][1],
    "vendor_performance": TRIP_CASES["vendor_performance"][1],
    "distance_histogram": histogram_sql("trip_distance", 30),
    "fare_histogram": histogram_sql("fare_amount", 30),
    "speed_histogram": histogram_sql("speed_mph", 25),
}
REPORTS = {
    "metrics": f"{WITH_TRIPS} {FULL_METRICS.format(source='trips')}",
    "vendor_counts": TRIP_CASES["vendor_counts"][1],
    "revenue_by_vendor": TRIP_CASES["revenue_by_vendor"][1],
    "distance_histogram": histogram_sql("trip_distance", 50),
    "fare_histogram": histogram_sql("fare_amount", 50),
    "trips_by_hour": f"{WITH_TRIPS} SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day, count(*) AS n FROM trips GROUP BY ALL",
    "payment_counts": TRIP_CASES["payment_counts"][1],
    "fare_by_passengers": TRIP_CASES["fare_by_passengers"][1],
    "weekend_comparison": WITH_TRIPS + TRIP_CASES["weekend_compare"][1].removeprefix(WITH_FEATURES),
    "top_routes": TRIP_CASES["routes_top10"][1],
    "speed_histogram_by_vendor": histogram_sql("speed_mph", 30, "vendor_id"),
}

CASES = {
    **{f"dashboard_{p}": (_panel(p, 6 if "histogram" in p else 2), _over(sql, FILTERED_FIRST, "kept")) for p, sql in PANELS.items()},
    **{f"notebook_{r}": (_notebook(r, 6 if "histogram" in r else 2), _over(sql, WITH_PREPARED, "prepared")) for r, sql in REPORTS.items()},
    "etl_stored_table": (lambda spark, sf: _flow(spark, sf).table, f"{WITH_FLOW} SELECT * FROM stored"),
    "etl_report": (
        _report,
        f"""{WITH_FLOW}, n AS (SELECT (SELECT count(*) FROM trips) AS a, (SELECT count(*) FROM stored) AS b)
            SELECT 'SUCCESS' AS overall_status, a AS total_rows_loaded, b AS total_rows_transformed, b AS total_rows_loaded_to_db,
            CAST(0 AS BIGINT) AS total_rows_failed, CAST(100 AS DOUBLE) AS success_rate FROM n""",
    ),
    "etl_steps": (
        _steps,
        f"""{WITH_FLOW}, n AS (SELECT (SELECT count(*) FROM trips) AS a, (SELECT count(*) FROM stored) AS b)
            SELECT 'load' AS stage_name, a AS row_count_input, a AS row_count_output, CAST(0 AS DOUBLE) AS change_pct FROM n
            UNION ALL SELECT 'transform', a, b, round((b - a) / a * 100, 6) FROM n
            UNION ALL SELECT 'db_load', b, b, 0 FROM n""",
    ),
    "etl_quality": (
        _quality,
        f"{WITH_FLOW} "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS total_rows,
            count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM stored)) AS duplicate_rows FROM stored"""
            for c in STORED_COLUMNS
        ),
    ),
    "run_results_by_source": (_run_results("source"), _run_results_sql("event_type", "source")),
    "run_results_by_day": (_run_results("timestamp"), _run_results_sql("CAST(ts AS DATE)", '"timestamp"')),
    "dashboard_vendors": (
        _dashboard("vendor_performance"),
        f"""{FILTERED_FIRST}
            SELECT vendor_id, count(trip_id) AS trips, round(avg(fare_amount), 2) AS avg_fare,
            round(sum(fare_amount), 2) AS total_fare, round(avg(trip_distance), 2) AS avg_distance,
            round(avg(speed_mph), 2) AS avg_speed, round(avg(tip_amount), 2) AS avg_tip FROM kept GROUP BY vendor_id""",
    ),
    "notebook_vendor_summary": (
        _notebook("vendor_summary"),
        f"""{WITH_PREPARED} SELECT vendor_id, count(trip_id) AS trips, round(sum(total_amount), 2) AS total_revenue,
            round(avg(total_amount), 2) AS avg_revenue, round(avg(fare_amount), 2) AS avg_fare,
            round(avg(trip_distance), 2) AS avg_distance, round(avg(passenger_count), 2) AS avg_passengers,
            round(avg(speed_mph), 2) AS avg_speed, round(sum(tip_amount), 2) AS total_tips, round(avg(tip_amount), 2) AS avg_tip
            FROM prepared GROUP BY vendor_id""",
    ),
}
