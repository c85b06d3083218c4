"""Data-quality queries."""

from pyspark.sql import functions as F

from tablemill.operators import profiling as Q
from tablemill.operators.cleaning import clean_trips

from .common import GAPPY_EVENTS, TRIP_ORDER, WITH_GAPPY, WITH_PREPARED, WITH_TRIPS, gappy_events, table, trips

GAPPY_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "referrer": "bigint",
}


def _missing_sql(source, types, extra=""):
    def part(name):
        missing = f"count(*) FILTER (WHERE {name} IS NULL)"
        return f"""SELECT '{name}' AS "column", '{types[name]}' AS data_type, {missing} AS missing_count,
            count(*) AS total_rows, round(100 * {missing}::DOUBLE / count(*), 6) AS missing_pct,
            {len(types)} AS total_columns{extra} FROM {source}"""

    return " UNION ALL ".join(map(part, types))


def _quality_report(spark, sf):
    return Q.quality_report(gappy_events(spark, sf).drop("event_id", "ts")).withColumn("missing_pct", F.round("missing_pct", 6))


SHORT_TYPES = {k: v for k, v in GAPPY_TYPES.items() if k not in ("event_id", "ts")}


def _remaining(spark, sf):
    """Missing cells per column after cleaning."""
    report = Q.missing_report(clean_trips(trips(spark, sf), TRIP_ORDER))
    return report.filter("missing_count > 0").select("column", "missing_count")


def _dimensions(spark, sf):
    lines = trips(spark, sf)
    report = Q.quality_dimensions(
        lines,
        required=["pickup_datetime", "vendor_id", "tip_amount"],
        valid={"distance": F.col("trip_distance") <= 45, "speed": F.col("speed_mph") >= 10},
        consistent={"order of times": F.col("pickup_datetime") <= F.col("dropoff_datetime")},
        key=["trip_id"],
    )
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


def _score(spark, sf):
    penalties = {
        "no tip": (F.col("tip_amount").isNull(), 10),
        "times reversed": (F.col("dropoff_datetime") < F.col("pickup_datetime"), 5),
        "long": (F.col("trip_distance") > 45, 2),
    }
    return Q.quality_score(trips(spark, sf).select("trip_id", "pickup_datetime", "dropoff_datetime", "trip_distance", "tip_amount"), penalties)


CASES = {
    "quality_report": (
        _quality_report,
        f"""{WITH_GAPPY}, g AS (SELECT user_id, event_type, value, referrer FROM gappy),
            d AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM g)) AS dup FROM g)
            {_missing_sql('g', SHORT_TYPES, ', CAST((SELECT dup FROM d) AS BIGINT) AS duplicate_rows')}""",
    ),
    "missing_report": (
        lambda spark, sf: Q.missing_report(gappy_events(spark, sf)).withColumn("missing_pct", F.round("missing_pct", 6)),
        f"{WITH_GAPPY} {_missing_sql('gappy', GAPPY_TYPES)}",
    ),
    "completeness": (
        lambda spark, sf: Q.completeness(gappy_events(spark, sf)).withColumn("completeness_pct", F.round("completeness_pct", 6)),
        f"""{WITH_GAPPY}, m AS (SELECT count(*) AS total_rows,
            count(*) FILTER (WHERE value IS NULL) + count(*) FILTER (WHERE referrer IS NULL) AS missing_cells FROM gappy)
            SELECT *, round((1 - missing_cells / (total_rows * 6)) * 100, 6) AS completeness_pct FROM m""",
    ),
    "remaining_nulls": (
        _remaining,
        f"""{WITH_PREPARED} SELECT 'tip_amount' AS "column", count(*) AS missing_count FROM unique_trips
            WHERE tip_amount IS NULL AND passenger_count BETWEEN 1 AND 8 AND trip_distance >= 0 AND fare_amount >= 0""",
    ),
    "quality_dimensions": (
        _dimensions,
        f"""{WITH_TRIPS} SELECT round((count(pickup_datetime) + count(vendor_id) + count(tip_amount)) / (count(*) * 3) * 100, 6) AS completeness,
            round((count(*) FILTER (WHERE trip_distance <= 45) + count(*) FILTER (WHERE speed_mph >= 10)) / (count(*) * 2) * 100, 6) AS validity,
            round(count(*) FILTER (WHERE pickup_datetime <= dropoff_datetime) / count(*) * 100, 6) AS consistency,
            round(count(DISTINCT trip_id) / count(*) * 100, 6) AS uniqueness FROM trips""",
    ),
    "quality_score": (
        _score,
        f"""{WITH_TRIPS} SELECT trip_id, pickup_datetime, dropoff_datetime, trip_distance, tip_amount,
            100 - CASE WHEN tip_amount IS NULL THEN 10 ELSE 0 END - CASE WHEN dropoff_datetime < pickup_datetime THEN 5 ELSE 0 END
            - CASE WHEN trip_distance > 45 THEN 2 ELSE 0 END AS data_quality_score FROM trips""",
    ),
    "dataset_size": (lambda spark, sf: Q.dataset_size(spark, sf), None),
}
