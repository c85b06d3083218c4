"""Input tables and the trip-shaped view that many queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One SQL text serves Spark and the oracle.
TRIPS = """
SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS trip_id,
       o.o_orderdate AS pickup_datetime,
       l.l_shipdate AS dropoff_datetime,
       CAST(l.l_suppkey % 3 + 1 AS INT) AS vendor_id,
       l.l_linenumber AS passenger_count,
       l.l_quantity AS trip_distance,
       l.l_extendedprice AS fare_amount,
       NULLIF(l.l_discount, CAST(0 AS DOUBLE)) * l.l_extendedprice AS tip_amount,
       l.l_extendedprice * (1 + l.l_tax) AS total_amount,
       l.l_returnflag AS payment_type,
       o.o_orderstatus AS pickup_location,
       o.o_orderpriority AS dropoff_location,
       5 + l.l_quantity * CAST(1.1 AS DOUBLE) AS speed_mph
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

# Together with trip_id these leave no two different rows tied.
TRIP_ORDER = [
    "dropoff_datetime",
    "fare_amount",
    "trip_distance",
    "vendor_id",
    "payment_type",
    "total_amount",
    "tip_amount",
]

WITH_TRIPS = "WITH trips AS (" + TRIPS.format(lineitem="lineitem", orders="orders") + ")"

WITH_UNIQUE = (
    WITH_TRIPS
    + """, unique_trips AS (
    SELECT * FROM trips QUALIFY row_number() OVER (
        PARTITION BY trip_id ORDER BY dropoff_datetime, fare_amount, trip_distance, vendor_id,
            payment_type, total_amount, tip_amount NULLS FIRST) = 1)"""
)

TRIP_FEATURES = """date_diff('microsecond', pickup_datetime, dropoff_datetime) / 6e7 AS trip_duration_minutes,
       CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
       CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS day_of_week,
       isodow(pickup_datetime) IN (6, 7) AS is_weekend"""

WITH_PREPARED = (
    WITH_UNIQUE
    + f""", prepared AS (
    SELECT * REPLACE (coalesce(tip_amount, (SELECT median(tip_amount) FROM unique_trips)) AS tip_amount),
           {TRIP_FEATURES}
    FROM unique_trips
    WHERE pickup_datetime IS NOT NULL AND vendor_id IS NOT NULL AND passenger_count IS NOT NULL
      AND passenger_count > 0 AND passenger_count <= 8
      AND trip_distance >= 0 AND fare_amount >= 0 AND total_amount >= 0)"""
)

# Events with missing values: errors carry none.
GAPPY_EVENTS = """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS referrer
FROM {events}
"""

WITH_GAPPY = "WITH gappy AS (" + GAPPY_EVENTS.format(events="events") + ")"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRIPS, lineitem=table(spark, sf_dir, "lineitem"), orders=table(spark, sf_dir, "orders"))


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GAPPY_EVENTS, events=table(spark, sf_dir, "events"))


def round_doubles(df: DataFrame, digits: int = 2, columns: list[str] | None = None) -> DataFrame:
    names = columns or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names})
