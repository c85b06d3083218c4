"""Trip report queries."""

from tablemill.operators.cleaning import add_trip_features, clean_trips, prepare_trips
from tablemill.plans import trips as R

from .common import TRIP_FEATURES, TRIP_ORDER, WITH_PREPARED, WITH_TRIPS, WITH_UNIQUE, round_doubles, table
from .common import trips as load_trips

VENDOR_SUMMARY = """SELECT vendor_id, count(trip_id) AS trips, round(sum(total_amount), 2) AS total_revenue,
    round(avg(total_amount), 2) AS avg_revenue, round(avg(fare_amount), 2) AS avg_fare,
    round(avg(trip_distance), 2) AS avg_distance, round(avg(passenger_count), 2) AS avg_passengers,
    round(avg(speed_mph), 2) AS avg_speed, round(sum(tip_amount), 2) AS total_tips, round(avg(tip_amount), 2) AS avg_tip
    FROM {source} GROUP BY vendor_id"""

FULL_METRICS = """SELECT count(*) AS total_trips, count(DISTINCT vendor_id) AS unique_vendors,
    round(sum(total_amount), 2) AS total_revenue, round(avg(fare_amount), 2) AS avg_fare,
    round(avg(trip_distance), 2) AS avg_distance, round(avg(passenger_count), 2) AS avg_passengers,
    round(avg(trip_duration_minutes), 2) AS avg_duration_minutes, round(avg(speed_mph), 2) AS avg_speed,
    round(sum(tip_amount), 2) AS total_tips, round(avg(tip_amount), 2) AS avg_tip,
    round(sum(tip_amount) / sum(fare_amount) * 100, 2) AS tip_rate_pct,
    count(*) FILTER (WHERE is_weekend) AS weekend_trips, count(*) FILTER (WHERE NOT is_weekend) AS weekday_trips
    FROM {source}"""

WITH_FEATURES = f"{WITH_TRIPS}, featured AS (SELECT *, {TRIP_FEATURES} FROM trips)"
ROUTES = """SELECT pickup_location, dropoff_location, count(*) AS n, pickup_location || ' → ' || dropoff_location AS route
    FROM trips GROUP BY pickup_location, dropoff_location"""


def report(make, digits=2):
    return lambda spark, sf: round_doubles(make(load_trips(spark, sf)), digits)


def vendor_summary_of_clean_trips(spark, sf):
    """Deduplicated, validated trips per vendor: the flagship."""
    return R.vendor_summary(clean_trips(load_trips(spark, sf), TRIP_ORDER))


CASES = {
    "vendor_summary_clean": (
        vendor_summary_of_clean_trips,
        f"""{WITH_UNIQUE}, valid AS (SELECT * FROM unique_trips WHERE pickup_datetime IS NOT NULL AND vendor_id IS NOT NULL
            AND passenger_count > 0 AND passenger_count <= 8 AND trip_distance >= 0 AND fare_amount >= 0)
            {VENDOR_SUMMARY.format(source='valid')}""",
    ),
    "kpi_row": (
        report(R.statistics),
        f"""{WITH_TRIPS} SELECT count(*) AS total_trips, count(DISTINCT vendor_id) AS unique_vendors,
            round(avg(trip_distance), 2) AS avg_distance, round(avg(fare_amount), 2) AS avg_fare,
            round(avg(passenger_count), 2) AS avg_passengers, round(sum(total_amount), 2) AS total_revenue,
            round(avg(speed_mph), 2) AS avg_speed FROM trips""",
    ),
    "kpi_notebook": (
        report(lambda t: R.full_metrics(add_trip_features(t))),
        f"{WITH_FEATURES} {FULL_METRICS.format(source='featured')}",
    ),
    "kpi_prepared": (
        lambda spark, sf: round_doubles(R.full_metrics(prepare_trips(load_trips(spark, sf), TRIP_ORDER))),
        f"{WITH_PREPARED} {FULL_METRICS.format(source='prepared')}",
    ),
    "headline": (
        report(R.headline),
        f"""{WITH_TRIPS} SELECT count(*) AS total_records, count(DISTINCT vendor_id) AS unique_vendors,
            round(avg(trip_distance), 2) AS avg_distance, round(sum(total_amount), 2) AS total_revenue FROM trips""",
    ),
    "distribution": (
        report(R.distribution),
        f"""{WITH_TRIPS} SELECT round(avg(trip_distance), 2) AS mean_distance, round(stddev_samp(trip_distance), 2) AS std_distance,
            round(avg(fare_amount), 2) AS mean_fare, round(stddev_samp(fare_amount), 2) AS std_fare,
            round(avg(tip_amount), 2) AS mean_tip, round(sum(tip_amount) / sum(fare_amount) * 100, 2) AS tip_rate_pct FROM trips""",
    ),
    "tip_rate": (
        report(lambda t: t.agg(R.tip_rate("tip_amount", "fare_amount").alias("tip_rate_pct")), 4),
        f"{WITH_TRIPS} SELECT round(sum(tip_amount) / sum(fare_amount) * 100, 4) AS tip_rate_pct FROM trips",
    ),
    "vendor_agg": (
        report(R.vendor_aggregates),
        f"""{WITH_TRIPS} SELECT vendor_id, count(trip_id) AS trips, round(sum(fare_amount), 2) AS fare_sum,
            round(avg(fare_amount), 2) AS fare_mean, round(stddev_samp(fare_amount), 2) AS fare_std,
            round(avg(trip_distance), 2) AS distance_mean, round(avg(passenger_count), 2) AS passengers_mean,
            round(avg(total_amount), 2) AS total_mean FROM trips GROUP BY vendor_id""",
    ),
    "vendor_performance": (
        report(R.vendor_performance),
        f"""{WITH_TRIPS} SELECT vendor_id, count(trip_id) AS trips, round(avg(fare_amount), 2) AS avg_fare,
            round(sum(fare_amount), 2) AS total_fare, round(avg(trip_distance), 2) AS avg_distance,
            round(avg(speed_mph), 2) AS avg_speed, round(avg(tip_amount), 2) AS avg_tip FROM trips GROUP BY vendor_id""",
    ),
    "vendor_summary": (report(R.vendor_summary), f"{WITH_TRIPS} {VENDOR_SUMMARY.format(source='trips')}"),
    "revenue_by_vendor": (
        report(R.revenue_by_vendor),
        f"""{WITH_TRIPS} SELECT vendor_id, round(sum(total_amount), 2) AS revenue, 'Vendor ' || vendor_id AS vendor
            FROM trips GROUP BY vendor_id""",
    ),
    "fare_by_passengers": (
        report(R.fare_by_passengers),
        f"""{WITH_TRIPS} SELECT passenger_count, round(avg(fare_amount), 2) AS avg_fare, passenger_count || ' Pass.' AS passengers
            FROM trips GROUP BY passenger_count""",
    ),
    "speed_by_vendor": (
        report(R.speed_by_vendor),
        f"{WITH_TRIPS} SELECT vendor_id, round(avg(speed_mph), 2) AS avg_speed FROM trips GROUP BY vendor_id",
    ),
    "payment_counts": (
        report(R.payment_counts),
        f"{WITH_TRIPS} SELECT payment_type, count(*) AS n FROM trips GROUP BY payment_type",
    ),
    "vendor_counts": (
        report(R.vendor_counts),
        f"{WITH_TRIPS} SELECT vendor_id, count(*) AS n FROM trips GROUP BY vendor_id",
    ),
    "hourly": (
        lambda spark, sf: R.trips_by_hour(table(spark, sf, "events"), "ts"),
        "SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS n FROM events GROUP BY ALL",
    ),
    "daily": (
        report(R.daily_trips),
        f"{WITH_TRIPS} SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS n FROM trips GROUP BY ALL",
    ),
    "route_counts": (report(R.route_counts), f"{WITH_TRIPS} {ROUTES}"),
    "routes_top10": (
        report(R.top_routes),
        f"{WITH_TRIPS} {ROUTES} ORDER BY n DESC, pickup_location, dropoff_location LIMIT 10",
    ),
    "routes_first10": (
        report(R.first_routes),
        f"{WITH_TRIPS} {ROUTES} ORDER BY pickup_location, dropoff_location LIMIT 10",
    ),
    "weekend_compare": (
        report(lambda t: R.weekend_comparison(add_trip_features(t))),
        f"""{WITH_FEATURES} SELECT is_weekend, count(total_amount) AS trips, round(sum(total_amount), 2) AS revenue,
            round(avg(total_amount), 2) AS avg_revenue FROM featured GROUP BY is_weekend""",
    ),
}
