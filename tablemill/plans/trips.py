"""Trip reports. Each takes a trips table; those with a weekend or duration need ``add_trip_features``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_date, is_missing, label_text, present, rounded, route_label, tip_rate
from ..operators.aggregates import crosstab, grouped_measure, histogram, histogram_by_group, sort_limit, value_counts


def statistics(df: DataFrame) -> DataFrame:
    """Trips, vendors, mean distance, fare, passengers and speed, revenue."""
    speed = F.avg(present(df, "speed_mph")) if "speed_mph" in df.columns else F.lit(0.0)
    return df.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_distinct("vendor_id").alias("unique_vendors"),
        F.avg(present(df, "trip_distance")).alias("avg_distance"),
        F.avg(present(df, "fare_amount")).alias("avg_fare"),
        F.avg(present(df, "passenger_count")).alias("avg_passengers"),
        F.sum(present(df, "total_amount")).alias("total_revenue"),
        speed.alias("avg_speed"),
    )


def full_metrics(df: DataFrame) -> DataFrame:
    """The thirteen headline metrics of a prepared trips table."""
    return df.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_distinct("vendor_id").alias("unique_vendors"),
        F.sum(present(df, "total_amount")).alias("total_revenue"),
        F.avg(present(df, "fare_amount")).alias("avg_fare"),
        F.avg(present(df, "trip_distance")).alias("avg_distance"),
        F.avg(present(df, "passenger_count")).alias("avg_passengers"),
        F.avg(present(df, "trip_duration_minutes")).alias("avg_duration_minutes"),
        F.avg(present(df, "speed_mph")).alias("avg_speed"),
        F.sum(present(df, "tip_amount")).alias("total_tips"),
        F.avg(present(df, "tip_amount")).alias("avg_tip"),
        tip_rate(present(df, "tip_amount"), present(df, "fare_amount")).alias("tip_rate_pct"),
        F.count_if(F.col("is_weekend")).alias("weekend_trips"),
        F.count_if(~F.col("is_weekend")).alias("weekday_trips"),
    )


def headline(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("vendor_id").alias("unique_vendors"),
        F.avg(present(df, "trip_distance")).alias("avg_distance"),
        F.sum(present(df, "total_amount")).alias("total_revenue"),
    )


def distribution(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg(present(df, "trip_distance")).alias("mean_distance"),
        F.stddev(present(df, "trip_distance")).alias("std_distance"),
        F.avg(present(df, "fare_amount")).alias("mean_fare"),
        F.stddev(present(df, "fare_amount")).alias("std_fare"),
        F.avg(present(df, "tip_amount")).alias("mean_tip"),
        tip_rate(present(df, "tip_amount"), present(df, "fare_amount")).alias("tip_rate_pct"),
    )


def _by_vendor(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    grouped = df.filter(~is_missing(df, "vendor_id")).groupBy("vendor_id")
    return grouped.agg(F.count("trip_id").alias("trips"), *[rounded(m).alias(n) for n, m in measures.items()])


def vendor_aggregates(df: DataFrame) -> DataFrame:
    return _by_vendor(
        df,
        {
            "fare_sum": F.sum(present(df, "fare_amount")),
            "fare_mean": F.avg(present(df, "fare_amount")),
            "fare_std": F.stddev(present(df, "fare_amount")),
            "distance_mean": F.avg(present(df, "trip_distance")),
            "passengers_mean": F.avg(present(df, "passenger_count")),
            "total_mean": F.avg(present(df, "total_amount")),
        },
    )


def vendor_performance(df: DataFrame) -> DataFrame:
    return _by_vendor(
        df,
        {
            "avg_fare": F.avg(present(df, "fare_amount")),
            "total_fare": F.sum(present(df, "fare_amount")),
            "avg_distance": F.avg(present(df, "trip_distance")),
            "avg_speed": F.avg(present(df, "speed_mph")),
            "avg_tip": F.avg(present(df, "tip_amount")),
        },
    )


def vendor_summary(df: DataFrame) -> DataFrame:
    return _by_vendor(
        df,
        {
            "total_revenue": F.sum(present(df, "total_amount")),
            "avg_revenue": F.avg(present(df, "total_amount")),
            "avg_fare": F.avg(present(df, "fare_amount")),
            "avg_distance": F.avg(present(df, "trip_distance")),
            "avg_passengers": F.avg(present(df, "passenger_count")),
            "avg_speed": F.avg(present(df, "speed_mph")),
            "total_tips": F.sum(present(df, "tip_amount")),
            "avg_tip": F.avg(present(df, "tip_amount")),
        },
    )


def revenue_by_vendor(df: DataFrame, by_key: bool = False) -> DataFrame:
    report = grouped_measure(df, "vendor_id", "total_amount", "sum", "revenue", by_key)
    return report.withColumn("vendor", label_text("Vendor %s", "vendor_id"))


def fare_by_passengers(df: DataFrame) -> DataFrame:
    report = grouped_measure(df, "passenger_count", "fare_amount", "avg", "avg_fare", by_key=True)
    return report.withColumn("passengers", label_text("%s Pass.", "passenger_count"))


def speed_by_vendor(df: DataFrame) -> DataFrame:
    return grouped_measure(df, "vendor_id", "speed_mph", "avg", "avg_speed")


def payment_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "payment_type")


def vendor_counts(df: DataFrame, by_key: bool = False) -> DataFrame:
    return value_counts(df, "vendor_id", by_key)


def trips_by_hour(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    return value_counts(df.select(F.hour(ts).alias("hour_of_day")), "hour_of_day", by_key=True)


def daily_trips(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    return value_counts(df.select(calendar_date(ts).alias("trip_date")), "trip_date", by_key=True)


def route_counts(df: DataFrame, by_key: bool = False) -> DataFrame:
    counts = value_counts(df, ["pickup_location", "dropoff_location"], by_key)
    return counts.withColumn("route", route_label("pickup_location", "dropoff_location"))


def top_routes(df: DataFrame, routes: int = 10) -> DataFrame:
    """The most frequent routes."""
    return route_counts(df).limit(routes)


def first_routes(df: DataFrame, routes: int = 10) -> DataFrame:
    """The first routes in alphabetical order."""
    return route_counts(df, by_key=True).limit(routes)


def weekend_comparison(df: DataFrame) -> DataFrame:
    return df.filter("is_weekend IS NOT NULL").groupBy("is_weekend").agg(
        F.count(present(df, "total_amount")).alias("trips"),
        F.sum(present(df, "total_amount")).alias("revenue"),
        F.avg(present(df, "total_amount")).alias("avg_revenue"),
    )


def vendor_passenger_table(df: DataFrame, passengers: list[int] | None = None) -> DataFrame:
    return crosstab(df, "vendor_id", "passenger_count", passengers)


def performance_report(df: DataFrame, filtered: DataFrame) -> DataFrame:
    """One row: all and filtered record counts, and the nested statistics of the filtered trips."""
    nested = statistics(filtered)
    return nested.select(
        df.agg(F.count(F.lit(1))).scalar().alias("total_records"),
        F.col("total_trips").alias("filtered_records"),
        F.struct(*nested.columns).alias("statistics"),
    )


def run_reports(
    df: DataFrame, reports: Mapping[str, Callable[[DataFrame], DataFrame]]
) -> dict[str, DataFrame]:
    """Apply several reports to one table. Pass a stored or ``cached`` table: each report reads it."""
    return {name: report(df) for name, report in reports.items()}


# The panels over filtered trips.
DASHBOARD: dict[str, Callable[[DataFrame], DataFrame]] = {
    "headline": headline,
    "rows": lambda df: sort_limit(df, "pickup_datetime", "trip_id"),
    "vendor_aggregates": vendor_aggregates,
    "statistics": statistics,
    "revenue_by_vendor": revenue_by_vendor,
    "fare_by_passengers": fare_by_passengers,
    "payment_counts": payment_counts,
    "vendor_counts": vendor_counts,
    "first_routes": first_routes,
    "daily_trips": daily_trips,
    "vendor_passenger_table": vendor_passenger_table,
    "distribution": distribution,
    "speed_by_vendor": speed_by_vendor,
    "vendor_performance": vendor_performance,
    "distance_histogram": lambda df: histogram(df, "trip_distance", 30),
    "fare_histogram": lambda df: histogram(df, "fare_amount", 30),
    "speed_histogram": lambda df: histogram(df, "speed_mph", 25),
}

# The reports over trips made by ``prepare_trips``.
NOTEBOOK: dict[str, Callable[[DataFrame], DataFrame]] = {
    "metrics": full_metrics,
    "vendor_counts": lambda df: vendor_counts(df, by_key=True),
    "revenue_by_vendor": lambda df: revenue_by_vendor(df, by_key=True),
    "distance_histogram": lambda df: histogram(df, "trip_distance", 50),
    "fare_histogram": lambda df: histogram(df, "fare_amount", 50),
    "trips_by_hour": trips_by_hour,
    "payment_counts": payment_counts,
    "fare_by_passengers": fare_by_passengers,
    "weekend_comparison": weekend_comparison,
    "top_routes": top_routes,
    "speed_histogram_by_vendor": lambda df: histogram_by_group(df, "speed_mph", ["vendor_id"], 30),
    "vendor_summary": vendor_summary,
}
