"""The dashboard as one flow: filter and clean once, store once, and compute every panel from three reads.

All grouped panels come from one aggregate over grouping sets, the histograms from one count of bins whose ranges
that aggregate already knows, and the rows panel from a sort with a limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_date, is_missing, label_text, present, rounded, route_label
from ..operators.aggregates import bin_number, sort_limit
from ..operators.cleaning import apply_filters, clean_trips
from ..session import materialize

# Measures by short name, grouping sets, histograms with their bins.
MEASURES = {
    "fare": "fare_amount",
    "distance": "trip_distance",
    "passengers": "passenger_count",
    "total": "total_amount",
    "speed": "speed_mph",
    "tip": "tip_amount",
}
KEYS = ["vendor_id", "passenger_count", "payment_type", "pickup_location", "dropoff_location", "trip_date"]
SETS = {
    "all": [],
    "vendor": ["vendor_id"],
    "passengers": ["passenger_count"],
    "payment": ["payment_type"],
    "route": ["pickup_location", "dropoff_location"],
    "day": ["trip_date"],
    "vendor and passengers": ["vendor_id", "passenger_count"],
}
HISTOGRAMS = {
    "distance_histogram": ("distance", 30),
    "fare_histogram": ("fare", 30),
    "speed_histogram": ("speed", 25),
}


def fused_groups(trips: DataFrame) -> DataFrame:
    """Every grouping set of the panels in one aggregate: KEYS, ``_set``, ``n``, ``trips`` and five numbers per measure."""
    measured = trips.select(
        *KEYS[:-1],
        calendar_date("pickup_datetime").alias("trip_date"),
        "trip_id",
        *[present(trips, c).alias(f"_{name}") for name, c in MEASURES.items()],
    )
    numbers = {"sum": F.sum, "avg": F.avg, "std": F.stddev, "min": F.min, "max": F.max}
    return measured.groupingSets([[F.col(c) for c in keys] for keys in SETS.values()], *KEYS).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("n"),
        F.count("trip_id").alias("trips"),
        *[by(f"_{name}").alias(f"{name}_{number}") for name in MEASURES for number, by in numbers.items()],
    )


def one_set(fused: DataFrame, name: str) -> DataFrame:
    """The rows of one grouping set; missing keys are left out."""
    keys = SETS[name]
    rows = fused.filter(F.col("_set") == sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in keys))
    for key in keys:
        rows = rows.filter(~is_missing(rows, key))
    return rows


def grouped_panels(fused: DataFrame) -> dict[str, DataFrame]:
    everything, vendor, passengers, routes = (one_set(fused, s) for s in ("all", "vendor", "passengers", "route"))
    # Without any trip the set has no row, but the totals have one.
    totals = [F.max(c).alias(c) for c in everything.columns if c not in (*KEYS, "n")]
    everything = everything.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *totals)
    vendors = vendor.agg(F.count(F.lit(1))).scalar().alias("unique_vendors")

    def by_vendor(**measures: str) -> DataFrame:
        return vendor.select("vendor_id", "trips", *[rounded(F.col(c)).alias(name) for name, c in measures.items()])

    def named(**measures: str | Column) -> list[Column]:
        return [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in measures.items()]

    pairs = one_set(fused, "vendor and passengers").groupBy("vendor_id").pivot("passenger_count").agg(F.first("n"))
    tip_rate = F.try_divide("tip_sum", "fare_sum") * 100
    return {
        "headline": everything.select(
            F.col("n").alias("total_records"), vendors, *named(avg_distance="distance_avg", total_revenue="total_sum")
        ),
        "statistics": everything.select(
            F.col("n").alias("total_trips"),
            vendors,
            *named(
                avg_distance="distance_avg", avg_fare="fare_avg", avg_passengers="passengers_avg", total_revenue="total_sum", avg_speed="speed_avg"
            ),
        ),
        "distribution": everything.select(
            *named(
                mean_distance="distance_avg", std_distance="distance_std", mean_fare="fare_avg", std_fare="fare_std", mean_tip="tip_avg",
                tip_rate_pct=tip_rate,
            )
        ),
        "vendor_aggregates": by_vendor(
            fare_sum="fare_sum", fare_mean="fare_avg", fare_std="fare_std", distance_mean="distance_avg", passengers_mean="passengers_avg",
            total_mean="total_avg",
        ),
        "vendor_performance": by_vendor(
            avg_fare="fare_avg", total_fare="fare_sum", avg_distance="distance_avg", avg_speed="speed_avg", avg_tip="tip_avg"
        ),
        "revenue_by_vendor": vendor.select("vendor_id", *named(revenue="total_sum"), label_text("Vendor %s", "vendor_id").alias("vendor")).orderBy(
            F.desc_nulls_last("revenue"), "vendor_id"
        ),
        "speed_by_vendor": vendor.select("vendor_id", *named(avg_speed="speed_avg")).orderBy(F.desc_nulls_last("avg_speed"), "vendor_id"),
        "vendor_counts": vendor.select("vendor_id", "n").orderBy(F.desc("n"), "vendor_id"),
        "fare_by_passengers": passengers.select(
            "passenger_count", *named(avg_fare="fare_avg"), label_text("%s Pass.", "passenger_count").alias("passengers")
        ).orderBy("passenger_count"),
        "payment_counts": one_set(fused, "payment").select("payment_type", "n").orderBy(F.desc("n"), "payment_type"),
        "daily_trips": one_set(fused, "day").select("trip_date", "n").orderBy("trip_date"),
        "first_routes": routes.select(
            "pickup_location", "dropoff_location", "n", route_label("pickup_location", "dropoff_location").alias("route")
        ).orderBy("pickup_location", "dropoff_location").limit(10),
        "vendor_passenger_table": pairs.fillna(0, subset=pairs.columns[1:]),
    }


def histogram_panels(trips: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    """The histograms from one read of ``trips``; ``totals`` is the one row of the set "all"."""
    spark = trips.sparkSession
    row = totals.first()
    spans = {p: (row[f"{m}_min"], row[f"{m}_max"]) if row else (None, None) for p, (m, _) in HISTOGRAMS.items()}
    bounds = {p: tuple(None if v is None else float(v) for v in span) for p, span in spans.items()}

    def place(panel: str) -> Column:
        measure, bins = HISTOGRAMS[panel]
        low, high = (F.lit(v).cast("double") for v in bounds[panel])
        return F.struct(F.lit(panel).alias("panel"), bin_number(present(trips, MEASURES[measure]).cast("double"), low, (high - low) / bins, bins).alias("bin"))

    placed = trips.select(F.inline(F.array(*[place(p) for p in HISTOGRAMS]))).filter("bin IS NOT NULL")
    counts = materialize(placed.groupBy("panel", "bin").agg(F.count(F.lit(1)).alias("_n")), "bins")
    panels = {}
    for panel, (_, bins) in HISTOGRAMS.items():
        span = spark.createDataFrame([bounds[panel]], "_low double, _high double").filter("_low IS NOT NULL")
        every = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        width = (F.col("_high") - F.col("_low")) / bins
        panels[panel] = every.join(counts.filter(F.col("panel") == panel), "bin", "left").select(
            "bin",
            (F.col("_low") + F.col("bin") * width).alias("bin_start"),
            (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("_n", F.lit(0)).alias("n"),
        )
    return panels


def dashboard_flow(trips: DataFrame, order_by: Sequence[str], **filters: object) -> Mapping[str, DataFrame]:
    """All panels over the trips that pass ``filters`` (see ``apply_filters``) and the cleaning.

    The kept trips and the aggregate are stored in the shared folder, so each panel reads a few rows of it.
    A filter that leaves no row gives panels of zeros and empty lists.
    """
    kept = materialize(clean_trips(apply_filters(trips, **filters), order_by), "dashboard")
    fused = materialize(fused_groups(kept), "panels")
    return {
        "rows": sort_limit(kept, "pickup_datetime", "trip_id"),
        **grouped_panels(fused),
        **histogram_panels(kept, one_set(fused, "all")),
    }
