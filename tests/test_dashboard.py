"""The fused flow against each panel computed alone."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from registry.common import TRIP_ORDER, trips
from tablemill.operators.cleaning import apply_filters, clean_trips
from tablemill.plans.dashboard import dashboard_flow
from tablemill.plans.trips import DASHBOARD
from tablemill.session import materialize


@pytest.fixture(scope="module")
def gappy(spark, sf):
    """Trips with missing keys, measures and times, NaN among them."""
    every = trips(spark, sf)
    gone = lambda column, n: F.when(F.col("trip_id") % n > 0, F.col(column)).alias(column)
    nan = F.when(F.col("trip_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("speed_mph"))
    holes = {"payment_type": 7, "pickup_location": 11, "fare_amount": 9, "tip_amount": 5}
    made = every.select(*(gone(c, holes[c]) if c in holes else c for c in every.columns))
    return materialize(made.withColumn("speed_mph", nan).withColumn("fare_amount", F.coalesce("fare_amount", F.lit(0.0))), "gappy")


@pytest.mark.parametrize("filters", [{}, {"vendors": [1, 3], "passengers": (2, 5)}, {"vendors": [99]}])
def test_every_panel_equals_its_own_report(gappy, filters):
    alone = materialize(clean_trips(apply_filters(gappy, **filters), TRIP_ORDER), "alone")
    panels = dashboard_flow(gappy, TRIP_ORDER, **filters)
    assert set(panels) == set(DASHBOARD)
    for name, report in DASHBOARD.items():
        want, got = report(alone), panels[name]
        assert got.dtypes == want.dtypes, name
        doubles = [c for c, kind in want.dtypes if kind == "double"]
        rounded = {c: F.round(c, 6) for c in doubles}
        assert str(rows(got.withColumns(rounded))) == str(rows(want.withColumns(rounded))), name  # as text, for NaN


def test_a_filter_that_leaves_no_row(gappy):
    panels = dashboard_flow(gappy, TRIP_ORDER, vendors=[99])
    assert panels["headline"].first()[:2] == (0, 0) and panels["statistics"].first()["total_trips"] == 0
    assert all(panels[p].count() == 0 for p in ("rows", "vendor_performance", "daily_trips", "fare_histogram"))
