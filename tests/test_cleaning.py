import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from registry.common import TRIP_ORDER
from registry.common import trips as load_trips
from tablemill.operators import cleaning as C
from tablemill.operators.outliers import remove_outliers

NAN = float("nan")


@pytest.fixture(scope="module")
def gappy(spark):
    data = [(1, 1.0, "a"), (2, None, "b"), (3, NAN, None), (4, 4.0, "d"), (5, 10.0, "e")]
    return spark.createDataFrame(data, "id int, x double, s string")


def test_keep_follows_the_order(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("k", 3, "c"), (None, 1, "n"), (None, 2, "m")], "k string, o int, v string")
    assert rows(C.remove_duplicates(df, ["k"], "first", ["o"]).select("k", "v")) == [("k", "a"), (None, "n")]
    assert rows(C.remove_duplicates(df, ["k"], "last", ["o"]).select("k", "v")) == [("k", "c"), (None, "m")]
    assert C.remove_duplicates(df, ["k"]).count() == 2
    assert C.remove_duplicates(df.union(df)).count() == 5
    with pytest.raises(ValueError):
        C.remove_duplicates(df, ["k"], "none", ["o"])


def test_a_hot_key_shrinks_before_the_shuffle(events):
    text = plan(C.remove_duplicates(events, ["user_id"], "first", ["ts", "event_id"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "a int")
    assert C.duplicate_count(df).first()[0] == 3
    assert C.duplicate_count(df.limit(0)).first()[0] == 0


def test_distinct_values_leave_out_missing(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (NAN,), (None,), (2.0,)], "a double")
    assert [r[0] for r in C.distinct_values(df, "a").collect()] == [1.0, 2.0]


def test_drop_counts_nan_as_missing(gappy):
    assert [r.id for r in C.handle_missing_values(gappy, "drop").orderBy("id").collect()] == [1, 4, 5]
    assert [r.id for r in C.handle_missing_values(gappy, "drop", columns=["s"]).orderBy("id").collect()] == [1, 2, 4, 5]


def test_fill(gappy):
    filled = C.handle_missing_values(gappy, "fill", {"x": 0.0, "s": "?"}).orderBy("id").collect()
    assert [r.x for r in filled] == [1.0, 0.0, 0.0, 4.0, 10.0] and filled[2].s == "?"
    assert C.handle_missing_values(gappy, "fill") is gappy


def test_median_and_mean(gappy):
    assert [r.x for r in C.handle_missing_values(gappy, "median").orderBy("id").collect()] == [1.0, 4.0, 4.0, 4.0, 10.0]
    assert [r.x for r in C.handle_missing_values(gappy, "mean").orderBy("id").collect()] == [1.0, 5.0, 5.0, 4.0, 10.0]


def test_filled_integers_keep_fractions(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (4, 3)], "a int, b int")
    filled = C.handle_missing_values(df, "median")
    assert dict(filled.dtypes) == {"a": "int", "b": "int"} and rows(filled) == [(1, 1), (2, 2), (4, 3)]
    halves = C.handle_missing_values(spark.createDataFrame([(1,), (2,), (None,)], "a int"), "median")
    assert rows(halves) == [(1.0,), (1.5,), (2.0,)]


def test_columns_without_values_stay_missing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    assert rows(C.handle_missing_values(df, "median")) == [(None, 1), (None, 2)]
    assert rows(C.handle_missing_values(df, "mean")) == [(None, 1), (None, 2)]


def test_unknown_strategy(gappy):
    with pytest.raises(ValueError):
        C.handle_missing_values(gappy, "guess")


def test_strings_lose_tabs_and_newlines(spark):
    df = spark.createDataFrame([("\t Hello, World!\n", 1), (None, 2)], "s string, n int")
    assert rows(C.clean_string_columns(df)) == [("hello, world!", 1), (None, 2)]
    assert rows(C.clean_string_columns(df, remove_special_chars=True))[0] == ("hello world", 1)
    assert rows(C.clean_string_columns(df, ["absent"])) == rows(df)
    assert C.clean_string_columns(df, lowercase=False, trim_whitespace=False).first()[0] == "\t Hello, World!\n"


def _trips(spark, **changed):
    base = {"passenger_count": 1, "trip_distance": 1.0, "fare_amount": 1.0, "total_amount": 1.0, **changed}
    schema = "passenger_count int, trip_distance double, fare_amount double, total_amount double"
    return spark.createDataFrame([tuple(base.values())], schema)


@pytest.mark.parametrize(
    "changed, kept",
    [
        ({}, True),
        ({"passenger_count": 0}, False),
        ({"passenger_count": 8}, True),
        ({"passenger_count": 9}, False),
        ({"passenger_count": None}, False),
        ({"trip_distance": 0.0}, True),
        ({"trip_distance": -0.1}, False),
        ({"trip_distance": NAN}, False),
        ({"fare_amount": None}, False),
        ({"total_amount": -1.0}, True),
    ],
)
def test_ranges(spark, changed, kept):
    assert C.filter_valid_trips(_trips(spark, **changed)).count() == int(kept)


def test_total_is_checked_on_demand(spark):
    assert C.filter_valid_trips(_trips(spark, total_amount=-1.0), with_total=True).count() == 0


def test_date_window_includes_both_ends(spark):
    days = [(dt.datetime(2024, 1, d),) for d in (1, 2, 3, 4, 5)]
    df = spark.createDataFrame(days, "pickup_datetime timestamp_ntz")
    kept = C.filter_by_age(df, "pickup_datetime", F.expr("TIMESTAMP_NTZ'2024-01-05'"), (1, 3))
    assert [r[0].day for r in kept.orderBy("pickup_datetime").collect()] == [2, 3, 4]
    assert C.apply_filters(df, days=(0, 30)).count() == 0


def test_filters_reach_the_scan(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_suppkey AS vendor_id", "l_linenumber AS passenger_count", "l_tax")
    text = plan(C.apply_filters(lines, vendors=[1, 3], passengers=(2, 5)).select("vendor_id"))
    assert "In(l_suppkey, [1,3])" in text and "GreaterThanOrEqual(l_linenumber,2)" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int>" in text


def test_types(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", "bad", "7")], "pickup_datetime string, dropoff_datetime string, passenger_count string")
    row = C.convert_types(df).first()
    assert row.pickup_datetime == dt.datetime(2024, 1, 1, 10) and row.dropoff_datetime is None and row.passenger_count == 7
    checked = C.try_convert(spark.createDataFrame([("1",), ("x",), (None,)], "a string"), {"a": "int"})
    assert [(r.a, r.type_errors) for r in checked.collect()] == [(1, []), (None, ["a: not int"]), (None, [])]


def test_clean_data_counts(spark):
    schema = "trip_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, vendor_id int, passenger_count int, trip_distance double, fare_amount double, o int"
    day = dt.datetime(2024, 1, 6)
    data = [(1, day, day, 1, 1, 1.0, 1.0, 1), (1, day, day, 1, 1, 1.0, 1.0, 2), (2, day, day, 1, 9, 1.0, 1.0, 1), (3, None, day, 1, 1, 1.0, 1.0, 1)]
    cleaned, counts = C.clean_data(spark.createDataFrame(data, schema), ["o"])
    assert cleaned.count() == 1
    row = counts.first()
    assert (row.before_count, row.after_count, row.rows_removed, row.removal_rate, row.success_rate) == (4, 1, 3, 75.0, 25.0)
    assert tuple(C.removal_counts(spark, 0, 0).first()) == (0, 0, 0, 0.0, 0.0)


def test_clean_data_counts_come_from_the_files(spark, sf):
    """No counter runs inside the plan, so that a repeated task cannot count rows again."""
    lines = load_trips(spark, sf)
    first = C.with_copies(lines, ["trip_id"], TRIP_ORDER)
    assert first.agg(F.sum("_copies")).first()[0] == lines.count()
    assert rows(first.drop("_copies")) == rows(C.remove_duplicates(lines, ["trip_id"], order_by=TRIP_ORDER))
    cleaned, counts = C.clean_data(lines, TRIP_ORDER)
    assert "CollectMetrics" not in plan(first) + plan(cleaned) and counts.first()["before_count"] == lines.count()


def test_the_type_of_a_filled_whole_number_can_be_fixed(spark):
    gaps = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "a int, b bigint")
    full = spark.createDataFrame([(1, 1), (3, 2), (2, 3)], "a int, b bigint")
    for df in (gaps, full):
        assert [k for _, k in C.handle_missing_values(df, "median", whole_numbers="double").dtypes] == ["double", "double"]
        assert C.handle_missing_values(df, "median", whole_numbers="keep").dtypes == df.dtypes
    assert rows(C.handle_missing_values(gaps, "mean", whole_numbers="double")) == [(1.0, 1.0), (1.5, 3.0), (2.0, 2.0)]
    assert rows(C.handle_missing_values(gaps, "mean", whole_numbers="keep")) == [(1, 1), (2, 2), (2, 3)]
    with pytest.raises(ValueError):
        C.handle_missing_values(gaps, "mean", whole_numbers="int")


@pytest.mark.parametrize("keep", ["false", "passenger_count > 100"])
def test_clean_data_on_empty_input(spark, sf, keep):
    cleaned, counts = C.clean_data(load_trips(spark, sf).filter(keep), TRIP_ORDER)
    assert cleaned.count() == 0 and tuple(counts.first()) == (0, 0, 0, 0.0, 0.0)


def test_clean_data_that_rejects_every_row(spark, sf):
    lines = load_trips(spark, sf)
    cleaned, counts = C.clean_data(lines.withColumn("passenger_count", F.lit(99)), TRIP_ORDER)
    row = counts.first()
    assert cleaned.count() == 0 and (row.before_count, row.after_count, row.removal_rate) == (lines.count(), 0, 100.0)


@pytest.fixture(scope="module")
def outlying(spark):
    return spark.createDataFrame([(float(x), float(x % 5)) for x in range(20)] + [(1000.0, 2.0), (None, 2.0), (NAN, 2.0)], "a double, b double")


@pytest.mark.parametrize("method", ["iqr", "zscore"])
@pytest.mark.parametrize("sequential", [False, True])
def test_outliers_and_missing_values_go(outlying, method, sequential):
    kept = remove_outliers(outlying, ["a", "b"], method, 1.5, sequential)
    assert [r.a for r in kept.orderBy("a").collect()] == [float(x) for x in range(20)]


@pytest.mark.parametrize("method", ["iqr", "zscore"])
def test_sequential_bounds_compute_the_input_once(spark, outlying, method):
    seen = spark.sparkContext.accumulator(0)

    def traced(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kept = remove_outliers(outlying.mapInArrow(traced, outlying.schema), ["a", "b"], method, sequential=True)
    assert kept.count() == 20 and seen.value == 23


def test_approximate_bounds(outlying):
    assert remove_outliers(outlying, ["a"], accuracy=1000).count() == 20


def test_outliers_of_an_empty_or_constant_column(spark):
    assert remove_outliers(spark.createDataFrame([(None,)], "a double"), ["a"]).count() == 0
    constant = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    assert remove_outliers(constant, ["a"]).count() == 2
    assert remove_outliers(constant, ["a"], "zscore").count() == 0  # 0 / 0 is undefined
    with pytest.raises(ValueError):
        remove_outliers(constant, ["a"], "guess")


def test_trip_features(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 6, 23, 30), dt.datetime(2024, 1, 6, 22, 0, 30)), (dt.datetime(2024, 1, 8, 1), dt.datetime(2024, 1, 8, 2))],
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz",
    )
    saturday, monday = C.add_trip_features(df).orderBy("pickup_datetime").collect()
    assert math.isclose(saturday.trip_duration_minutes, -89.5) and saturday.hour_of_day == 23
    assert (saturday.day_of_week, saturday.is_weekend) == (5, True)
    assert (monday.trip_duration_minutes, monday.day_of_week, monday.is_weekend) == (60.0, 0, False)
