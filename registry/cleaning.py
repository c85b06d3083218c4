"""Cleaning queries."""

from pyspark.sql import functions as F

from tablemill.operators import cleaning as C
from tablemill.operators.aggregates import append_rows
from tablemill.operators.outliers import remove_outliers
from tablemill.operators.windows import forward_fill

from .common import TRIP_ORDER, WITH_GAPPY, WITH_PREPARED, WITH_TRIPS, WITH_UNIQUE, gappy_events, table, trips

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
AS_OF = "TIMESTAMP_NTZ'1998-12-31 00:00:00'"


def _twice(spark, sf):
    lines = table(spark, sf, "lineitem")
    return append_rows(lines, lines)


def _keep(keep):
    return lambda spark, sf: C.remove_duplicates(table(spark, sf, "lineitem"), LINE_KEY, keep, LINE_REST)


def _keep_sql(direction):
    order = ", ".join(f"{c} {direction}" for c in LINE_REST)
    return f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"


def _clean_strings(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return C.clean_string_columns(docs, remove_special_chars=True)


def _text_times(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
        F.col("event_type").alias("dropoff_datetime"),
        F.col("user_id").alias("passenger_count"),
    )
    converted = C.convert_types(events)
    return converted.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")})


def _type_errors(spark, sf):
    mixed = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.col("p_size").cast("string")).alias("size")
    )
    return C.try_convert(mixed, {"size": "int"}).withColumn("type_errors", F.array_join("type_errors", ";"))


def _outliers(method, threshold, sequential):
    def query(spark, sf):
        rides = trips(spark, sf).select("trip_id", "tip_amount", "total_amount")
        return remove_outliers(rides, ["tip_amount", "total_amount"], method, threshold, sequential)

    return query


IQR_BOUNDS = """{name} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source})"""
IQR_KEEP = "{c} >= q1 - 0.25 * (q3 - q1) AND {c} <= q3 + 0.25 * (q3 - q1)"
Z_BOUNDS = """{name} AS (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {source})"""
Z_KEEP = "abs(({c} - m) / s) < 1.5"


def _independent_sql(bounds, keep):
    one, two = bounds.format(name="b1", c="tip_amount", source="trips"), bounds.format(name="b2", c="total_amount", source="trips")
    return (
        f"{WITH_TRIPS}, {one}, {two}, kept AS (SELECT trips.* FROM trips, b1 WHERE {keep.format(c='tip_amount')}) "
        f"SELECT trip_id, tip_amount, total_amount FROM kept, b2 WHERE {keep.format(c='total_amount')}"
    )


def _sequential_sql(bounds, keep):
    one, two = bounds.format(name="b1", c="tip_amount", source="trips"), bounds.format(name="b2", c="total_amount", source="kept")
    return (
        f"{WITH_TRIPS}, {one}, kept AS (SELECT trips.* FROM trips, b1 WHERE {keep.format(c='tip_amount')}), {two} "
        f"SELECT trip_id, tip_amount, total_amount FROM kept, b2 WHERE {keep.format(c='total_amount')}"
    )


def _clean_counts(spark, sf):
    return C.clean_data(trips(spark, sf), TRIP_ORDER)[1]


VALID = "passenger_count > 0 AND passenger_count <= 8 AND trip_distance >= 0 AND fare_amount >= 0"
CLEAN_SQL = f"""SELECT * FROM unique_trips WHERE pickup_datetime IS NOT NULL AND vendor_id IS NOT NULL
    AND passenger_count IS NOT NULL AND {VALID}"""


# Orders with a whole number and a decimal that have gaps.
PRICED = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey END AS quantity,
    CASE WHEN o_orderkey % 3 > 0 THEN CAST(round(o_totalprice, 2) AS DECIMAL(12, 2)) END AS price FROM {orders}"""


def _priced(spark, sf):
    return spark.sql(PRICED, orders=table(spark, sf, "orders"))


CASES = {
    "dedup_all": (
        lambda spark, sf: C.remove_duplicates(_twice(spark, sf)),
        "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)",
    ),
    "dedup_subset": (
        lambda spark, sf: C.remove_duplicates(table(spark, sf, "lineitem"), LINE_KEY).select(*LINE_KEY),
        "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    ),
    "dedup_keep_first": (_keep("first"), _keep_sql("ASC")),
    "dedup_keep_last": (_keep("last"), _keep_sql("DESC")),
    "dedup_trips": (
        lambda spark, sf: C.remove_duplicates(trips(spark, sf), ["trip_id"], order_by=TRIP_ORDER),
        f"{WITH_UNIQUE} SELECT * FROM unique_trips",
    ),
    "duplicate_count": (
        lambda spark, sf: C.duplicate_count(table(spark, sf, "lineitem").select(*LINE_KEY)),
        """SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT)
           AS duplicate_rows FROM lineitem""",
    ),
    "distinct_values": (
        lambda spark, sf: C.distinct_values(trips(spark, sf), "vendor_id"),
        f"{WITH_TRIPS} SELECT DISTINCT vendor_id FROM trips WHERE vendor_id IS NOT NULL ORDER BY vendor_id",
    ),
    "drop_missing": (
        lambda spark, sf: C.handle_missing_values(gappy_events(spark, sf), "drop"),
        f"{WITH_GAPPY} SELECT * FROM gappy WHERE value IS NOT NULL AND referrer IS NOT NULL",
    ),
    "drop_missing_subset": (
        lambda spark, sf: C.handle_missing_values(gappy_events(spark, sf), "drop", columns=["value"]),
        f"{WITH_GAPPY} SELECT * FROM gappy WHERE value IS NOT NULL",
    ),
    "fill_const": (
        lambda spark, sf: C.handle_missing_values(gappy_events(spark, sf), "fill", {"value": 0.0, "referrer": -1}),
        f"{WITH_GAPPY} SELECT * REPLACE (coalesce(value, 0.0) AS value, coalesce(referrer, -1) AS referrer) FROM gappy",
    ),
    "fill_median": (
        lambda spark, sf: C.handle_missing_values(gappy_events(spark, sf), "median", columns=["value"]),
        f"{WITH_GAPPY} SELECT * REPLACE (coalesce(value, (SELECT median(value) FROM gappy)) AS value) FROM gappy",
    ),
    "fill_mean": (
        lambda spark, sf: C.handle_missing_values(gappy_events(spark, sf), "mean", columns=["value"]).withColumn(
            "value", F.round("value", 6)
        ),
        f"{WITH_GAPPY} SELECT * REPLACE (round(coalesce(value, (SELECT avg(value) FROM gappy)), 6) AS value) FROM gappy",
    ),
    "fill_decimal": (
        lambda spark, sf: C.handle_missing_values(_priced(spark, sf), "median", columns=["price"]),
        f"""WITH priced AS ({PRICED.format(orders='orders')}) SELECT o_orderkey, quantity,
            coalesce(price, CAST((SELECT median(CAST(price AS DOUBLE)) FROM priced) AS DECIMAL(12, 2))) AS price FROM priced""",
    ),
    "fill_bigint_double": (
        lambda spark, sf: C.handle_missing_values(_priced(spark, sf), "mean", columns=["o_orderkey", "quantity"], whole_numbers="double").withColumn(
            "quantity", F.round("quantity", 6)
        ),
        f"""WITH priced AS ({PRICED.format(orders='orders')}) SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey,
            round(coalesce(quantity, (SELECT avg(quantity) FROM priced)), 6) AS quantity, price FROM priced""",
    ),
    "fill_bigint_keep": (
        lambda spark, sf: C.handle_missing_values(_priced(spark, sf), "mean", columns=["o_orderkey", "quantity"], whole_numbers="keep"),
        f"""WITH priced AS ({PRICED.format(orders='orders')}) SELECT o_orderkey,
            coalesce(quantity, CAST(round(CAST((SELECT avg(quantity) FROM priced) AS DOUBLE)) AS BIGINT)) AS quantity, price FROM priced""",
    ),
    "fill_median_tip": (
        lambda spark, sf: C.handle_missing_values(trips(spark, sf), "median", columns=["tip_amount"]),
        f"{WITH_TRIPS} SELECT * REPLACE (coalesce(tip_amount, (SELECT median(tip_amount) FROM trips)) AS tip_amount) FROM trips",
    ),
    "ffill": (
        lambda spark, sf: forward_fill(gappy_events(spark, sf), ["ts", "event_id"], ["user_id"], ["value", "referrer"]),
        f"""{WITH_GAPPY} SELECT * REPLACE (
            last_value(value IGNORE NULLS) OVER w AS value, last_value(referrer IGNORE NULLS) OVER w AS referrer)
            FROM gappy WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
    "ffill_whole_table": (
        lambda spark, sf: forward_fill(gappy_events(spark, sf), ["event_id"], columns=["value"], hot_rows=1000),
        f"""{WITH_GAPPY} SELECT * REPLACE (last_value(value IGNORE NULLS) OVER w AS value)
            FROM gappy WINDOW w AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
    "clean_strings": (
        _clean_strings,
        r"""SELECT doc_id,
            regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '[^a-zA-Z0-9 ]', '', 'g') AS text,
            regexp_replace(lower(regexp_replace(lang, '^\s+|\s+$', '', 'g')), '[^a-zA-Z0-9 ]', '', 'g') AS lang,
            regexp_replace(lower(regexp_replace(source, '^\s+|\s+$', '', 'g')), '[^a-zA-Z0-9 ]', '', 'g') AS source
            FROM documents""",
    ),
    "valid_ranges": (
        lambda spark, sf: C.filter_valid_trips(trips(spark, sf)),
        f"{WITH_TRIPS} SELECT * FROM trips WHERE {VALID}",
    ),
    "valid_ranges_total": (
        lambda spark, sf: C.filter_valid_trips(trips(spark, sf), with_total=True),
        f"{WITH_TRIPS} SELECT * FROM trips WHERE {VALID} AND total_amount >= 0",
    ),
    "filter_age": (
        lambda spark, sf: C.filter_by_age(trips(spark, sf), "pickup_datetime", F.expr(AS_OF), (30, 400)),
        f"""{WITH_TRIPS} SELECT * FROM trips WHERE pickup_datetime BETWEEN TIMESTAMP '1998-12-31' - INTERVAL 400 DAY
            AND TIMESTAMP '1998-12-31' - INTERVAL 30 DAY""",
    ),
    "filter_vendor": (
        lambda spark, sf: C.apply_filters(trips(spark, sf), vendors=[1, 3]),
        f"{WITH_TRIPS} SELECT * FROM trips WHERE vendor_id IN (1, 3)",
    ),
    "filter_passengers": (
        lambda spark, sf: C.apply_filters(trips(spark, sf), passengers=(2, 5)),
        f"{WITH_TRIPS} SELECT * FROM trips WHERE passenger_count BETWEEN 2 AND 5",
    ),
    "filters": (
        lambda spark, sf: C.apply_filters(trips(spark, sf), F.expr(AS_OF), (0, 1000), [1, 3], (2, 5)),
        f"""{WITH_TRIPS} SELECT * FROM trips WHERE pickup_datetime BETWEEN TIMESTAMP '1998-12-31' - INTERVAL 1000 DAY
            AND TIMESTAMP '1998-12-31' AND vendor_id IN (1, 3) AND passenger_count BETWEEN 2 AND 5""",
    ),
    "type_conversion": (
        _text_times,
        """SELECT event_id, date_trunc('second', ts) AS pickup_datetime, TRY_CAST(event_type AS TIMESTAMP) AS dropoff_datetime,
           CAST(user_id AS INTEGER) AS passenger_count FROM events""",
    ),
    "type_errors": (
        _type_errors,
        """SELECT p_partkey, CASE WHEN p_size > 25 THEN NULL ELSE p_size END AS size,
           CASE WHEN p_size > 25 THEN 'size: not int' ELSE '' END AS type_errors FROM part""",
    ),
    "missing_rows": (
        lambda spark, sf: C.missing_rows(trips(spark, sf), "tip_amount"),
        f"{WITH_TRIPS} SELECT * FROM trips WHERE tip_amount IS NULL",
    ),
    "outlier_iqr_independent": (_outliers("iqr", 0.25, False), _independent_sql(IQR_BOUNDS, IQR_KEEP)),
    "outlier_iqr_sequential": (_outliers("iqr", 0.25, True), _sequential_sql(IQR_BOUNDS, IQR_KEEP)),
    "outlier_z_independent": (_outliers("zscore", 1.5, False), _independent_sql(Z_BOUNDS, Z_KEEP)),
    "outlier_z_sequential": (_outliers("zscore", 1.5, True), _sequential_sql(Z_BOUNDS, Z_KEEP)),
    "clean_trips": (
        lambda spark, sf: C.clean_data(trips(spark, sf), TRIP_ORDER)[0],
        f"{WITH_UNIQUE} {CLEAN_SQL}",
    ),
    "clean_counts": (
        _clean_counts,
        f"""{WITH_UNIQUE}, cleaned AS ({CLEAN_SQL}), n AS (
            SELECT (SELECT count(*) FROM trips) AS b, (SELECT count(*) FROM cleaned) AS a)
            SELECT b AS before_count, a AS after_count, b - a AS rows_removed,
            100.0::DOUBLE * (b - a) / b AS removal_rate, 100.0::DOUBLE * a / b AS success_rate FROM n""",
    ),
    "prepare_trips": (
        lambda spark, sf: C.prepare_trips(trips(spark, sf), TRIP_ORDER),
        f"{WITH_PREPARED} SELECT * FROM prepared",
    ),
}
