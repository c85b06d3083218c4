"""Feature queries."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablemill.functions import duration_minutes
from tablemill.operators.cleaning import add_trip_features
from tablemill.operators.features import (
    create_categorical_features,
    create_date_features,
    create_first_date_features,
    create_numerical_features,
)
from tablemill.operators.windows import HOT_ROWS, create_window_features, rolling_average

from .common import TRIP_FEATURES, WITH_TRIPS, table, trips

DATE_PARTS = """CAST(year(ts) AS INTEGER) AS {p}year, CAST(month(ts) AS INTEGER) AS {p}month,
    CAST(day(ts) AS INTEGER) AS {p}day, CAST(hour(ts) AS INTEGER) AS {p}hour, CAST(minute(ts) AS INTEGER) AS {p}minute,
    CAST(quarter(ts) AS INTEGER) AS {p}quarter, CAST(isodow(ts) - 1 AS INTEGER) AS {p}dayofweek,
    isodow(ts) IN (6, 7) AS {p}is_weekend"""

SHIFTED = "SELECT l_orderkey, l_linenumber, l_quantity - 25 AS q FROM lineitem"


def _numeric(use_abs):
    def query(spark, sf):
        lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 25).alias("q"))
        made = create_numerical_features(lines, ["q"], ["sqrt", "log", "square", "reciprocal", "abs"], use_abs)
        root = F.when(~F.isnan("q_sqrt"), F.col("q_sqrt"))  # the oracle has no NaN root
        return made.withColumns({"q_sqrt": F.round(root, 9), "q_log": F.round("q_log", 9), "q_reciprocal": F.round("q_reciprocal", 9)})

    return query


def _numeric_sql(argument):
    return f"""SELECT *, round(CASE WHEN {argument} >= 0 THEN sqrt(abs({argument})) END, 9) AS q_sqrt,
        round(CASE WHEN {argument} > -1 THEN ln(abs({argument} + 1)) END, 9) AS q_log, q * q AS q_square,
        round(1 / nullif(q + 1, 0), 9) AS q_reciprocal, abs(q) AS q_abs FROM ({SHIFTED})"""


def _window(function):
    def query(spark, sf):
        return create_window_features(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], {"value": function})

    return query


def _window_sql(expression, name):
    return f"SELECT *, {expression} OVER (PARTITION BY user_id ORDER BY ts, event_id) AS {name} FROM events"


def _window_hot(spark, sf):
    functions = {"value": ["lag", "lead", "row_number", "rank"]}
    return create_window_features(table(spark, sf, "events"), ["event_type"], ["ts", "event_id"], functions, hot_rows=500)


# One order column of each kind, in Spark's SQL and in DuckDB's. Every other part's name is upper case in the collated one.
ORDERS = {
    "text": ("'Part name ' || p_name", "'Part name ' || p_name"),
    "collated": ("collate(if(p_partkey % 2 > 0, upper(p_name), p_name), 'UTF8_LCASE')", "lower(p_name)"),
    "binary": ("unhex(md5(p_name))", "md5(p_name)"),
}
EVERY = ["lag", "lead", "row_number", "rank"]
EVERY_SQL = """lag(p_retailprice) OVER w AS p_retailprice_lag1, lead(p_retailprice) OVER w AS p_retailprice_lead1,
    row_number() OVER w AS p_retailprice_row_num"""


def _ordered(kind, hot_rows):
    """Lag, lead and row number along a text, collated or binary column, and the rank along it alone."""

    def query(spark, sf):
        parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_name", "p_retailprice", F.expr(ORDERS[kind][0]).alias("o"))
        made = create_window_features(parts, ["p_size"], ["o", "p_partkey"], {"p_retailprice": EVERY[:3]}, hot_rows)
        ranked = create_window_features(made, ["p_size"], ["o"], {"o": "rank"}, hot_rows)
        return ranked.select("p_partkey", *(f"p_retailprice_{s}" for s in ("lag1", "lead1", "row_num")), "o_rank")

    return query


def _ordered_sql(kind):
    return f"""SELECT p_partkey, {EVERY_SQL}, rank() OVER (PARTITION BY p_size ORDER BY o) AS o_rank
        FROM (SELECT *, {ORDERS[kind][1]} AS o FROM part) WINDOW w AS (PARTITION BY p_size ORDER BY o, p_partkey)"""


def _two_columns(hot_rows):
    def query(spark, sf):
        orders = table(spark, sf, "orders")
        return create_window_features(orders, ["o_orderstatus"], ["o_orderpriority", "o_orderkey"], {"o_totalprice": EVERY}, hot_rows)

    return query


TWO_COLUMNS_SQL = """SELECT *, lag(o_totalprice) OVER w AS o_totalprice_lag1, lead(o_totalprice) OVER w AS o_totalprice_lead1,
    row_number() OVER w AS o_totalprice_row_num, rank() OVER w AS o_totalprice_rank
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderkey)"""


def _onehot(spark, sf):
    encoded = create_categorical_features(table(spark, sf, "events"), "event_type", "onehot")
    return encoded.select(
        "event_id", F.to_json(vector_to_array("event_type_encoded").cast("array<int>")).alias("event_type_encoded")
    )


LABELS = """labels_of AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS i
    FROM events GROUP BY event_type)"""

CASES = {
    "date_features": (
        lambda spark, sf: create_date_features(table(spark, sf, "events").select("event_id", "ts"), "ts", "event"),
        f"SELECT event_id, ts, {DATE_PARTS.format(p='event_')} FROM events",
    ),
    "first_date_features": (
        lambda spark, sf: create_first_date_features(table(spark, sf, "events").select("event_id", "event_type", "ts")),
        f"SELECT event_id, event_type, ts, {DATE_PARTS.format(p='')} FROM events",
    ),
    "duration_minutes": (
        lambda spark, sf: trips(spark, sf).select(
            "trip_id", "fare_amount", duration_minutes("pickup_datetime", "dropoff_datetime").alias("minutes")
        ),
        f"{WITH_TRIPS} SELECT trip_id, fare_amount, date_diff('microsecond', pickup_datetime, dropoff_datetime) / 6e7 AS minutes FROM trips",
    ),
    "trip_features": (
        lambda spark, sf: add_trip_features(trips(spark, sf)),
        f"{WITH_TRIPS} SELECT *, {TRIP_FEATURES} FROM trips",
    ),
    "numeric_features": (_numeric(False), _numeric_sql("q")),
    "numeric_features_abs": (_numeric(True), _numeric_sql("abs(q)")),
    "win_lag": (_window("lag"), _window_sql("lag(value)", "value_lag1")),
    "win_lead": (_window("lead"), _window_sql("lead(value)", "value_lead1")),
    "win_row_number": (_window("row_number"), _window_sql("row_number()", "value_row_num")),
    "win_rank": (_window("rank"), _window_sql("rank()", "value_rank")),
    "win_hot_partitions": (
        _window_hot,
        """SELECT *, lag(value) OVER w AS value_lag1, lead(value) OVER w AS value_lead1,
           row_number() OVER w AS value_row_num, rank() OVER w AS value_rank
           FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
    ),
    "win_rolling_avg": (
        lambda spark, sf: rolling_average(table(spark, sf, "events"), "value", ["user_id"], ["ts", "event_id"], 3).withColumn(
            "value_rolling_avg", F.round("value_rolling_avg", 6)
        ),
        """SELECT *, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6)
           AS value_rolling_avg FROM events""",
    ),
    "win_rolling_hot": (
        lambda spark, sf: rolling_average(
            table(spark, sf, "events"), "value", ["event_type"], ["ts", "event_id"], 5, hot_rows=500
        ).withColumn("value_rolling_avg", F.round("value_rolling_avg", 6)),
        """SELECT *, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6)
           AS value_rolling_avg FROM events""",
    ),
    "win_tied_order": (
        lambda spark, sf: create_window_features(
            table(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", "l_quantity", "l_orderkey"),
            ["l_returnflag"],
            ["l_linenumber", "l_quantity"],
            {"l_quantity": "rank"},
            hot_rows=500,
        ),
        """SELECT l_returnflag, l_linenumber, l_quantity, l_orderkey,
           rank() OVER (PARTITION BY l_returnflag ORDER BY l_linenumber, l_quantity) AS l_quantity_rank FROM lineitem""",
    ),
    **{f"win_{kind}_order": (_ordered(kind, HOT_ROWS), _ordered_sql(kind)) for kind in ORDERS},
    **{f"win_{kind}_order_hot": (_ordered(kind, 10), _ordered_sql(kind)) for kind in ORDERS},
    "win_two_columns": (_two_columns(HOT_ROWS), TWO_COLUMNS_SQL),
    "win_two_columns_hot": (_two_columns(400), TWO_COLUMNS_SQL),
    "label_encode_many": (
        lambda spark, sf: create_categorical_features(
            table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name", "label"
        ),
        """SELECT c_custkey, c_name, CAST(i AS DOUBLE) AS c_name_encoded FROM customer JOIN
           (SELECT c_name, row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS i FROM customer GROUP BY c_name) USING (c_name)""",
    ),
    "label_encode": (
        lambda spark, sf: create_categorical_features(table(spark, sf, "events"), "event_type", "label"),
        f"WITH {LABELS} SELECT events.*, CAST(i AS DOUBLE) AS event_type_encoded FROM events JOIN labels_of USING (event_type)",
    ),
    "onehot": (
        _onehot,
        f"""WITH {LABELS}, slots AS (SELECT i AS slot FROM labels_of WHERE i < (SELECT max(i) FROM labels_of)),
            coded AS (SELECT event_type, '[' || string_agg(CASE WHEN i = slot THEN '1' ELSE '0' END, ',' ORDER BY slot) || ']' AS code
                FROM labels_of, slots GROUP BY event_type)
            SELECT event_id, code AS event_type_encoded FROM events JOIN coded USING (event_type)""",
    ),
}
