"""Aggregation queries."""

from pyspark.sql import functions as F

from tablemill.operators import aggregates as A
from tablemill.operators.quantiles import exact_quantiles

from .common import WITH_TRIPS, round_doubles, table, trips

NAMES = {
    "sum": "sum",
    "avg": "avg",
    "count": "count",
    "min": "min",
    "max": "max",
    "stddev": "stddev_samp",
    "variance": "var_samp",
}


def _simple(function):
    def query(spark, sf):
        lines = table(spark, sf, "lineitem")
        return round_doubles(A.simple_aggregation(lines, ["l_returnflag", "l_linestatus"], {"l_extendedprice": function}))

    return query


def _simple_sql(function):
    value = f"{NAMES[function]}(l_extendedprice)"
    value = value if function == "count" else f"round({value}, 2)"
    return f"""SELECT l_returnflag, l_linestatus, {value} AS l_extendedprice_{function}
        FROM lineitem GROUP BY l_returnflag, l_linestatus"""


def _pivot(function):
    def query(spark, sf):
        lines = table(spark, sf, "lineitem")
        return round_doubles(A.pivot_aggregation(lines, ["l_linenumber"], "l_returnflag", "l_quantity", function, ["A", "N", "R"]))

    return query


def _pivot_sql(function):
    def cell(flag):
        value = f"{NAMES[function]}(l_quantity) FILTER (WHERE l_returnflag = '{flag}')"
        # An empty cell is NULL in a pivot, also for counts.
        value = f"nullif({value}, 0)" if function == "count" else f"round({value}, 2)"
        return f'{value} AS "{flag}"'

    return f"SELECT l_linenumber, {', '.join(map(cell, 'ANR'))} FROM lineitem GROUP BY l_linenumber"


def _percentile(spark, sf):
    made = A.percentile_aggregation(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.75, 0.29])
    return round_doubles(made, 4)


def _quantiles_of_large_groups(spark, sf):
    """The bracket method for every group above a thousand values."""
    lines = table(spark, sf, "lineitem")
    found = exact_quantiles(lines, ["l_extendedprice", "l_quantity"], [0.1, 0.5, 0.9], ["l_returnflag"], small_group=1000)
    parts = [F.round(F.col("quantiles")[i], 4).alias(name) for i, name in enumerate(("p10", "p50", "p90"))]
    return found.select("l_returnflag", "column", "n", *parts)


def _large_groups_sql(name):
    quantiles = ", ".join(f"round(quantile_cont({name}, {p / 100}), 4) AS p{p}" for p in (10, 50, 90))
    return f"""SELECT l_returnflag, '{name}' AS "column", count({name}) AS n, {quantiles} FROM lineitem GROUP BY l_returnflag"""


def _histogram(column, bins):
    return lambda spark, sf: round_doubles(A.histogram(trips(spark, sf), column, bins), 6)


def histogram_sql(column, bins, groups=""):
    by = f"{groups}, " if groups else ""
    key = f"USING ({groups})" if groups else "ON true"
    group = f"GROUP BY {groups}" if groups else ""
    return f"""{WITH_TRIPS}, v AS (SELECT {by}CAST({column} AS DOUBLE) AS x FROM trips WHERE {column} IS NOT NULL),
        s AS (SELECT {by}min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM v {group}),
        c AS (SELECT {by}CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
            FROM v JOIN s {key} GROUP BY ALL)
        SELECT {'s.' + by if by else ''}CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 6) AS bin_start,
            round(lo + (b.bin + 1) * w, 6) AS bin_end, coalesce(c.n, 0) AS n
        FROM s CROSS JOIN range({bins}) b(bin) LEFT JOIN c ON c.bin = b.bin {f'AND c.{groups} = s.{groups}' if groups else ''}"""


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


def _describe_sql(quartiles):
    def part(name):
        more = "".join(
            f", round(quantile_cont({name}, {q}), 4) AS q{round(q * 100)}" for q in ((0.25, 0.5, 0.75) if quartiles else ())
        )
        return f"""SELECT '{name}' AS "column", count({name}) AS count, round(avg({name}), 4) AS mean,
            round(stddev_samp({name}), 4) AS stddev, min({name}) AS min, max({name}) AS max{more} FROM lineitem"""

    return " UNION ALL ".join(map(part, DESCRIBED))


CASES = {
    **{f"agg_{f}": (_simple(f), _simple_sql(f)) for f in NAMES},
    "agg_percentile": (
        _percentile,
        """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
           round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, round(quantile_cont(l_extendedprice, 0.29), 4) AS p29
           FROM lineitem GROUP BY l_returnflag""",
    ),
    "quantiles_large_groups": (
        _quantiles_of_large_groups,
        " UNION ALL ".join(map(_large_groups_sql, ("l_extendedprice", "l_quantity"))),
    ),
    **{f"pivot_{f}": (_pivot(f), _pivot_sql(f)) for f in ("sum", "avg", "count", "min", "max")},
    "crosstab": (
        lambda spark, sf: A.crosstab(trips(spark, sf), "vendor_id", "passenger_count"),
        f"""{WITH_TRIPS} SELECT vendor_id, {', '.join(f'count(*) FILTER (WHERE passenger_count = {i}) AS "{i}"' for i in range(1, 8))}
            FROM trips GROUP BY vendor_id""",
    ),
    "hist_30": (_histogram("trip_distance", 30), histogram_sql("trip_distance", 30)),
    "hist_fare_50": (_histogram("fare_amount", 50), histogram_sql("fare_amount", 50)),
    "hist_speed_25": (_histogram("speed_mph", 25), histogram_sql("speed_mph", 25)),
    "hist_by_vendor": (
        lambda spark, sf: round_doubles(A.histogram_by_group(trips(spark, sf), "speed_mph", ["vendor_id"], 30), 6),
        histogram_sql("speed_mph", 30, "vendor_id"),
    ),
    "describe": (
        lambda spark, sf: round_doubles(A.describe(table(spark, sf, "lineitem"), DESCRIBED), 4),
        _describe_sql(False),
    ),
    "describe_quartiles": (
        lambda spark, sf: round_doubles(A.describe_quartiles(table(spark, sf, "lineitem"), DESCRIBED), 4),
        _describe_sql(True),
    ),
    "sort_limit": (
        lambda spark, sf: A.sort_limit(
            table(spark, sf, "orders"), "o_totalprice", "o_orderkey", rows=50, ascending=False
        ),
        "SELECT * FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50",
    ),
    "sort_limit_ascending": (
        lambda spark, sf: A.sort_limit(table(spark, sf, "orders"), "o_orderdate", "o_orderkey", rows=1000),
        "SELECT * FROM orders ORDER BY o_orderdate ASC NULLS LAST, o_orderkey LIMIT 1000",
    ),
    "preview": (
        lambda spark, sf: A.preview(table(spark, sf, "events"), ["ts", "event_id"], 5),
        "SELECT * FROM events ORDER BY ts, event_id LIMIT 5",
    ),
    "union_append": (
        lambda spark, sf: A.append_rows(
            table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment"),
            table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")),
        ),
        """SELECT c_custkey AS id, c_name AS name, c_mktsegment FROM customer
           UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
    ),
}
