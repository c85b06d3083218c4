"""Join, rule and standardisation queries."""

from pyspark.sql import functions as F

from tablemill import functions as X
from tablemill.operators import enrich as E

from .common import WITH_TRIPS, table, trips

RULES_SQL = """list_filter([CASE WHEN l_quantity <= 45 THEN NULL ELSE 'quantity' END,
    CASE WHEN l_discount <= 0.08 THEN NULL ELSE 'discount' END,
    CASE WHEN l_returnflag <> 'R' THEN NULL ELSE 'returned' END], lambda x: x IS NOT NULL)"""


def _rules():
    return {
        "quantity": F.col("l_quantity") <= 45,
        "discount": F.col("l_discount") <= 0.08,
        "returned": F.col("l_returnflag") != "R",
    }


def _rejected(spark, sf):
    rejected = E.split_rejects(table(spark, sf, "lineitem"), _rules())[1]
    return rejected.withColumn("reject_reasons", F.array_join("reject_reasons", ","))


def _rollup(spark, sf):
    totals = {"lines": F.count(F.lit(1)), "quantity": F.sum("l_quantity"), "last_ship": F.max("l_shipdate")}
    return E.rollup_children(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", totals)


def _open_orders(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus <> 'F'")


def _golden(spark, sf):
    gappy = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
    )
    return E.golden_record(gappy, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


GOLDEN_SQL = """WITH g AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
        CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag, nullif(l_discount, 0) AS discount FROM lineitem),
    o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM g)
    SELECT l_orderkey, l_linenumber, min(l_shipdate) FILTER (WHERE rn = 1) AS l_shipdate,
        min(l_partkey) FILTER (WHERE rn = 1) AS l_partkey, min(l_suppkey) FILTER (WHERE rn = 1) AS l_suppkey,
        arg_min(flag, rn) FILTER (WHERE flag IS NOT NULL) AS flag,
        arg_min(discount, rn) FILTER (WHERE discount IS NOT NULL) AS discount,
        CAST((max(flag) IS NOT NULL AND bool_and(flag IS NULL) FILTER (WHERE rn = 1))::INTEGER
            + (max(discount) IS NOT NULL AND bool_and(discount IS NULL) FILTER (WHERE rn = 1))::INTEGER AS INTEGER) AS imputed_cells
    FROM o GROUP BY l_orderkey, l_linenumber"""


def _raw_customers(spark, sf):
    """Customers in the shape of the raw sample: untidy text, blank phones and shared addresses."""
    key = F.lpad(F.col("c_custkey").cast("string"), 7, "0")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("\t Person")).alias("name"),
        F.concat(F.lower("c_name"), F.lit("@mail.net")).alias("email"),
        F.lit("2025-10-15").cast("date").alias("signup_date"),
        F.when(F.col("c_acctbal") > 0, F.lit("ACTIVE")).otherwise("inactive").alias("status"),
        F.when(F.col("c_acctbal") > 5000, F.lit(" ")).otherwise(F.format_string("(%s) %s", F.left(key, F.lit(3)), F.right(key, F.lit(4)))).alias("phone"),
        F.when(F.col("c_nationkey") > 0, F.format_string("%d  Main St", "c_nationkey")).alias("address"),
        F.floor(F.col("c_acctbal") / 1000).cast("decimal(10,2)").alias("amount"),
    )


def _standardized(spark, sf):
    return E.standardize_customers(_raw_customers(spark, sf), F.lit("2026-01-13").cast("date"))


STANDARDIZED_SQL = r"""WITH tidy AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment || ' Person' AS name,
        lower(c_name) || '@mail.net' AS email, CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'Inactive' END AS status,
        CASE WHEN c_acctbal > 5000 THEN NULL ELSE lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS phone,
        CASE WHEN c_nationkey > 0 THEN c_nationkey || ' Main St' END AS address,
        CAST(floor(c_acctbal / 1000) AS DECIMAL(10,2)) AS amount FROM customer),
    o AS (SELECT *, row_number() OVER (PARTITION BY name, address, amount, CASE WHEN address IS NULL THEN id END ORDER BY id) AS rn FROM tidy),
    m AS (SELECT name, address, amount, min(id) AS id, arg_min(email, rn) AS email, arg_min(status, rn) AS status,
        arg_min(phone, rn) FILTER (WHERE phone IS NOT NULL) AS phone,
        max(phone) IS NOT NULL AND bool_and(phone IS NULL) FILTER (WHERE rn = 1) AS imputed
        FROM o GROUP BY name, address, amount, CASE WHEN address IS NULL THEN id END)
    SELECT 'CUST-' || CASE WHEN length(id) < 3 THEN lpad(id, 3, '0') ELSE id END AS customer_id, name AS customer_name,
        email AS email_address, DATE '2025-10-15' AS signup_date, status AS customer_status,
        '+1-' || phone[1:3] || '-' || phone[4:7] AS phone_number, address AS full_address, amount AS transaction_amount,
        DATE '2026-01-13' AS processed_date,
        100 - CASE WHEN imputed THEN 2 ELSE 0 END - CASE WHEN address IS NULL THEN 10 ELSE 0 END
            - CASE WHEN amount = 0 THEN 5 ELSE 0 END AS data_quality_score FROM m"""


CASES = {
    "enrich_join": (
        lambda spark, sf: E.enrich(
            table(spark, sf, "lineitem"),
            _open_orders(spark, sf).withColumnRenamed("o_orderkey", "l_orderkey"),
            ["l_orderkey"],
            ["o_custkey", "o_orderdate", "o_totalprice"],
        ),
        """SELECT lineitem.*, o_custkey, o_orderdate, o_totalprice FROM lineitem
           LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') ON l_orderkey = o_orderkey""",
    ),
    "lookup_dimension": (
        lambda spark, sf: E.lookup(
            table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey"),
            table(spark, sf, "nation"),
            ["n_nationkey"],
        ),
        "SELECT customer.* RENAME (c_nationkey AS n_nationkey), n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = nation.n_nationkey",
    ),
    "rollup_child": (
        _rollup,
        """SELECT orders.*, lines, quantity, last_ship FROM orders LEFT JOIN
           (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1)
           ON l_orderkey = o_orderkey""",
    ),
    "orphans": (
        lambda spark, sf: E.orphans(table(spark, sf, "lineitem"), _open_orders(spark, sf), "l_orderkey", "o_orderkey"),
        "SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')",
    ),
    "orphan_count": (
        lambda spark, sf: E.orphan_count(table(spark, sf, "lineitem"), _open_orders(spark, sf), "l_orderkey", "o_orderkey"),
        """SELECT 'l_orderkey' AS foreign_key, count(*) AS orphan_rows, count(DISTINCT l_orderkey) AS orphan_keys FROM lineitem
           WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')""",
    ),
    "rules_clean": (
        lambda spark, sf: E.split_rejects(table(spark, sf, "lineitem"), _rules())[0],
        "SELECT * FROM lineitem WHERE l_quantity <= 45 AND l_discount <= 0.08 AND l_returnflag <> 'R'",
    ),
    "rules_rejects": (
        _rejected,
        f"""SELECT * FROM (SELECT *, array_to_string({RULES_SQL}, ',') AS reject_reasons FROM lineitem) WHERE reject_reasons <> ''""",
    ),
    "golden_record": (_golden, GOLDEN_SQL),
    "customers_standardized": (_standardized, STANDARDIZED_SQL),
    "phone_norm": (
        lambda spark, sf: _raw_customers(spark, sf).select("customer_id", X.normalize_phone("phone").alias("phone")),
        """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_acctbal <= 5000 THEN
           '+1-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')[1:3] || '-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')[4:7] END AS phone
           FROM customer""",
    ),
    "status_norm": (
        lambda spark, sf: table(spark, sf, "customer").select("c_custkey", X.normalize_status("c_mktsegment").alias("status")),
        "SELECT c_custkey, c_mktsegment[1] || lower(c_mktsegment[2:]) AS status FROM customer",
    ),
    "id_norm": (
        lambda spark, sf: table(spark, sf, "customer").select("c_custkey", X.standard_id("c_custkey").alias("customer_id")),
        """SELECT c_custkey, 'CUST-' || CASE WHEN c_custkey < 100 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
           ELSE CAST(c_custkey AS VARCHAR) END AS customer_id FROM customer""",
    ),
    "whitespace_norm": (
        lambda spark, sf: table(spark, sf, "documents").select("doc_id", X.normalize_whitespace("text").alias("text")),
        r"""SELECT doc_id, regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g') AS text FROM documents""",
    ),
    "renamed_columns": (
        lambda spark, sf: E.rename_columns(table(spark, sf, "customer"), {"c_name": "customer_name", "c_acctbal": "balance"}),
        "SELECT * RENAME (c_name AS customer_name, c_acctbal AS balance) FROM customer",
    ),
    "calculated_fields": (
        lambda spark, sf: E.add_columns(
            trips(spark, sf).select("trip_id", "fare_amount", "trip_distance", "total_amount"),
            {"fare_per_mile": F.try_divide("fare_amount", "trip_distance"), "extras": F.col("total_amount") - F.col("fare_amount")},
        ),
        f"""{WITH_TRIPS} SELECT trip_id, fare_amount, trip_distance, total_amount, fare_amount / trip_distance AS fare_per_mile,
            total_amount - fare_amount AS extras FROM trips""",
    ),
}
