import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan, rows
from tablemill.operators import enrich as E
from tablemill.operators import profiling as Q

NAN = float("nan")


@pytest.fixture(scope="module")
def gappy(spark):
    return spark.createDataFrame([(1, 1.0), (1, 1.0), (2, NAN), (2, None), (None, None)], "a int, b double")


def test_quality_report(gappy):
    made = {r["column"]: r for r in Q.quality_report(gappy).collect()}
    assert made["a"].missing_count == 1 and made["b"].missing_count == 3
    assert made["b"].missing_pct == 60.0 and made["a"].data_type == "int"
    assert (made["a"].total_rows, made["a"].duplicate_rows, made["a"].total_columns) == (5, 1, 2)


def test_reports_on_an_empty_table(gappy):
    empty = gappy.limit(0)
    for made in (Q.quality_report(empty), Q.missing_report(empty)):
        assert [(r.missing_count, r.missing_pct, r.total_rows) for r in made.collect()] == [(0, 0.0, 0)] * 2
    assert Q.completeness(empty).first()["completeness_pct"] == 100.0


def test_completeness(gappy):
    row = Q.completeness(gappy).first()
    assert row.missing_cells == 4 and row.completeness_pct == pytest.approx(60.0)


def test_schema_checks(gappy):
    assert Q.validate_schema(gappy, gappy.schema)
    expected = T.StructType([T.StructField("b", T.DoubleType()), T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    assert not Q.validate_schema(gappy, expected)
    found = {r["column"]: r.status for r in Q.schema_diff(gappy, expected).collect()}
    assert found == {"b": "position differs", "a": "type differs", "c": "missing"}
    assert Q.validate_data(gappy) and not Q.validate_data(gappy.limit(0)) and not Q.validate_data(None)


def test_quality_dimensions(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 20), (2, "b", None), (3, "c", 7)], "id int, s string, n int")
    row = Q.quality_dimensions(df, ["id", "s"], {"n": F.col("n") < 10}, {"n": F.col("n") > 0}, ["id"]).first()
    assert (row.completeness, row.validity, row.consistency, row.uniqueness) == (87.5, 50.0, 75.0, 75.0)


def test_lookup_broadcasts_only_what_it_counted(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet").withColumnRenamed("c_nationkey", "n_nationkey")
    nations = spark.read.parquet(f"{sf}/nation.parquet")
    assert "BroadcastHashJoin" in plan(E.lookup(customers, nations, ["n_nationkey"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(E.lookup(customers, nations, ["n_nationkey"], max_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_enrich_keeps_rows_without_a_match(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    reference = spark.createDataFrame([(1, "x", 0)], "id int, name string, other int")
    assert rows(E.enrich(left, reference, ["id"], ["name"])) == [(1, "x"), (2, None), (None, None)]


def test_children_and_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, 5), (1, 6), (9, 7), (9, 8), (None, 1)], "parent_id int, n int")
    assert rows(E.rollup_children(parent, child, "id", "parent_id", {"total": F.sum("n")})) == [(1, 11), (2, None)]
    assert rows(E.orphans(child, parent, "parent_id", "id")) == [(9, 7), (9, 8)]
    assert tuple(E.orphan_count(child, parent, "parent_id", "id").first()) == ("parent_id", 2, 1)


def test_rejects_carry_their_reasons(spark):
    df = spark.createDataFrame([(1, 1), (2, -1), (3, None), (None, -1)], "id int, n int")
    good, bad = E.split_rejects(df, {"id given": F.col("id").isNotNull(), "positive": F.col("n") > 0})
    assert rows(good) == [(1, 1)]
    assert rows(bad) == [(2, -1, ["positive"]), (3, None, ["positive"]), (None, -1, ["id given", "positive"])]
    assert good.count() + bad.count() == df.count()


CUSTOMERS = [
    ("001", "John Doe", "john@example.com", dt.date(2025, 10, 15), "ACTIVE", "555-1234", "123 Main St", Decimal("1500.50")),
    ("002", "Jane Smith", "jane@domain.org", dt.date(2025, 10, 16), "INACTIVE", "555-5678", "456 Oak Ave", Decimal("2300.00")),
    ("003", "Bob Johnson", "bob@mail.net", dt.date(2025, 10, 17), "ACTIVE", "", "789 Pine Rd", Decimal("800.75")),
    ("004", "Bob Johnson ", "bob_johnson@email.com", dt.date(2025, 10, 18), "ACTIVE", "555-9012", "789  Pine Rd", Decimal("800.75")),
    ("005", "Alice Brown", "alice@test.org", dt.date(2025, 10, 19), "PENDING", "(555)1111", None, Decimal("0")),
    ("006", "Charlie Davis", "charlie@example.com", dt.date(2025, 10, 20), "ACTIVE", "555 2222", "321 Elm St", Decimal("1200.00")),
]


def test_customer_sample(spark):
    schema = "customer_id string, name string, email string, signup_date date, status string, phone string, address string, amount decimal(10,2)"
    made = E.standardize_customers(spark.createDataFrame(CUSTOMERS, schema), F.lit("2026-01-13").cast("date")).orderBy("customer_id")
    assert made.columns == [
        "customer_id", "customer_name", "email_address", "signup_date", "customer_status", "phone_number",
        "full_address", "transaction_amount", "processed_date", "data_quality_score",
    ]
    found = [(r.customer_id, r.email_address, r.customer_status, r.phone_number, r.full_address, r.data_quality_score) for r in made.collect()]
    assert found == [
        ("CUST-001", "john@example.com", "Active", "+1-555-1234", "123 Main St", 100),
        ("CUST-002", "jane@domain.org", "Inactive", "+1-555-5678", "456 Oak Ave", 100),
        ("CUST-003", "bob@mail.net", "Active", "+1-555-9012", "789 Pine Rd", 98),
        ("CUST-005", "alice@test.org", "Pending", "+1-555-1111", None, 85),
        ("CUST-006", "charlie@example.com", "Active", "+1-555-2222", "321 Elm St", 100),
    ]


def test_customers_without_an_address_stay_apart(spark):
    schema = "customer_id string, name string, email string, signup_date date, status string, phone string, address string, amount decimal(10,2)"
    pair = [(i, "A", None, None, None, None, None, Decimal("1")) for i in ("1", "2")]
    assert E.standardize_customers(spark.createDataFrame(pair, schema), F.current_date()).count() == 2
