"""Source and sink queries: each writes the given tables to the scratch folder and reads them back."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.operators.cleaning import apply_filters, prepare_trips
from tablemill.plans.trips import full_metrics, performance_report
from tablemill.session import scratch_path
from tablemill.sinks import files as X
from tablemill.sinks import tables as K
from tablemill.sources import files as S
from tablemill.sources.tables import execute_query, read_table

from .common import TRIP_ORDER, WITH_PREPARED, WITH_TRIPS, round_doubles, table, trips
from .trips import FULL_METRICS

PERFORMANCE = """SELECT count(*) AS total_trips, count(DISTINCT vendor_id) AS unique_vendors,
    round(avg(trip_distance), 2) AS avg_distance, round(avg(fare_amount), 2) AS avg_fare,
    round(avg(passenger_count), 2) AS avg_passengers, round(sum(total_amount), 2) AS total_revenue,
    round(avg(speed_mph), 2) AS avg_speed FROM trips WHERE vendor_id IN (1, 2)"""

# Keys whose rows share a JSON document.
DOCUMENT_KEYS = 2


def _csv(spark, sf):
    docs = table(spark, sf, "documents")
    path = X.export_csv(docs, scratch_path(spark, "csv") + ".csv")
    return S.load_data(spark, path, schema=docs.schema)


def _json(spark, sf):
    events = table(spark, sf, "events")
    path = X.export_json(events, scratch_path(spark, "json") + ".json")
    return S.load_data(spark, path, schema=events.schema)


def _csv_inferred(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = X.export_csv(lines, scratch_path(spark, "inferred") + ".csv")
    return S.load_data(spark, path).select(F.col("l_orderkey").cast("bigint"), "l_linenumber", "l_quantity", "l_returnflag")


def _mixed_csv(spark, sf):
    mixed = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, F.lit("n/a")).otherwise(F.col("p_size").cast("string")).alias("p_size")
    )
    path = X.export_csv(mixed, scratch_path(spark, "mixed"))
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_size", T.IntegerType())])
    return S.read_with_rejects(spark, path, schema)


def _texts_csv(spark, sf):
    """Documents, whose texts hold quotes and line breaks, with a size that is no number in every fourth."""
    docs = table(spark, sf, "documents")
    mixed = docs.withColumn("n_chars", F.when(F.col("doc_id") % 4 == 0, F.lit("n/a")).otherwise(F.col("n_chars").cast("string")))
    path = X.export_csv(mixed.withColumn("text", F.concat(F.lit('"'), "text", F.lit('",\n'))), scratch_path(spark, "texts") + ".csv")
    return S.read_with_rejects(spark, path, docs.schema)


def _texts_rejected(spark, sf):
    number = F.regexp_extract("raw_record", r"^(\d+),", 1).cast("bigint")
    return _texts_csv(spark, sf)[1].select(number.alias("doc_id"), F.regexp_count("raw_record", F.lit("\n")).cast("bigint").alias("breaks"))


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


def _store(spark, df, prefix, mode="overwrite"):
    name = _name(prefix)
    stats = K.load_dataframe(df, name, mode, scratch_path(spark, prefix))
    return name, stats


def _overwrite(spark, sf):
    name = _name("orders")
    path = scratch_path(spark, "overwrite")
    K.load_dataframe(table(spark, sf, "orders").filter("o_orderstatus = 'F'"), name, "overwrite", path)
    K.load_dataframe(table(spark, sf, "orders"), name, "overwrite", path)
    return read_table(spark, name)


def _append(spark, sf):
    orders = table(spark, sf, "orders")
    name, _ = _store(spark, orders, "appended", "append")
    K.load_dataframe(orders.filter("o_orderstatus = 'F'"), name, "append")
    return read_table(spark, name)


def _stats(spark, sf):
    orders = table(spark, sf, "orders")
    name, first = _store(spark, orders, "loaded")
    second = K.load_dataframe(orders.filter("o_orderstatus = 'F'"), name, "append")
    both = first.unionByName(second)
    return both.select("mode", "status", "input_row_count", "output_row_count", "verified_row_count", F.size("schema").alias("columns"))


def _incremental(modified):
    def query(spark, sf):
        orders = table(spark, sf, "orders")
        older = orders.filter("o_orderstatus <> 'O'").withColumn(
            "o_orderdate", F.expr("CASE WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END")
        )
        name, _ = _store(spark, older, "incremental")
        K.incremental_load(orders, name, ["o_orderkey"], modified)
        return read_table(spark, name)

    return query


OLDER = """SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate)
    FROM orders WHERE o_orderstatus <> 'O'"""


def _upsert(spark, sf):
    orders = table(spark, sf, "orders")
    name, _ = _store(spark, orders.filter("o_orderstatus <> 'O'"), "upsert")
    changed = orders.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    K.upsert_load(changed, name, ["o_orderkey"], scratch_path(spark, "upsert-next"))
    return read_table(spark, name)


# Orders whose date is missing for some keys; the stored ones lack others than the new ones.
MARKED = "SELECT * REPLACE (CASE WHEN o_orderkey % {n} = 0 THEN NULL ELSE o_orderdate END AS o_orderdate) FROM orders"
# Keys that are NULL or stand for several orders.
SHARED_KEYS = "SELECT CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey END AS k, o_orderkey, o_orderstatus, o_totalprice FROM orders"


def _marked(spark, sf, n):
    return table(spark, sf, "orders").withColumn("o_orderdate", F.expr(f"CASE WHEN o_orderkey % {n} = 0 THEN NULL ELSE o_orderdate END"))


def _null_marks(spark, sf):
    """Loaded twice: the second time adds nothing."""
    name, _ = _store(spark, _marked(spark, sf, 10).filter("o_orderstatus <> 'O'"), "marks")
    for _ in range(2):
        K.incremental_load(_marked(spark, sf, 7), name, ["o_orderkey"], "o_orderdate")
    return read_table(spark, name)


def _shared(spark, sf):
    return table(spark, sf, "orders").selectExpr("CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey END AS k", "o_orderkey", "o_orderstatus", "o_totalprice")


def _incremental_shared(spark, sf):
    keyed = _shared(spark, sf)
    name, _ = _store(spark, keyed.filter("o_orderstatus = 'P'"), "shared")
    for _ in range(2):
        K.incremental_load(keyed, name, ["k"])
    return read_table(spark, name)


def _upsert_shared(spark, sf):
    """A table in partitions of its keys; only those with changed keys are written, the second time as the first."""
    keyed = _shared(spark, sf)
    name = _name("partitioned")
    K.keyed_table(keyed.filter("o_orderstatus = 'F'"), name, ["k"], scratch_path(spark, "partitioned"), buckets=16)
    for _ in range(2):
        K.upsert_partitions(keyed.filter("o_orderstatus = 'P' AND coalesce(k, 0) % 5 = 0"), name)
    return read_table(spark, name).drop("_bucket")


def _cells(spark, sf):
    """Orders against a copy with one changed price in a hundred and every thousandth row twice."""
    orders = table(spark, sf, "orders")
    changed = orders.withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 100 = 7 THEN o_totalprice + 1 ELSE o_totalprice END"))
    return K.row_differences(orders, changed.unionByName(changed.filter("o_orderkey % 1000 = 8")))


def _checks(spark, sf):
    orders = table(spark, sf, "orders")
    name, _ = _store(spark, orders, "checked")
    return K.post_load_checks(orders, read_table(spark, name))


def _differences(spark, sf):
    orders = table(spark, sf, "orders")
    return K.row_differences(orders, orders.filter("o_orderstatus <> 'P'"))


def _report(spark, sf):
    rides = trips(spark, sf)
    report = performance_report(rides, apply_filters(rides, vendors=[1, 2]))
    path = X.export_performance_report(report, scratch_path(spark, "report") + ".json")
    back = S.load_data(spark, path, schema=report.schema)
    return round_doubles(back.select("total_records", "filtered_records", "statistics.*"))


def _statistics(spark, sf):
    rides = trips(spark, sf)
    report = performance_report(rides, apply_filters(rides, vendors=[1, 2]))
    path = X.export_statistics(report, scratch_path(spark, "statistics") + ".csv")
    return round_doubles(S.load_data(spark, path, schema=report.select("statistics.*").schema))


def _metrics(spark, sf):
    metrics = full_metrics(prepare_trips(trips(spark, sf), TRIP_ORDER))
    path = X.export_json(metrics, scratch_path(spark, "metrics") + ".json")
    return round_doubles(S.load_data(spark, path, schema=metrics.schema))


def _json_document(spark, sf):
    """Regions as JSON documents, arrays of the rows of a few neighbouring keys, one to a file."""
    regions = table(spark, sf, "region")
    bucket = F.floor(F.col("r_regionkey") / DOCUMENT_KEYS).alias("bucket")
    documents = regions.groupBy(bucket).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*regions.columns)))).alias("value"))
    path = scratch_path(spark, "document") + ".json"
    documents.write.partitionBy("bucket").text(path)
    return S.load_data(spark, path, schema=regions.schema, multiLine=True).select(*regions.columns)


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _inventory(spark, sf):
    """The stored tables as the file listing names them, with the rows that come from their files."""
    name = F.regexp_extract("path", r"([^/]+)\.parquet", 1)
    listed = S.list_objects(spark, sf).select(name.alias("file")).distinct().filter(F.col("file").isin(*TABLES))
    files = [table(spark, sf, t).select(F.col("_metadata.file_path").alias("path")) for t in TABLES]
    rows = files[0]
    for more in files[1:]:
        rows = rows.unionByName(more)
    counts = rows.groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    return listed.join(counts, "file", "left").select("file", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))


REGION_SQL = """SELECT r_name, count(*) AS customers, round(avg(c_acctbal), 2) AS avg_balance
    FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY r_name"""


def _sql(spark, sf):
    views = {f"check_{name}": table(spark, sf, name) for name in ("customer", "nation", "region")}
    return execute_query(spark, REGION_SQL.format(customer="check_customer", nation="check_nation", region="check_region"), views)


def _sql_limit(spark, sf):
    return execute_query(
        spark, "SELECT * FROM check_orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25", {"check_orders": table(spark, sf, "orders")}
    )


CASES = {
    "table_scan": (
        lambda spark, sf: read_table(spark, _store(spark, table(spark, sf, "supplier"), "scan")[0]),
        "SELECT * FROM supplier",
    ),
    "sql_passthrough": (_sql, REGION_SQL.format(customer="customer", nation="nation", region="region")),
    "sql_limit": (_sql_limit, "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"),
    "csv_roundtrip": (_csv, "SELECT * FROM documents"),
    "csv_inferred": (_csv_inferred, "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"),
    "json_roundtrip": (_json, "SELECT * FROM events"),
    "json_document": (_json_document, "SELECT * FROM region"),
    "csv_accepted": (lambda spark, sf: _mixed_csv(spark, sf)[0], "SELECT p_partkey, p_size FROM part WHERE p_size <= 25"),
    "csv_rejected": (
        lambda spark, sf: _mixed_csv(spark, sf)[1].select("raw_record"),
        "SELECT p_partkey || ',n/a' AS raw_record FROM part WHERE p_size > 25",
    ),
    "csv_accepted_texts": (
        lambda spark, sf: _texts_csv(spark, sf)[0],
        """SELECT * REPLACE ('"' || text || '",' || chr(10) AS text) FROM documents WHERE doc_id % 4 <> 0""",
    ),
    "csv_rejected_texts": (
        _texts_rejected,
        "SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS breaks FROM documents WHERE doc_id % 4 = 0",
    ),
    "table_overwrite": (_overwrite, "SELECT * FROM orders"),
    "table_append": (_append, "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'"),
    "load_stats": (
        _stats,
        """WITH n AS (SELECT count(*) AS a, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders)
           SELECT 'overwrite' AS mode, 'SUCCESS' AS status, a AS input_row_count, a AS output_row_count, a AS verified_row_count, 6 AS columns FROM n
           UNION ALL SELECT 'append', 'SUCCESS', f, f, a + f, 6 FROM n""",
    ),
    "incremental": (
        _incremental(None),
        f"{OLDER} UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'",
    ),
    "incremental_modified": (
        _incremental("o_orderdate"),
        f"{OLDER} UNION ALL SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P')",
    ),
    "upsert": (
        _upsert,
        """SELECT * FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders WHERE o_orderstatus <> 'F'""",
    ),
    "incremental_null_marks": (
        _null_marks,
        f"""WITH stored AS ({MARKED.format(n=10)} WHERE o_orderstatus <> 'O'), offered AS ({MARKED.format(n=7)})
            SELECT * FROM stored UNION ALL SELECT * FROM offered o WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.o_orderkey = o.o_orderkey)
            UNION ALL SELECT o.* FROM offered o JOIN stored s USING (o_orderkey) WHERE s.o_orderdate IS NULL AND o.o_orderdate IS NOT NULL""",
    ),
    "incremental_shared_keys": (
        _incremental_shared,
        f"""WITH keyed AS ({SHARED_KEYS}), stored AS (SELECT * FROM keyed WHERE o_orderstatus = 'P')
            SELECT * FROM stored UNION ALL
            SELECT * FROM (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderkey DESC) = 1) AS one
            WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.k IS NOT DISTINCT FROM one.k)""",
    ),
    "upsert_partitions": (
        _upsert_shared,
        f"""WITH keyed AS ({SHARED_KEYS}),
            changes AS (SELECT * FROM keyed WHERE o_orderstatus = 'P' AND coalesce(k, 0) % 5 = 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderkey DESC) = 1)
            SELECT * FROM changes UNION ALL SELECT * FROM keyed t WHERE o_orderstatus = 'F'
            AND NOT EXISTS (SELECT 1 FROM changes c WHERE c.k IS NOT DISTINCT FROM t.k)""",
    ),
    "cell_differences": (
        _cells,
        """WITH changed AS (SELECT * REPLACE (CASE WHEN o_orderkey % 100 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders),
           twice AS (SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE o_orderkey % 1000 = 8),
           counted AS (SELECT *, 1 AS l, 0 AS r FROM orders UNION ALL SELECT *, 0, 1 FROM twice)
           SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(sum(l) AS BIGINT) AS left_rows,
                  CAST(sum(r) AS BIGINT) AS right_rows FROM counted GROUP BY ALL HAVING sum(l) <> sum(r)""",
    ),
    "checksum": (
        _checks,
        """SELECT count(*) AS source_rows, count(*) AS target_rows, true AS counts_match, true AS checksums_match,
           CAST(0 AS BIGINT) AS different_rows FROM orders""",
    ),
    "row_differences": (
        _differences,
        "SELECT *, CAST(1 AS BIGINT) AS left_rows, CAST(0 AS BIGINT) AS right_rows FROM orders WHERE o_orderstatus = 'P'",
    ),
    "report_export": (
        _report,
        f"{WITH_TRIPS}, p AS ({PERFORMANCE}) SELECT (SELECT count(*) FROM trips) AS total_records, total_trips AS filtered_records, p.* FROM p",
    ),
    "statistics_export": (_statistics, f"{WITH_TRIPS} {PERFORMANCE}"),
    "metrics_export": (_metrics, f"{WITH_PREPARED} {FULL_METRICS.format(source='prepared')}"),
    "file_inventory": (_inventory, " UNION ALL ".join(f"SELECT '{t}' AS file, count(*) AS n_rows FROM {t}" for t in TABLES)),
}
