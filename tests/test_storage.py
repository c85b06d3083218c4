import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan, rows
from registry.common import TRIP_ORDER
from registry.common import trips as load_trips
from tablemill import session
from tablemill.plans import etl, metrics, trips
from tablemill.sinks import files as X
from tablemill.sinks import tables as K
from tablemill.sinks.checks import differing_hashes
from tablemill.sinks.state import maybe_stored, table_state
from tablemill.sources import files as S
from tablemill.sources import tables as B


@pytest.fixture
def sample(spark):
    return spark.createDataFrame([(1, "a"), (2, 'line\nbreak, "quoted"'), (3, None)], "id int, s string")


def test_load_by_extension(spark, sample, tmp_path):
    csv = X.export_csv(sample, str(tmp_path / "t.csv"))
    back = S.load_data(spark, csv, schema=sample.schema, multiLine=True, escape='"')
    assert rows(back) == rows(sample)
    assert S.load_data(spark, csv, multiLine=True, escape='"').schema["id"].dataType == T.IntegerType()
    lines = X.export_json(sample, str(tmp_path / "t.json"))
    assert rows(S.load_data(spark, lines, schema=sample.schema, multiLine=False)) == rows(sample)


def test_whole_document_json(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps([{"a": 1, "b": {"c": [1, 2]}}, {"a": 2, "b": None}], indent=2))
    assert [r.a for r in S.load_data(spark, str(path), multiLine=True).orderBy("a").collect()] == [1, 2]


def test_bad_sources_raise(spark, tmp_path):
    for call in (
        lambda: S.load_data(spark, "x.xyz"),
        lambda: S.load_data(spark),
        lambda: S.load_data(spark, "x.csv", "ftp"),
        lambda: S.load_data(spark, "s3://bucket", "s3"),
        lambda: S.load_data(spark, source_type="s3", bucket="b"),
        lambda: S.split_s3_uri("http://b/k"),
        lambda: X.upload_dataframe(spark.range(1), "b", "k", "parquet"),
    ):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.load_data(spark, str(tmp_path / "absent.csv"))


def test_s3_paths():
    assert S.split_s3_uri("s3://bucket/a/b.csv") == ("bucket", "a/b.csv")
    assert S.s3a_path("s3://bucket/a.csv") == S.s3a_path("s3a://bucket/a.csv") == S.s3a_path(None, "bucket", "a.csv") == "s3a://bucket/a.csv"


def test_inventory(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.txt").write_text("12345")
    (tmp_path / "in" / "b.txt").write_text("1")
    found = S.list_objects(spark, str(tmp_path)).select(F.element_at(F.split("path", "/"), -1), "length")
    assert rows(found) == [("a.txt", 5), ("b.txt", 1)]


def test_malformed_records_are_kept_apart(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id,n\n1,5\n2,five\n3\n4,6\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    good, bad = S.read_with_rejects(spark, str(tmp_path / "m.csv"), schema)
    assert rows(good) == [(1, 5), (4, 6)] and good.select("id").count() == 2
    assert [r[0] for r in rows(bad.select("raw_record"))] == ["2,five", "3"]
    (tmp_path / "m.json").write_text('{"id": 1, "n": 5}\n{"id": 2, "n": \n')
    good, bad = S.read_with_rejects(spark, str(tmp_path / "m.json"), schema, "json")
    assert rows(good) == [(1, 5)] and bad.count() == 1


def test_jdbc_options():
    url = B.jdbc_url("host", "db")
    assert url == "jdbc:postgresql://host:5432/db"
    options = B.jdbc_options(url, "me", "secret", sslmode="require")
    assert options["driver"] == "org.postgresql.Driver" and options["fetchsize"] == "10000" and options["sslmode"] == "require"
    assert B.paging_options("id", 0, 100, 4) == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    with pytest.raises(ValueError):
        B.paging_options("id", 0, 100, 0)


def test_column_types():
    schema = T.StructType.fromDDL(
        "a string, b tinyint, c smallint, d int, e bigint, f float, g double, h boolean, i timestamp, j date, k decimal(12,3), l array<int>, m interval day to second"
    )
    assert [K.sql_type(f.dataType) for f in schema] == [
        "TEXT", "SMALLINT", "SMALLINT", "INTEGER", "BIGINT", "REAL", "DOUBLE PRECISION", "BOOLEAN", "TIMESTAMP",
        "DATE", "DECIMAL(12,3)", "TEXT", "INTERVAL",
    ]
    assert K.create_table_sql("t", T.StructType.fromDDL("a int, b decimal(5,1)")) == "CREATE TABLE t (a INTEGER, b DECIMAL(5,1))"
    assert K.sql_type(T.StringType(), 255) == "VARCHAR(255)" and K.sql_type(T.LongType(), 255) == "BIGINT"
    assert K.text_types(schema) == "" and K.text_types(schema, 255) == "`a` VARCHAR(255)"
    T.StructType.fromDDL(K.text_types(schema, 255))  # Spark must be able to read it


def test_loads_report_counts_and_failures(spark, sample, tmp_path):
    path = str(tmp_path / "table")
    first = K.load_dataframe(sample, "loads", "append", path).first()
    assert (first.status, first.input_row_count, first.verified_row_count) == ("SUCCESS", 3, 3)
    assert first.schema == {"id": "int", "s": "string"}
    second = K.load_dataframe(sample, "loads", "append").first()
    assert (second.input_row_count, second.output_row_count, second.verified_row_count) == (3, 3, 6)
    assert K.verified_columns(spark, "loads") == ["id", "s"]
    third = K.load_dataframe(sample.limit(1), "loads", "overwrite", path).first()
    assert third.verified_row_count == 1
    failed = K.load_dataframe(sample.select(F.raise_error(F.lit("boom")).cast("int").alias("id")), "failing", path=str(tmp_path / "f")).first()
    assert failed.status == "FAILED" and "boom" in failed.message
    with pytest.raises(ValueError):
        K.load_dataframe(sample, "loads", "merge")


def test_an_empty_load_succeeds(spark, sample, tmp_path):
    for name, empty in {"a": sample.limit(0), "b": sample.filter("id > 10"), "c": sample.filter("false")}.items():
        row = K.load_dataframe(empty, f"empty_{name}", path=str(tmp_path / name)).first()
        assert (row.status, row.input_row_count, row.verified_row_count) == ("SUCCESS", 0, 0)


def test_upsert_twice_changes_nothing(spark, tmp_path):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, s string")
    source = spark.createDataFrame([(2, "B"), (4, "D")], "id int, s string")
    K.load_dataframe(target, "upserted", path=str(tmp_path / "v0"))
    want = [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    for version in ("v1", "v2"):
        assert K.upsert_load(source, "upserted", ["id"], str(tmp_path / version)) == 4
        assert rows(spark.table("upserted")) == want


def test_incremental_rows(spark):
    target = spark.createDataFrame([(1, 10), (2, 20)], "id int, at int")
    source = spark.createDataFrame([(1, 10), (2, 21), (3, 1)], "id int, at int")
    assert rows(K.incremental_rows(source, target, ["id"])) == [(3, 1)]
    assert rows(K.incremental_rows(source, target, ["id"], "at")) == [(2, 21), (3, 1)]


def test_checks_see_repeated_rows(spark):
    once = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    assert tuple(K.post_load_checks(once, once.orderBy(F.desc("id"))).first()) == (2, 2, True, True, 0)
    thrice = once.union(once).union(once)
    row = K.post_load_checks(once, thrice).first()
    assert not row.checksums_match and not row.counts_match and row.different_rows == 2
    assert tuple(K.checksum(once.limit(0)).first()) == (0, 0)


def test_scratch_follows_the_session_setting(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_pin_stores_what_does_not_fit(spark):
    df = spark.range(50).withColumn("r", F.rand())
    for limit in (10, 100):
        pinned = session.pin(df, max_rows=limit)
        assert pinned.dtypes == df.dtypes and rows(pinned) == rows(pinned) and pinned.count() == 50


def test_metrics_log_and_report(spark, tmp_path):
    log = metrics.StepLog(spark)
    with log.step("load") as step:
        step.rows_in = step.rows_out = 100
    with log.step("transform") as step:
        step.rows_in, step.rows_out, step.rows_failed = 100, 80, 18
    with pytest.raises(RuntimeError):
        with log.step("db_load"):
            raise RuntimeError("no connection")
    report = metrics.run_report(log.frame()).first()
    assert (report.total_rows_loaded, report.total_rows_transformed, report.total_rows_loaded_to_db) == (100, 80, 0)
    assert report.overall_status == "FAILED" and report.success_rate == 90.0
    failed = log.frame().filter("status = 'FAILED'").first()
    assert failed.error_message == "no connection" and "RuntimeError" in failed.error_traceback
    for _ in range(2):
        metrics.append_metrics(log.frame(), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 6
    assert [r.change_pct for r in metrics.transformation_summary(log.frame()).collect()][1] == -20.0


def test_a_flow_reports_a_failed_load_and_stops(spark, tmp_path):
    result = etl.run_flow(spark, spark.createDataFrame([], "id int"), "never", str(tmp_path / "never"))
    assert result.table is None and result.report.first()["overall_status"] == "FAILED"
    assert [r.stage_name for r in result.metrics.collect()] == ["load"]
    missing = etl.run_flow(spark, str(tmp_path / "absent.csv"), "never", str(tmp_path / "never"))
    assert missing.report.first()["overall_status"] == "FAILED"


def test_a_failed_store_still_reports(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    source = spark.createDataFrame([Row(passenger_count=1), Row(passenger_count=9)])
    result = etl.run_flow(spark, source, "blocked", str(tmp_path / "file" / "below"))
    assert result.table is None and result.quality is not None
    assert [r.status for r in result.metrics.collect()] == ["SUCCESS", "SUCCESS", "FAILED"]


def test_a_flow_from_a_file(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    os.makedirs(path)
    with open(os.path.join(path, "part.csv"), "w") as out:
        out.write("id,at,passenger_count\n1,2024-01-06 10:00:00,2\n1,2024-01-06 10:00:00,2\n2,2024-01-07 10:00:00,\n3,2024-01-08 10:00:00,9\n")
    result = etl.run_flow(spark, path, "from_file", str(tmp_path / "out"))
    assert [(r.id, r.passenger_count, r.day, r.is_weekend) for r in result.table.orderBy("id").collect()] == [(1, 2.0, 6, True), (2, 5.5, 7, True)]
    assert result.report.first()["total_rows_loaded"] == 4


def test_every_panel_runs(spark, sf):
    shared = B.cached(load_trips(spark, sf))
    try:
        for name, panel in trips.run_reports(shared, trips.DASHBOARD).items():
            assert panel.count() > 0, name
    finally:
        shared.unpersist()


def test_notebook_flow_exports(spark, sf, tmp_path):
    reports = etl.notebook_flow(spark, load_trips(spark, sf), TRIP_ORDER, str(tmp_path))
    for name, report in reports.items():
        assert report.count() > 0, name
    rides = reports["metrics"].first()["total_trips"]
    assert S.load_data(spark, str(tmp_path / "transformed_data.csv")).count() == rides
    back = S.load_data(spark, str(tmp_path / "metrics.json"), multiLine=False).first()
    assert back["total_trips"] == rides and back["weekend_trips"] + back["weekday_trips"] == rides


def test_notebook_flow_stores_one_copy(spark, sf, tmp_path, monkeypatch):
    """Deduplicated rows are stored once; export and reports derive the rest from them."""
    labels, scratch = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda spark, label: labels.append(label) or scratch(spark, label))
    etl.notebook_flow(spark, load_trips(spark, sf), TRIP_ORDER, str(tmp_path))
    assert labels.count("unique") == 1 and "prepared" not in labels


def test_defaults_read_back_exports(spark, tmp_path):
    df = spark.createDataFrame([(i, f'say "hi"\nline {i}, and ""more""') for i in range(50)], "id long, text string")
    for name, export in (("out.json", X.export_json), ("out.csv", X.export_csv)):
        path = export(df, str(tmp_path / name))
        assert rows(S.load_data(spark, path, schema=df.schema)) == rows(df)


def test_null_and_repeated_keys_load_once(spark):
    target = spark.createDataFrame([(1, "a", 1), (None, "n", 2)], "id int, v string, w int")
    source = spark.createDataFrame([(None, "m"), (2, "b"), (2, "c")], "id int, v string")
    assert rows(K.incremental_rows(source, target, ["id"])) == [(2, "c")]
    merged = K.upsert_rows(source, target, ["id"])
    assert rows(merged) == rows(spark.createDataFrame([(1, "a", 1), (None, "m", 2), (2, "c", None)], target.schema))
    assert rows(K.upsert_rows(source, merged, ["id"])) == rows(merged)
    with pytest.raises(ValueError):
        K.upsert_rows(source.withColumn("x", F.lit(1)), target, ["id"])


def test_checksum_sees_where_nulls_are(spark):
    one, two = (spark.createDataFrame([r], "a int, b int") for r in ((None, 1), (1, None)))
    assert K.checksum(one).first().checksum != K.checksum(two).first().checksum


def test_every_difference_is_found(spark):
    """A changed cell, NULLs that changed places and a repeated row, planted among many equal rows."""
    left = spark.range(5000).select("id", (F.col("id") * 1.5).alias("x"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("s"), F.lit(None).cast("string").alias("t"))
    right = left.withColumn("x", F.when(F.col("id") == 17, F.lit(-1.0)).when(F.col("id") == 0, F.lit(-0.0)).otherwise(F.col("x")))
    swap = F.col("id") == 23
    right = right.select("id", "x", F.when(swap, F.col("t")).otherwise(F.col("s")).alias("s"), F.when(swap, F.col("s")).otherwise(F.col("t")).alias("t"))
    right = right.unionByName(right.where("id = 40"))
    assert tuple(K.post_load_checks(left, right).first()) == (5000, 5001, False, False, 5)
    found = sorted((r["id"], r["left_rows"], r["right_rows"]) for r in K.row_differences(left, right).collect())
    assert found == [(17, 0, 1), (17, 1, 0), (23, 0, 1), (23, 1, 0), (40, 1, 2)]
    assert tuple(K.post_load_checks(left, left.repartition(7)).first()) == (5000, 5000, True, True, 0)
    two = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int"), spark.createDataFrame([(1, 4), (3, 2)], "a int, b int")
    assert K.post_load_checks(*two).first().different_rows == 4
    assert tuple(K.post_load_checks(left.limit(0), left.limit(0)).first()) == (0, 0, True, True, 0)


def test_the_rows_themselves_are_not_shuffled(spark):
    left = spark.range(100).select("id", F.format_string("%d", "id").alias("wide"))
    text = plan(differing_hashes(left, left.where("id > 3")))
    assert "Exchange" in text and all("wide" not in line for line in text.splitlines() if "Exchange" in line)


def incremental_case(spark, name, path):
    target = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, None, "c"), (None, 5, "n"), (4, 7, "d"), (4, None, "e")], "id int, at int, s string")
    K.load_dataframe(target, name, path=str(path))
    source = [(1, 10, "a"), (2, 15, "old"), (2, 21, "B"), (3, 1, "C"), (None, 6, "N"), (4, None, "x"), (5, None, "new"), (6, 1, "late"), (7, 99, "high"), (5, None, "news")]
    return target, spark.createDataFrame(source, target.schema)


def test_loading_twice_adds_nothing(spark, tmp_path):
    """NULL keys, NULL marks and repeated keys; late rows of new keys come in below the high-water mark."""
    target, source = incremental_case(spark, "incremental_twice", tmp_path / "t")
    want = rows(target.unionByName(spark.createDataFrame([(2, 21, "B"), (3, 1, "C"), (None, 6, "N"), (5, None, "news"), (6, 1, "late"), (7, 99, "high")], target.schema)))
    for added in (6, 0, 0):
        stats = K.incremental_load(source, "incremental_twice", ["id"], "at").first()
        assert (stats.status, stats.output_row_count) == ("SUCCESS", added)
        assert rows(spark.table("incremental_twice")) == want
    assert rows(K.incremental_rows(source, spark.table("incremental_twice"), ["id"], "at")) == []


def test_the_state_follows_the_files(spark, tmp_path):
    """A state is kept while the files are the same, grows by new files and is built anew after an overwrite."""
    target, source = incremental_case(spark, "state_table", tmp_path / "t")
    first = table_state(spark, "state_table", ["id"], "at")
    assert table_state(spark, "state_table", ["id"], "at").path == first.path and first.mark(spark) == 20
    K.load_dataframe(source, "state_table", "append")  # a load that knows nothing of the state
    second = table_state(spark, "state_table", ["id"], "at")
    assert (second.rows, second.buckets, second.mark(spark)) == (16, first.buckets, 99)
    asked = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).cast("int").alias("id"))
    answers = {r["id"]: r["_maybe"] for r in maybe_stored(asked, second.bitmaps(spark), ["id"], second.buckets).collect()}
    assert all(answers[i] for i in (None, 1, 2, 3, 4, 5, 6, 7)) and sum(answers.values()) < 20
    K.load_dataframe(target.limit(1), "state_table", "overwrite", str(tmp_path / "t"))
    assert table_state(spark, "state_table", ["id"], "at").rows == 1
    assert table_state(spark, "state_table", ["id"]).modified is None


def test_a_full_filter_is_built_anew(spark, tmp_path):
    K.load_dataframe(spark.range(3000), "grown", path=str(tmp_path / "t"))
    first = table_state(spark, "grown", ["id"])
    K.load_dataframe(spark.range(3000, 20_000), "grown", "append")
    second = table_state(spark, "grown", ["id"])
    assert second.buckets > first.buckets and second.rows == 20_000
    wrong = maybe_stored(spark.range(30_000, 60_000), second.bitmaps(spark), ["id"], second.buckets).where("_maybe").count()
    assert wrong < 600 and maybe_stored(spark.range(20_000), second.bitmaps(spark), ["id"], second.buckets).where("NOT _maybe").count() == 0


def test_an_append_beside_another_one(spark, tmp_path, monkeypatch):
    """Rows that another load adds meanwhile are not taken for rows of this one."""
    K.load_dataframe(spark.range(10), "shared", path=str(tmp_path / "t"))
    listed, plain = [], K._stored_files

    def meanwhile(session, table):
        if listed:
            spark.range(7).write.insertInto("shared")
        listed.append(table)
        return plain(session, table)

    monkeypatch.setattr(K, "_stored_files", meanwhile)
    stats = K.load_dataframe(spark.range(20, 25), "shared", "append").first()
    assert (stats.status, stats.input_row_count, stats.output_row_count, stats.verified_row_count) == ("SUCCESS", 5, 5, 22)


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    target = spark.createDataFrame([(i, f"v{i}", i) for i in range(200)] + [(None, "n", 0)], "id int, s string, w int")
    assert K.keyed_table(target, "keyed", ["id"], str(tmp_path / "t"), buckets=16) == 201

    def files():
        return {tuple(r) for r in spark.table("keyed").select("_bucket", "_metadata.file_name").distinct().collect()}

    before = files()
    source = spark.createDataFrame([(3, "x"), (500, "new"), (500, "newer"), (None, "m")], "id int, s string")
    touched = K.upsert_partitions(source, "keyed")
    after = files()
    assert 1 <= len(touched) <= 3
    assert {p for p in before if p[0] not in touched} == {p for p in after if p[0] not in touched}
    assert not {p for p in before & after if p[0] in touched}
    want = rows(K.upsert_rows(source, target, ["id"]))
    assert rows(spark.table("keyed").drop("_bucket")) == want
    assert K.upsert_partitions(source, "keyed") == touched and rows(spark.table("keyed").drop("_bucket")) == want
    assert K.upsert_partitions(source.limit(0), "keyed") == []


def test_a_flow_computes_its_source_once(spark, tmp_path):
    """Checking, counting and deduplicating share one pass: the source leaves a trace for each row it is computed from."""
    seen = spark.sparkContext.accumulator(0)
    given = [(1, 2, 5.0), (1, 2, 5.0), (2, 9, None), (3, 4, None), (3, 4, None)]

    def traced(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame(given, "id int, passenger_count int, x double")
    source = source.mapInArrow(traced, source.schema)
    result = etl.run_flow(spark, source, "once", str(tmp_path / "once"))
    steps = [(r.row_count_input, r.row_count_output) for r in result.metrics.collect()]
    assert steps == [(5, 5), (5, 2), (2, 2)] and seen.value == 5
    assert sorted((r.id, r.x) for r in result.table.collect()) == [(1, 5.0), (3, 5.0)]
