import datetime as dt
import math

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan, rows
from tablemill import functions as X
from tablemill.operators import features as E
from tablemill.operators import windows as W
from tablemill.operators.ordering import in_chunks


@pytest.fixture(scope="module")
def uneven(events):
    """Two thirds of the rows in one partition, NULL keys, gaps and ties."""
    return events.select(
        "event_id",
        "ts",
        F.when(F.col("user_id") % 3 > 0, F.lit("hot")).when(F.col("user_id") % 2 > 0, F.col("event_type")).alias("k"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("x"),
        F.to_date("ts").alias("d"),
    )


def same(a, b):
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


ALL = {"x": ["lag", "lead", "row_number", "rank"]}


@pytest.mark.parametrize("order", [["ts", "event_id"], ["k", "event_id"], ["x", "event_id"], ["d", "event_id"]])
@pytest.mark.parametrize("keys", [["k"], []])
def test_hot_partitions_equal_a_plain_window(uneven, keys, order):
    same(W.create_window_features(uneven, keys, order, ALL, hot_rows=40), W.create_window_features(uneven, keys, order, ALL))


@pytest.mark.parametrize("keys", [["k"], []])
def test_hot_forward_fill(uneven, keys):
    order = ["ts", "event_id"]
    same(W.forward_fill(uneven, order, keys, ["x"], hot_rows=40), W.forward_fill(uneven, order, keys, ["x"]))


@pytest.mark.parametrize("preceding", [0, 3, 100])
def test_hot_rolling_average(uneven, preceding):
    def average(hot_rows):
        made = W.rolling_average(uneven, "x", ["k"], ["ts", "event_id"], preceding, hot_rows)
        return made.withColumn("x_rolling_avg", F.round("x_rolling_avg", 6))

    same(average(40), average(10**9))


@pytest.mark.parametrize("order", [["a", "event_id"], ["a", "b", "event_id"], ["t", "event_id"], ["f", "event_id"], ["z", "event_id"]])
def test_one_hot_order_value(events, order):
    """Most rows of a partition agree in one order column, or in two; NULL and NaN may be the hot value."""
    tied = events.select(
        "event_id",
        F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 9).when(F.col("event_id") % 2 > 0, 5).alias("a"),
        F.when(F.col("user_id") % 4 > 0, F.lit("same prefix 1")).otherwise(F.concat(F.lit("same prefix "), "user_id")).alias("b"),
        F.date_trunc("month", "ts").cast("timestamp_ntz").alias("t"),
        F.when(F.col("user_id") % 3 > 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("f"),
        F.when(F.col("user_id") % 5 == 0, F.col("event_id").cast("decimal(20,2)")).alias("z"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("x"),
    )
    split = W.create_window_features(tied, [], order, ALL, hot_rows=30)
    same(split, W.create_window_features(tied, [], order, ALL))
    parts = in_chunks(tied, order, tied.count(), 30)
    assert parts.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 120
    same(W.forward_fill(tied, order, [], ["x"], hot_rows=30), W.forward_fill(tied, order, [], ["x"]))


def test_ranks_with_ties_across_chunks(uneven):
    same(W.create_window_features(uneven, ["k"], ["d"], {"d": "rank"}, hot_rows=20), W.create_window_features(uneven, ["k"], ["d"], {"d": "rank"}))


def test_rows_that_are_all_key(uneven):
    keys = uneven.select("k")
    same(W.create_window_features(keys, ["k"], ["k"], {"k": "rank"}, hot_rows=40), W.create_window_features(keys, ["k"], ["k"], {"k": "rank"}))


def test_no_window_runs_in_a_single_task(uneven):
    text = plan(W.forward_fill(uneven, ["ts"], columns=["x"], hot_rows=40))
    assert "SinglePartition" not in text and "BroadcastHashJoin" in text and "_chunk" in text


def test_chunks_follow_real_values(spark):
    """Values with one long prefix, binary, arrays, structs and collated text are cut into even chunks in their own order."""
    wide = spark.range(4000).select("id", F.format_string("Customer#%019d %s", F.col("id") * 7 % 4000, F.when(F.col("id") % 2 > 0, "x").otherwise("X")).alias("t"))
    wide = wide.withColumns({
        "c": F.collate("t", "UTF8_LCASE"), "b": F.unhex(F.md5("t")), "a": F.array(F.substring("t", 1, 12), "t"), "s": F.struct(F.lit(1).alias("n"), "t"),
    })
    for column in ["t", "c", "b", "a", "s"]:
        parts = in_chunks(wide.select(column), [column], 4000, 100)
        counts = parts.groupBy("_chunk").agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        counts = counts.withColumn("before", F.lag("high").over(Window.orderBy("_chunk")))
        found = counts.orderBy("_chunk").select("n", (F.col("before") < F.col("low")).alias("after")).collect()
        assert len(found) > 30 and max(r.n for r in found) <= 300 and sum(r.n for r in found) == 4000
        assert all(r.after for r in found[1:])


def test_small_chunks_do_not_make_a_task_each(spark):
    """The number of tasks does not follow the rows while a chunk is small, and the results stay those of a plain window."""
    made = spark.range(1200).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 400).alias("o"), "id", F.col("id").cast("double").alias("x"))
    parts = in_chunks(made, ["k", "o"], 1200, 2)
    assert parts.groupBy("_chunk").count().count() <= 200 and len(parts.inputFiles()) <= 200 and parts.count() == 1200
    assert in_chunks(made, ["k", "o"], 1200, 100).groupBy("_chunk").count().count() > 8  # larger chunks stay as asked for
    same(*(W.create_window_features(made, ["k"], ["o", "id"], ALL, hot_rows=n) for n in (2, 10**6)))
    same(*(W.rolling_average(made, "x", ["k"], ["o", "id"], 3, hot_rows=n) for n in (2, 10**6)))


@pytest.mark.parametrize("column", ["c", "b", "a", "s"])
def test_every_orderable_type_above_and_below_the_limit(spark, column):
    made = spark.range(900).select(
        "id",
        (F.col("id") % 2).alias("k"),
        F.when(F.col("id") % 10 > 0, F.concat(F.when(F.col("id") % 3 > 0, "Label").otherwise("LABEL"), F.lit("  "), (F.col("id") * 11 % 300).cast("string"))).alias("t"),
    )
    made = made.withColumns({"c": F.collate("t", "UTF8_LCASE"), "b": F.encode("t", "UTF-8"), "a": F.array("t", F.lit(None)), "s": F.struct("t")})
    made = made.withColumn("x", F.col("id")).select("k", "id", column, "x")
    both = [W.create_window_features(made, ["k"], [column, "id"], ALL, hot_rows=n).drop(column) for n in (50, 10**6)]
    same(*both)
    ranks = [W.create_window_features(made, ["k"], [column], {"x": "rank"}, hot_rows=n).drop(column) for n in (50, 10**6)]
    same(*ranks)


def test_unique_labels_are_spread(spark):
    labels = spark.range(2000).select(F.format_string("Customer#%09d", "id").alias("c"))
    index = E.label_index(labels, "c", hot_rows=100)
    assert rows(index) == [(f"Customer#{i:09d}", float(i)) for i in range(2000)]
    ordered = in_chunks(labels.groupBy("c").count(), [F.desc("count"), F.col("c")], 2000, 100)
    sizes = [r["count"] for r in ordered.groupBy("_chunk").count().collect()]
    assert len(sizes) > 15 and max(sizes) <= 300


def test_the_encoder_reads_no_rows_to_learn_its_size(spark):
    """The number of labels comes with the column: three labels, although the rows hold one."""
    encoded = E.create_categorical_features(spark.createDataFrame([("a",)] * 3 + [("b",), ("c",)], "s string"), "s")
    assert encoded.schema["s_encoded"].metadata["ml_attr"]["num_attrs"] == 2


def test_unknown_window_function(uneven):
    with pytest.raises(ValueError):
        W.create_window_features(uneven, ["k"], ["ts"], {"x": "ntile"})


def test_date_features(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 5, 7),), (None,)], "t timestamp_ntz")
    made = E.create_date_features(df, "t", "p")
    assert made.columns == ["t", "p_year", "p_month", "p_day", "p_hour", "p_minute", "p_quarter", "p_dayofweek", "p_is_weekend"]
    assert tuple(made.filter("t IS NOT NULL").first())[1:] == (2024, 3, 31, 5, 7, 1, 6, True)
    assert tuple(made.filter("t IS NULL").first())[1:7] == (None,) * 6
    text = spark.createDataFrame([("2024-03-31 05:07:00",)], "t string")
    assert E.create_date_features(text, "t").first()["minute"] == 7
    assert E.create_first_date_features(text) is text


def test_numeric_features_at_the_edges(spark):
    df = spark.createDataFrame([(-4.0,), (-1.0,), (0.0,), (3.0,)], "x double")
    every = ["sqrt", "log", "square", "reciprocal", "abs"]
    raw = {r.x: r for r in E.create_numerical_features(df, ["x"], every).collect()}
    assert math.isnan(raw[-4.0].x_sqrt) and raw[-4.0].x_log is None and raw[-1.0].x_reciprocal is None
    assert (raw[3.0].x_square, raw[3.0].x_reciprocal, raw[-4.0].x_abs) == (9.0, 0.25, 4.0)
    absolute = {r.x: r for r in E.create_numerical_features(df, ["x"], every, use_abs=True).collect()}
    assert absolute[-4.0].x_sqrt == 2.0 and math.isclose(absolute[-4.0].x_log, math.log(5))
    assert E.create_numerical_features(df, ["x"]).columns == ["x", "x_sqrt", "x_log", "x_square"]
    with pytest.raises(ValueError):
        E.create_numerical_features(df, ["x"], ["cube"])


def test_labels_equal_the_string_indexer(events):
    text = events.withColumn("user", F.concat(F.lit("u"), "user_id"))
    ours = rows(E.create_categorical_features(text, "user", "label").select("event_id", "user_encoded"))
    indexer = StringIndexer(inputCol="user", outputCol="i").fit(text)
    assert ours == rows(indexer.transform(text).select("event_id", "i"))
    assert rows(E.label_index(text, "user")) == rows(E.label_index(text, "user", hot_rows=5))


def test_one_hot_drops_the_last_label(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "s string")
    found = {r.s: r.s_encoded.toArray().tolist() for r in E.create_categorical_features(df, "s").collect()}
    assert found == {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.0, 0.0]}
    labels = E.create_categorical_features(spark.createDataFrame([("a",), (None,)], "s string"), "s", "label")
    assert rows(labels) == [("a", 0.0), (None, None)]
    with pytest.raises(ValueError):
        E.create_categorical_features(df, "s", "hash")


def test_text_functions(spark):
    df = spark.createDataFrame([("(555)1111",), ("555 2222",), ("12",), (None,)], "p string")
    assert [r[0] for r in df.select(X.normalize_phone("p")).collect()] == ["+1-555-1111", "+1-555-2222", "12", None]
    ten = spark.createDataFrame([("(555) 123-4567",), ("1 555 123 4567",), ("+1-555-1111",), (" - ",)], "p string")
    once = ten.select(X.normalize_phone("p").alias("p"))
    assert [r[0] for r in once.collect()] == ["+1-555-123-4567", "+1-555-123-4567", "+1-555-1111", None]
    assert rows(once.select(X.normalize_phone("p"))) == rows(once)
    one = spark.range(1)
    assert one.select(X.standard_id(F.lit("7")), X.standard_id(F.lit("12345")), X.label_text("Vendor %s", F.lit(3)), X.label_text("%s", F.lit(None))).first()[:] == (
        "CUST-007",
        "CUST-12345",
        "Vendor 3",
        None,
    )
    assert one.select(X.normalize_whitespace(F.lit("\t a \n b ")), X.normalize_status(F.lit(" ACTIVE"))).first()[:] == ("a b", "Active")
