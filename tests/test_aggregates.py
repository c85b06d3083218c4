import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tablemill.operators import aggregates as A
from tablemill.operators import quantiles
from tablemill.operators.ordering import in_chunks
from tablemill.operators.quantiles import approximate_quantiles, exact_quantiles

NAN = float("nan")


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, one value a third of them; NULL group, NULL and NaN values."""
    random.seed(1)
    data = [("hot", 7.0 if i % 3 == 0 else random.lognormvariate(0, 4)) for i in range(6000)]
    data += [("cold", random.random()) for _ in range(50)] + [(None, float(i)) for i in range(40)]
    data += [("cold", None), ("cold", NAN), ("empty", None)]
    return spark.createDataFrame(data, "g string, x double").withColumn("y", F.col("x") * -2)


PROBABILITIES = [0.5, 0.0, 0.25, 0.333, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("small_group", [10, 100, 10**9])
def test_quantiles_equal_percentile(skewed, groups, small_group):
    found = exact_quantiles(skewed, ["x", "y"], PROBABILITIES, groups, small_group)
    clean = skewed.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "y")})
    expected = clean.groupBy(*groups).agg(*[F.percentile(c, PROBABILITIES).alias(c) for c in ("x", "y")]).collect()
    want = {(*[r[g] for g in groups], c): r[c] for r in expected for c in ("x", "y")}
    got = {(*[r[g] for g in groups], r["column"]): r["quantiles"] for r in found.collect()}
    assert got.keys() == want.keys()
    for key, values in got.items():
        assert (values is None) == (want[key] is None)
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(values or [], want[key] or []))


def test_values_over_twelve_magnitudes_are_ranked_in_even_chunks(spark, monkeypatch):
    """A bracket from 1 to 1e12: no chunk holds more than twice the mean, and the quantiles are exact."""
    wide = spark.range(60_000).select(F.pow(F.lit(10.0), F.col("id") * 7919 % 60_000 / 5000).alias("x"))
    sizes = []

    def watched(df, order, rows, chunk_rows, label):
        made = in_chunks(df, order, rows, 20, label)
        sizes.extend(r["count"] for r in made.groupBy("_chunk").count().collect())
        return made

    monkeypatch.setattr(quantiles, "in_chunks", watched)
    for margin in (0.005, 0.3):
        monkeypatch.setattr(quantiles, "MARGIN", margin)
        sizes.clear()
        found = exact_quantiles(wide, ["x"], [0.25, 0.5, 0.99], small_group=1000).first()["quantiles"]
        want = wide.agg(F.percentile("x", [0.25, 0.5, 0.99]).alias("q")).first()["q"]
        assert found == pytest.approx(want, rel=1e-12)
        assert len(sizes) > 20 and max(sizes) <= 2 * sum(sizes) / len(sizes)


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_the_input_is_read_twice(spark, skewed, groups, tmp_path):
    skewed.coalesce(1).write.parquet(str(tmp_path / "t"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        read.add(1)
        yield from batches

    rows = spark.read.parquet(str(tmp_path / "t"))
    exact_quantiles(rows.mapInArrow(counted, rows.schema), ["x", "y"], [0.5], groups, 100).collect()
    assert read.value == 2


def test_quantiles_of_few_and_equal_values(spark):
    one = spark.createDataFrame([(3.0,)] * 25, "x double")
    assert exact_quantiles(one, ["x"], [0.1, 0.9], small_group=5).first()["quantiles"] == [3.0, 3.0]
    assert exact_quantiles(one.limit(0), ["x"], [0.5]).count() == 0


def test_approximate_quantiles(skewed):
    exact = exact_quantiles(skewed, ["x"], [0.5]).first()["quantiles"][0]
    assert approximate_quantiles(skewed, ["x"], [0.5]).first()["quantiles"][0] == pytest.approx(exact, rel=0.1)


def test_simple_aggregation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", NAN), (None, 5.0)], "g string, x double")
    made = A.simple_aggregation(df, ["g"], {"x": ["sum", "mean", "count", "min", "max", "std", "var"]})
    assert made.columns == ["g", "x_sum", "x_mean", "x_count", "x_min", "x_max", "x_std", "x_var"]
    assert rows(made) == [("a", 4.0, 2.0, 2, 1.0, 3.0, math.sqrt(2), 2.0), (None, 5.0, 5.0, 1, 5.0, 5.0, None, None)]
    with pytest.raises(ValueError):
        A.simple_aggregation(df, ["g"], {"x": "mode"})


def test_percentile_names(skewed):
    made = A.percentile_aggregation(skewed, ["g"], "x", [0.29, 0.5])
    assert made.columns == ["g", "p29", "p50"]
    assert made.filter("g = 'empty'").first()["p50"] is None
    assert A.percentile_aggregation(skewed, ["g"], "x", accuracy=100).count() == 4


def test_pivot_falls_back_to_sum(spark):
    df = spark.createDataFrame([("a", "u", 1), ("a", "u", 2), ("b", "v", 3)], "g string, p string, x int")
    assert rows(A.pivot_aggregation(df, ["g"], "p", "x", "product")) == [("a", 3, None), ("b", None, 3)]


def test_crosstab_fills_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (None, 1), (1, None)], "a int, b int")
    assert rows(A.crosstab(df, "a", "b")) == [(1, 1, 2), (2, 1, 0)]


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    assert [tuple(r) for r in A.value_counts(df, "k").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert [r.k for r in A.value_counts(df, "k", by_key=True).collect()] == ["a", "b", "c"]


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (4.0,), (None,), (NAN,)], "x double")
    assert [(r.bin, r.bin_start, r.bin_end, r.n) for r in A.histogram(df, "x", 4).orderBy("bin").collect()] == [
        (0, 0.0, 1.0, 2),
        (1, 1.0, 2.0, 0),
        (2, 2.0, 3.0, 0),
        (3, 3.0, 4.0, 1),
    ]
    assert A.histogram(df.filter("x IS NULL"), "x", 4).count() == 0
    assert A.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 3).filter("n > 0").first()["n"] == 2


def test_histogram_by_group(skewed):
    made = A.histogram_by_group(skewed, "x", ["g"], 5)
    assert dict(rows(made.groupBy("g").agg(F.sum("n")))) == {"hot": 6000, "cold": 50}


def test_describe(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (3, NAN, "b"), (5, None, "c")], "a int, b double, c string")
    made = {r["column"]: tuple(r)[1:] for r in A.describe_quartiles(df).select("column", "count", "mean", "stddev", "min", "max", "q25", "q50", "q75").collect()}
    assert made == {"a": (3, 3.0, 2.0, 1.0, 5.0, 2.0, 3.0, 4.0), "b": (1, 1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0)}


def test_top_rows_need_no_full_sort(events):
    made = A.sort_limit(events, "value", "event_id", 10, ascending=False)
    assert "TakeOrderedAndProject" in plan(made)
    nulls = events.withColumn("value", F.when(F.col("value") > 1, F.col("value")))
    for ascending in (True, False):
        assert all(r.value is not None for r in A.sort_limit(nulls, "value", "event_id", 10, ascending).collect())


def test_append_aligns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, extra double")
    assert rows(A.append_rows(a, b)) == [(1, "x", None), (None, "y", 2.0)]


def test_not_a_number_is_missing_everywhere(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, float("nan")), ("b", 1, float("nan"))], "k string, p int, v double")
    assert rows(A.pivot_aggregation(df, ["k"], "p", "v", "avg")) == [("a", 1.0), ("b", None)]
    assert rows(A.grouped_measure(df, "k", "v", "sum", "s")) == [("a", 1.0), ("b", None)]


def test_decimal_fill_keeps_the_type(spark):
    from tablemill.operators.cleaning import handle_missing_values

    df = spark.sql("SELECT CAST(x AS DECIMAL(10,2)) AS fare FROM VALUES (1.10), (2.20), (NULL) AS t(x)")
    filled = handle_missing_values(df, "mean")
    assert filled.dtypes == df.dtypes and [str(r[0]) for r in filled.orderBy("fare").collect()] == ["1.10", "1.65", "2.20"]
