"""CSV files cut at every place, read back whole."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablemill.sinks.files import export_csv
from tablemill.sources import files as S
from tablemill.sources.records import CsvDialect, csv_records

SCHEMA = "id long, a string, b string"


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes, shorter than many a record."""
    names = {"spark.sql.files.maxPartitionBytes": "211", "spark.sql.files.openCostInBytes": "211"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sample(seed):
    draw = random.Random(seed)
    pieces = ["x", '"', ",", "\n", "é", "word ", '""', "\n\n", '",', ',"', "\r\n", "a" * 170, "\n" * 99 + "b"]
    return [(i, *("v" + "".join(draw.choice(pieces) for _ in range(draw.randrange(0, 9))) + "." for _ in range(2))) for i in range(40)]


@pytest.mark.parametrize("seed", range(2))
def test_quoted_breaks_in_split_files(spark, tmp_path, small_splits, seed):
    data = sample(seed)
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([("id", "a", "b"), *data])
    (tmp_path / "t.csv").write_bytes(text.getvalue().encode())
    path = str(tmp_path / "t.csv")
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    found = csv_records(spark, path)
    assert sorted(next(csv.reader(io.StringIO(r["record"], newline="")))[0] for r in found.collect()) == sorted(str(d[0]) for d in data)
    assert rows(S.load_data(spark, path, schema=SCHEMA)) == rows(spark.createDataFrame(data, SCHEMA))
    good, bad = S.read_with_rejects(spark, path, S._struct(SCHEMA))
    assert rows(good) == rows(spark.createDataFrame(data, SCHEMA)) and bad.count() == 0


def test_rejects_keep_the_whole_record(spark, tmp_path, small_splits):
    df = spark.createDataFrame(sample(9), SCHEMA).withColumn("id", F.when(F.col("id") % 3 == 0, F.lit("n\n/a")).otherwise(F.col("id").cast("string")))
    path = export_csv(df, str(tmp_path / "out.csv"))
    good, bad = S.read_with_rejects(spark, path, S._struct(SCHEMA))
    assert rows(good) == rows(df.where(~F.col("id").startswith("n")).withColumn("id", F.col("id").cast("long")))
    lines = [next(csv.reader(io.StringIO(r["raw_record"], newline=""))) for r in bad.collect()]
    assert sorted(map(tuple, lines)) == sorted(tuple(r) for r in df.where(F.col("id").startswith("n")).collect())
    assert all(r["path"].endswith(".csv") for r in bad.collect())


def test_blanks_and_breaks_at_the_ends_read_back(spark, tmp_path):
    data = [(1, "  a ", "\nb\n\n"), (2, " ", '"\n'), (3, None, "c")]
    path = export_csv(spark.createDataFrame(data, SCHEMA), str(tmp_path / "t.csv"))
    assert rows(S.load_data(spark, path, schema=SCHEMA)) == rows(spark.createDataFrame(data, SCHEMA))


def test_quotes_inside_unquoted_values_are_text(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_text('id,a,b\n1,5" pipe,"open\nbreak"\n2,6" pipe,plain\r\n\n3,"q"" x",\n4,"never closed\nat all')
    got = [tuple(r) for r in S.load_data(spark, str(tmp_path / "t.csv"), schema=SCHEMA).orderBy("id").collect()]
    assert got[:3] == [(1, '5" pipe', "open\nbreak"), (2, '6" pipe', "plain"), (3, 'q" x', None)] and got[3][0] == 4
    assert CsvDialect().stays_open('a,"b', False) and not CsvDialect().stays_open('a"b,c"', False) and CsvDialect().stays_open('x"",', True)


def test_files_of_single_lines_go_to_the_plain_reader(spark, tmp_path, small_splits):
    data = [(i, f'say "{i}", twice', "b") for i in range(60)]
    path = export_csv(spark.createDataFrame(data, SCHEMA).coalesce(1), str(tmp_path / "t.csv"))
    assert csv_records(spark, path) is None
    read = S.load_data(spark, path, schema=SCHEMA)
    assert rows(read) == rows(spark.createDataFrame(data, SCHEMA)) and read.rdd.getNumPartitions() > 5
    tabs = tmp_path / "tabs.csv"
    tabs.write_text("1\tx\t'two\nlines'\n")
    assert rows(S.load_data(spark, str(tabs), schema=SCHEMA, sep="\t", quote="'", header=False)) == [(1, "x", "two\nlines")]
