from pyspark.sql import functions as F

from registry.storage import _json_document


def test_documents_grow_with_the_table(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").cast("int").alias("r_regionkey"), F.concat(F.lit("R"), "id").alias("r_name"))
    rows.write.parquet(str(tmp_path / "region.parquet"))
    got = _json_document(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [(i, f"R{i}") for i in range(20)]
    assert got.columns == rows.columns and len(got.inputFiles()) == 10
