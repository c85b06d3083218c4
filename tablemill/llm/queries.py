"""The registered queries, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest_neighbours
from .common import documents, remainder
from .dialogue import damage_conversations, repair_report
from .fingerprints import fingerprint_documents
from .mixing import mix_sources
from .neardup import near_duplicates
from .negatives import hard_negatives, quantised
from .packing import pack_documents
from .quality import held_out, score_quality
from .repeats import remove_repeats
from .rules import BASE, apply_quality_rules
from .scoring import score_texts
from .secrets import joined_spans, scan_secrets
from .sharding import shard_documents

# Bytes of text in a shard.
SHARD_BYTES = 16 << 20


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out_rows = remainder("doc_id", 10) == 0
    scored = score_texts(documents(spark, sf_dir), tokenizer_path(), held_out_rows)
    return scored.withColumn("held_out", held_out_rows)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, F.col("vec_id") % 50 == 0, k=5)


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), SHARD_BYTES)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op6_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_secrets(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["rank"] < 3)
    number = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")
    return scanned.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(documents(spark, sf_dir), labels, holdout=held_out())
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path())


def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=2, percent=80)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return apply_quality_rules(documents(spark, sf_dir), labels).select("doc_id", *BASE, "base_failed", "kept", "rule")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(turns, damage_conversations(turns))


QUERIES = {
    f.__name__: f
    for f in (
        op1_score,
        op2_mix_sources,
        op3_nearest,
        op4_shard,
        op5_fingerprint,
        op6_scan_secrets,
        op7_quality,
        op8_pack,
        op9_remove_repeats,
        op10_near_duplicates,
        op11_quality_rules,
        op12_hard_negatives,
        op13_repair,
    )
}

# A document's shard is its shallowest prefix whose documents fit, or the first that is its own.
SHARDS = f"""
WITH RECURSIVE sized AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
    FROM documents),
levels AS (SELECT CAST(unnest(range(0, 61)) AS INTEGER) AS depth),
buckets AS (
    SELECT depth, h >> (60 - depth) AS prefix, count(*) AS shard_docs, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
    FROM sized, levels GROUP BY 1, 2),
fitting AS (SELECT * FROM buckets WHERE shard_bytes <= {SHARD_BYTES} OR shard_docs = 1)
SELECT doc_id, n_bytes, fitting.depth, prefix, CAST(0 AS BIGINT) AS row_prefix, shard_docs, shard_bytes
FROM sized JOIN fitting ON prefix = h >> (60 - fitting.depth)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY fitting.depth) = 1
"""

ORACLES = {"op4_shard": SHARDS}
