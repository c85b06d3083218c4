"""From raw documents to packed training sequences: five stages, each one of the operators of ``tablemill.llm``.

Every stage works on all rows that the stage before it left, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablemill.llm.common import documents, materialize
from tablemill.llm.mixing import mixed_documents
from tablemill.llm.neardup import keep_one_of_each
from tablemill.llm.packing import pack_documents
from tablemill.llm.quality import held_out, keep_quality
from tablemill.llm.queries import tokenizer_path
from tablemill.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Rows held out in the operator's own query are not learnt from."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), holdout=held_out())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more on five-word shingles stays."""
    return keep_one_of_each(docs, shingle=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document may come up to three times."""
    return mixed_documents(docs, weights=(1, 2, 3), max_copies=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, placed in sequences of 2048."""
    return pack_documents(docs, tokenizer_path(), capacity=2048)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

# Tokenising, trees and sketches have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
