"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows and bytes a driver may hold when a small result (statistics, bounds) is pinned as literals.
PIN_ROWS, PIN_BYTES = 10_000, 8 << 20


def create_session(app_name: str = "tablemill", **conf: str) -> SparkSession:
    """Session with UTC timestamps and adaptive execution; ``conf`` wins over both."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Every executor must be able to read it, so without the setting this raises; a local session may name a
    folder of its own with ``setCheckpointDir``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages restart from the written files when an executor is lost, and prune columns and
    push filters into them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pin(df: DataFrame, label: str = "pinned", max_rows: int = PIN_ROWS, max_bytes: int = PIN_BYTES) -> DataFrame:
    """Compute a statistics table once, so that every task and every retry sees the same values.

    The table is written out and measured there; up to ``max_rows`` rows of up to ``max_bytes`` bytes (as
    text) become a local table with a broadcast hint, for a larger one the planner picks its joins by size.
    """
    stored = materialize(df, label)
    width = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    n, size = stored.agg(F.count(F.lit(1)), F.sum(width)).first()
    if n > max_rows or (size or 0) > max_bytes:
        return stored
    return F.broadcast(df.sparkSession.createDataFrame(stored.collect(), df.schema))


def observed_rows(observation: Observation) -> int:
    """The ``n`` an observation counted. Spark drops the counter when a table proves empty: that is 0."""
    try:
        return observation.get["n"]
    except (Py4JJavaError, KeyError):
        return 0
