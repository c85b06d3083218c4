"""Recall of op3_nearest where a query meets a part of the vectors only."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemill.llm.ann import nearest_neighbours


@pytest.mark.parametrize("n", [3_000, 9_000])
def test_recall_with_entries_far_below_n(spark, n):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 32))
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest_neighbours(docs, F.col("vec_id") % 100 == 0, entries=100).collect()
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    hit = 0
    for q in range(0, n, 100):
        score = unit @ unit[q]
        score[q] = -2
        hit += len({r["vec_id"] for r in got if r["query_id"] == q} & set(np.argsort(-score)[:5].tolist()))
    assert hit >= 0.9 * 5 * len(range(0, n, 100))
