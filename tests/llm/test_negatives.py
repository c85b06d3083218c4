"""Hard negatives against scoring every pair, and the index against plain products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemill.llm import negatives
from tablemill.llm import queries as registered
from tablemill.llm.negatives import Index, _prefix_norms, hard_negatives, quantised

SCHEMA = "vec_id long, embedding array<double>, label int, score int"


def plain(rows, every=100):
    """``rows``: distinct (id, label, whole-number vector)."""
    out = []
    last = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for anchor, label, vector in rows:
        if anchor is None or anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, other) for i, other, v in rows if len(v) == len(vector) and (i is None or i != anchor)]
        for positive, pid, _ in sorted((s for s in scored if s[2] == label), key=last)[:5]:
            window = [s for s in scored if s[2] != label and 80 * positive <= 100 * s[0] <= 100 * positive]
            for rank, (score, nid, _) in enumerate(sorted(window, key=last)[:5], 1):
                out.append((anchor, pid, rank, nid, positive, score))
    return sorted(out, key=str)


def moved(vec_id, label):
    return (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label


def whole(vector, scale=256):
    return tuple(math.floor(scale * float(x)) for x in vector)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_op12_equals_all_pairs(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(r[0], moved(r[0], r[2]), whole(r[1])) for r in table]
    want = plain(rows)
    assert want and result(registered.QUERIES["op12_hard_negatives"](spark, sf)) == want


@pytest.mark.parametrize("sample", [4096, 8])
def test_cells_and_lowered_thresholds(spark, monkeypatch, sample):
    """Clustered vectors with ties in many small cells; a sample of eight rows needs lowered thresholds."""
    monkeypatch.setattr(negatives, "SAMPLE", sample)
    monkeypatch.setattr(negatives, "ROW_VALUES", 600)
    monkeypatch.setattr(negatives, "ANCHOR_VALUES", 64)
    monkeypatch.setattr(negatives, "AT_ONCE", 16)
    draw = random.Random(3)
    centres = [[draw.gauss(0, 1) for _ in range(24)] for _ in range(9)]
    rows = []
    for i in range(700):
        c = draw.choice(centres)
        rows.append((i, i % 3 if i % 50 else 77, [x + draw.choice([0, 0, draw.gauss(0, 0.3)]) for x in c]))
    df = quantised(spark.createDataFrame([(i, v, label) for i, label, v in rows], "vec_id long, embedding array<double>, label int"), 16)
    want = plain([(i, label, whole(v, 16)) for i, label, v in rows], 20)
    assert want and result(hard_negatives(df, F.col("vec_id") % 20 == 0)) == want


def test_edges(spark):
    big = 4e6
    vectors = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.5, 1.0], 2), (1, [1.0, 0.5], 1), (2, [0.9, 0.5], 2), (3, None, 1), (4, [1.0, None], 1),
        (5, [1.0, float("nan")], 2), (6, [float("inf"), 1.0], 2), (None, [1.0, 0.4], 2), (None, [1.0, 0.4], 2), (8, [1.0, 0.3], None),
        (9, [1.0], 1), (100, [], 1), (11, [], 1), (12, [], 2), (200, [-big, 0.0, 0.0], 1), (13, [-big, 1.0, 0.0], 1), (14, [-big + 1, 0.0, 1.0], 2),
        (300, [0.0, 0.0], 3), (15, [1e30, 1e30], 3),
    ]
    df = spark.createDataFrame([(*v, 1) for v in vectors], SCHEMA)
    usable = [(i, label, whole(v)) for i, v, label in vectors if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = [r for r in dict.fromkeys(usable) if sum(x * x for x in r[2]) < 1 << 62]
    got = result(hard_negatives(quantised(df), F.col("vec_id") % 100 == 0))
    assert got == plain(usable) and any(r[4] > 1 << 52 for r in got)
    assert hard_negatives(quantised(df.limit(0)), F.col("vec_id") % 100 == 0).count() == 0


def test_index_leaves_out_and_prunes():
    draw = np.random.default_rng(5)
    anchors, rows = draw.integers(-40, 40, (30, 48)).astype(float), draw.integers(-40, 40, (200, 48)).astype(float)
    anchors[:, :30], rows[:, :30] = np.sign(anchors[:, :30]), np.sign(rows[:, :30])
    scores = rows @ anchors.T
    thresholds = np.sort(scores, axis=0)[-4]
    index = Index(anchors, thresholds, _prefix_norms(rows))
    assert index.skipped.min() > 0
    found = set(zip(*(a.tolist() for a in index.candidates(rows, _prefix_norms(rows)))))
    want = {(r, a, int(scores[r, a])) for r, a in zip(*np.nonzero(scores >= thresholds))}
    assert want <= found and len(found) < scores.size / 2
    assert all(scores[r, a] == s for r, a, s in found)
