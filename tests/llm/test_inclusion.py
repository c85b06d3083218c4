"""Unequal inclusion odds of the mix, and how shards and buckets are found."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablemill.llm import fingerprints, sharding
from tablemill.llm.fingerprints import fingerprint_documents
from tablemill.llm.mixing import mix_sources, mixed_documents
from tablemill.llm.sharding import shard_documents


def due_of(sizes, weights, target, cap):
    """Copies in proportion to weight, ``cap`` at most, by closing one document after the other."""
    closed: set[int] = set()
    while True:
        left = target - sum(cap * sizes[k] for k in closed)
        level = left / sum(sizes[k] * weights[k] for k in range(len(sizes)) if k not in closed)
        more = {k for k in range(len(sizes)) if k not in closed and level * weights[k] > cap}
        if not more:
            return [cap if k in closed else level * weights[k] for k in range(len(sizes))]
        closed |= more


def classed(weight):
    return 2 ** (round(4 * math.log2(weight)) / 4)


@pytest.mark.parametrize("given", [None, "heavy"])
def test_inclusion_follows_the_weights(spark, given):
    sources, sizes = 300, [1, 2, 4, 8, 16, 32, 64, 3, 5, 9, 17, 33, 40, 50, 60]
    docs = spark.createDataFrame(
        [(s * 100 + k, f"s{s:03}", "w " * n, float(k * k * k + 1)) for s in range(sources) for k, n in enumerate(sizes)],
        "doc_id long, source string, text string, heavy double",
    )
    got = mix_sources(docs, weights=(1,), weight=F.col(given) if given else None).collect()
    weights = [classed(k**3 + 1 if given else math.log2(n + 2)) for k, n in enumerate(sizes)]
    due = due_of(sizes, weights, sum(sizes), 3)
    copies, words = Counter(), Counter()
    for r in got:
        copies[r["doc_id"] % 100] += r["copies"]
        words[r["source"]] += r["taken"]
        assert math.floor(due[r["doc_id"] % 100] + 1e-9) <= r["copies"] <= math.floor(due[r["doc_id"] % 100]) + 1
    assert max(due) > 2 * min(due)
    for k, d in enumerate(due):
        p = d - math.floor(d)
        # A fixed size in words moves the chances of Pareto sampling a little on 15 documents.
        assert abs(copies[k] / sources - d) < 5 * math.sqrt(p * (1 - p) / sources) + 0.1
    assert all(abs(n - sum(sizes)) <= max(sizes) / 2 for n in words.values())


def test_no_weight_no_copy(spark):
    docs = spark.createDataFrame(
        [(k, "a", "x " * (k + 1), w) for k, w in enumerate([1.0, None, 0.0, -2.0, float("nan"), float("inf"), 4.0])],
        "doc_id long, source string, text string, w double",
    )
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs, weight=F.col("w")).collect()}
    # 28 words are wanted; the two documents with a weight hold 8 and give three copies each.
    assert copies == {0: 3, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 3}
    assert mix_sources(docs.limit(0)).count() == 0 and mixed_documents(docs.limit(0)).count() == 0


def test_any_column_name(spark):
    docs = spark.createDataFrame([(1, "a", "x y", 7, 8, 9)], "doc_id long, source string, text string, _copies int, _copy int, `a.b` int")
    assert mixed_documents(docs).collect() == docs.collect()


def leaves(rows, limit):
    """Buckets by splitting on one hash bit after the other: name of each id and its hash."""
    out, todo = {}, [(0, 0, rows)]
    while todo:
        depth, prefix, bucket = todo.pop()
        if not bucket:
            continue
        if sum(n for _, _, n in bucket) <= limit or len(bucket) == 1:
            out |= {i: (depth, prefix) for i, _, _ in bucket}
            continue
        for bit in (0, 1):
            todo.append((depth + 1, 2 * prefix + bit, [r for r in bucket if r[1] >> (sharding.KEY_BITS - 1 - depth) & 1 == bit]))
    return out


def test_shards_in_many_passes(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(sharding, "STEP", 5)
    rng = random.Random(3)
    rows = [(k, "x" * rng.choice([1, 5, 40, 90])) for k in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = [(k, int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16), len(t)) for k, t in rows]
    got = {r["doc_id"]: (r["depth"], r["prefix"]) for r in shard_documents(docs, 200).collect()}
    assert got == leaves(hashed, 200)


def test_a_hot_key_goes_on_to_the_row_numbers(spark, monkeypatch):
    passes = []
    store = sharding.materialize
    monkeypatch.setattr(sharding, "materialize", lambda df, name: passes.append(name) or store(df, name))
    docs = spark.createDataFrame([(None if k % 3 == 0 else k, "x" * 10) for k in range(3_000)], "doc_id long, text string")
    got = shard_documents(docs, 500).collect()
    assert len(got) == 3_000
    shards = defaultdict(list)
    for r in got:
        shards[r["depth"], r["prefix"], r["row_prefix"]].append(r)
    for of in shards.values():
        assert len(of) == of[0]["shard_docs"] <= 50 and sum(r["n_bytes"] for r in of) == of[0]["shard_bytes"]
    hot = [r for r in got if r["doc_id"] is None]
    assert all(r["depth"] > sharding.KEY_BITS for r in hot)
    assert passes.count("directory") <= 4


@pytest.mark.parametrize("n", [1, 2, 3, 10, 17, 100])
def test_blocks_of_bounds(spark, n):
    bounds = sorted(random.Random(n).sample(range(-50, 500), n))
    got = spark.range(-60, 510).select("id", fingerprints._upto(F.col("id"), bounds, "bigint").alias("k")).collect()
    assert all(r["k"] == sum(b <= r["id"] for b in bounds) for r in got)


def test_many_buckets_give_the_same_fingerprints(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = sorted(map(tuple, fingerprint_documents(docs).collect()))
    assert sorted(map(tuple, fingerprint_documents(docs, per_bucket=7).collect())) == one
