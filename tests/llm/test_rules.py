"""Quality rules: base counts, the learner and the emitted expression against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablemill.llm import queries as registered
from tablemill.llm.rules import BASE, SHARES, apply_quality_rules, best_condition, covered, learn_rules, learned_from, rule_column, text_statistics

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)]


def test_op11_base_and_verdict(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = registered.QUERIES["op11_quality_rules"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base = plain_base(texts[r["doc_id"]])
        assert [r[c] for c in BASE] == base
        assert r["base_failed"] == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    right = sum(r["kept"] == (marks[r["doc_id"]] == 1) for r in got if r["doc_id"] in marks)
    assert right >= 0.9 * len(marks)


def test_rules_on_other_documents(spark):
    """Learned from two thirds of the labels, the rules keep clean documents of the last third and find the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    unseen = {i for i in marks if zlib.crc32(str(i).encode()) % 3 == 1}
    labels = spark.createDataFrame([(i, q) for i, q in marks.items() if i not in unseen], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in apply_quality_rules(docs, labels).collect() if r["doc_id"] in unseen}
    clean, poor = ([got[i] for i in unseen if marks[i] == q] for q in (1, 0))
    assert sum(clean) >= 0.98 * len(clean) and sum(poor) <= 0.2 * len(poor)


def test_expression_equals_a_walk_of_the_list(spark, sf):
    stats = text_statistics(spark.read.parquet(f"{sf}/documents.parquet"))
    rules = learned_from(stats, spark.read.parquet(f"{sf}/labels.parquet"))
    draw = np.random.default_rng(1)
    x = np.array([[r[c] for c in SHARES] for r in stats.collect()])
    rules += learn_rules(x, draw.random(len(x)) < x[:, 3] + x[:, 10] / 2, precision=0.5)
    assert rules
    for r in stats.withColumn("rule", rule_column(rules)).collect():
        first = next((i for i, rule in enumerate(rules, 1) if all(r[c.statistic] <= c.value if c.at_most else r[c.statistic] > c.value for c in rule)), None)
        assert r["rule"] == first


def test_best_condition_equals_trying_every_cut():
    draw = np.random.default_rng(2)
    names = ("a", "b", "c")
    for _ in range(30):
        x = draw.integers(0, 6, (40, 3)) / 4
        bad = draw.random(40) < 0.2 + 0.3 * x[:, 1] / 1.5
        if not bad.any():
            continue
        gains = []
        for f in range(3):
            for cut in np.unique(x[:, f])[:-1]:
                for inside in (x[:, f] <= cut, x[:, f] > cut):
                    p, n = bad[inside].sum(), (~bad[inside]).sum()
                    gains.append(p * (math.log2(p / (p + n)) - math.log2(bad.mean())) if p else 0.0)
        gain, condition = best_condition(x, bad, names)
        assert gain == pytest.approx(max(max(gains), 1e-9))
        if condition is not None:
            inside = covered((condition,), x, names)
            p = bad[inside].sum()
            assert p * (math.log2(p / inside.sum()) - math.log2(bad.mean())) == pytest.approx(gain)


def test_planted_conjunctions_are_found():
    x = np.random.default_rng(4).random((3000, 4))
    bad = ((x[:, 0] > 0.8) & (x[:, 2] <= 0.4)) | (x[:, 3] > 0.95)
    rules = learn_rules(x, bad, ("a", "b", "c", "d"))
    found = np.any([covered(rule, x, ("a", "b", "c", "d")) for rule in rules], axis=0)
    assert (found == bad).mean() > 0.99 and {c.statistic for rule in rules for c in rule} <= {"a", "c", "d"}
    assert learn_rules(x, np.zeros(len(x), bool), ("a", "b", "c", "d")) == [] == learn_rules(x[:0], bad[:0])


def test_edges(spark):
    long = " ".join(f"w{i % 5000} é{i}" for i in range(400_000))
    texts = [
        None, "", " \t\n", "a b c d e a b c d e f g", "x\n\n x\nx\n x\ny z", "Ab ab " * 8, "é#ü *$%&|<> wide", "w" * 200_000 + " " + "w" * 200_000,
        "one two three four five six seven eight nine ten", "a\rb\rc", long,
    ]
    rows = [(None if i == 3 else i // 2, t, 1, 0.5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, entropy double")
    labels = spark.createDataFrame([(None, 0), (1, None), (2, 0), (2, 1)], "doc_id long, quality int")
    got = apply_quality_rules(docs, labels).collect()
    base = lambda r: [r[c] for c in BASE]
    assert sorted(map(base, got)) == sorted(plain_base(t or "") for t in texts)
    assert all(r["rule"] is None for r in got)
    assert apply_quality_rules(docs.limit(0), labels).count() == 0
    assert apply_quality_rules(docs, labels.limit(0)).where("kept").count() == sum(r["kept"] for r in got)
