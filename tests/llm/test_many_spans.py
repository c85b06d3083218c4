"""Spans of texts with very many matches, against a plain search."""

from __future__ import annotations

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from tablemill.llm import secrets

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
ENCODINGS = [
    (r"[0-9a-f]+", DIGITS, LOWER), (r"[0-9A-F]+", DIGITS, UPPER), (r"[A-Z2-7]+=*", DIGITS, UPPER), (r"[a-z2-7]+=*", DIGITS, LOWER),
    (r"[0-9A-Z]+=*", DIGITS, UPPER), (r"[0-9a-z]+=*", DIGITS, LOWER), (r"[0-9A-Za-z]+=*", UPPER, LOWER),
    (r"[0-9A-Za-z+/]+=*", UPPER, LOWER), (r"[0-9A-Za-z_-]+=*", UPPER, LOWER),
]


def coded(token):
    return any(re.fullmatch(p, token) and set(a) & set(token) and set(b) & set(token) for p, a, b in ENCODINGS)


def tokens_of(text):
    """Runs that have an encoding, then pieces of the others, then the runs in which no piece was found."""
    runs = [m for m in re.finditer(secrets.TOKEN, text) if sum(bool(set(m[0]) & set(c)) for c in (DIGITS, UPPER, LOWER)) >= 2]
    kept = [m for m in runs if coded(m[0])]
    for pattern in secrets.PIECES:
        kept += [m for m in re.finditer(pattern, text) if coded(m[0]) and not any(m.start() < o.end() and o.start() < m.end() for o in kept)]
    kept += [m for m in runs if not any(m.start() < o.end() and o.start() < m.end() for o in kept)]
    return sorted(m.span() for m in kept)


def glued(rng, n):
    letters = [LOWER, UPPER + DIGITS, LOWER + DIGITS, LOWER + UPPER + DIGITS, "0123456789abcdef", LOWER + UPPER + "+/", LOWER + UPPER + "_-"]
    parts = []
    for _ in range(n):
        parts.append("".join(rng.choices(rng.choice(letters), k=rng.choice([3, 8, 19, 20, 21, 33, 40]))))
        parts.append(rng.choice([" ", "=", "==", "_", "-", "+", "/", "\n", " é", " password=", " token: '", "🎈"]))
    return "".join(parts)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_tokens_equal_a_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(secrets, "BLOCK", block)
    rng = random.Random(block)
    texts = [glued(rng, rng.choice([1, 5, 30, 120])) for _ in range(60)] + [""]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    for r in secrets._with_tokens(df, "text").collect():
        assert sorted((t["from"], t["upto"]) for t in r["_token"]) == tokens_of(r["text"])


@pytest.mark.parametrize("block", [1, 256])
def test_tokens_beside_other_spans(spark, monkeypatch, block):
    monkeypatch.setattr(secrets, "BLOCK", block)
    rng = random.Random(7)
    rows = []
    for i in range(200):
        cuts = sorted(rng.sample(range(300), 2 * rng.randint(0, 12)))
        tokens = [(a, b, 3, "t") for a, b in zip(cuts[::2], cuts[1::2])]
        others = [(a, a + rng.randint(1, 60), rng.randint(0, 2), "o") for a in (rng.randint(0, 300) for _ in range(rng.randint(0, 4)))]
        rows.append((i, rng.sample(tokens, len(tokens)), others))
    df = spark.createDataFrame(rows, f"i long, tokens {secrets.SPANS}, others {secrets.SPANS}")
    for r in df.withColumn("free", secrets._untouched(F.col("tokens"), F.col("others"))).collect():
        want = [t[:2] for t in r["tokens"] if not any(o[0] < t[1] and t[0] < o[1] for o in r["others"])]
        assert sorted(t[:2] for t in r["free"]) == sorted(want)


def test_a_text_with_very_many_matches(spark):
    rng = random.Random(1)
    n = 20_000
    names = ["".join(rng.choices(LOWER + UPPER + DIGITS, k=24)) for _ in range(n)]
    text = " ".join(f"password = hunter{k:05} {w}" for k, w in enumerate(names))
    docs = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    assert spans[2] == []
    found = [s for s in spans[1] if s["rank"] == 0]
    assert [(s["from"], s["upto"]) for s in found] == [m.span() for m in re.finditer(r"password = hunter\d{5}", text)]
    assert sum(s["rank"] == 3 for s in spans[1]) > 0.8 * n
