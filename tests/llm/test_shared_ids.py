"""Rows that share or lack an id, and texts of very long runs of blanks."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablemill.llm.packing import pack_documents
from tablemill.llm.queries import tokenizer_path
from tablemill.llm.repeats import remove_repeats
from tablemill.llm.tokens import ByteBpe

SCHEMA = "doc_id long, text string"


def plain_repeats(rows, least):
    """Kept bytes of every (id, text), each its own document in order of id (null first) and SHA-256."""
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    seen, kept = set(), {}
    for i, text in order:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - least + 1):
            window = data[k : k + least]
            if window in seen:
                gone[k : k + least] = True
            seen.add(window)
        kept[i, text] = bytes(np.frombuffer(data, np.uint8)[~gone])
    return kept


def check(spark, rows, least=100):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["kept_sha256"], r["n_bytes"]) for r in remove_repeats(docs, least).collect())
    kept = plain_repeats(rows, least)
    want = [(i is not None, i or 0, hashlib.sha256(kept[i, t or ""]).hexdigest(), len((t or "").encode())) for i, t in rows]
    assert got == sorted(want)


def test_each_text_of_a_shared_id_is_its_own_document(spark):
    draw = random.Random(5)
    block = lambda n: "".join(draw.choice("abcdefgh é") for _ in range(n))
    a, b, c = block(200), block(150), block(300)
    check(spark, [(None, a), (None, block(50) + a[:150] + block(40)), (5, a + b), (5, b + a), (5, b + a), (6, c), (6, None), (7, c + c), (None, None), (None, "")])


def test_many_texts_of_few_ids(spark):
    draw = random.Random(6)
    parts = ["".join(draw.choice("abcd") for _ in range(60)) for _ in range(12)]
    rows = [(draw.choice([None, 1, 1, 2, 3]), "".join(draw.choice(parts) for _ in range(draw.randrange(1, 6)))) for _ in range(150)]
    check(spark, rows, least=80)


def test_long_runs_of_blanks_have_the_ids_of_the_tokenizer_file(spark):
    path = tokenizer_path()
    own, file = ByteBpe(path), Tokenizer.from_file(path)
    long = 1_000_000
    texts = ["word" + " " * long + "word", "a" + "\n" * long, "\t" * long + "b", "x" + "　" * 200_000 + "y z", " \n\t " * 30_000 + "\nq" + " " * 9_999 + "k" + " " * 10_000]
    for text in texts:
        assert np.array_equal(np.frombuffer(own(text), "<u4"), file.encode(text, add_special_tokens=False).ids)
    small = ByteBpe(path, 512)
    assert small.plain.decode(np.frombuffer(small(texts[3]), "<u4").tolist()) == texts[3]
    pieces = pack_documents(spark.createDataFrame(list(enumerate(texts[:2])), SCHEMA), path)
    totals = {r["doc_id"]: r["n"] for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert totals == {i: len(file.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts[:2])}
