"""Five-word shingles where a partition, or a slice of one, holds very few words."""

import pyarrow as pa
import pytest

from tablemill.llm.neardup import near_duplicates
from tablemill.llm.text import shingle_sets

BOOK = " ".join(f"word{i % 9973} tail{i}" for i in range(180_000))
TEXTS = ["two words", "now three words", BOOK, "two words", "one", "", "a b c d e f g h", "Now three  words"]


def plain(text, n):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize("n", [1, 2, 5])
def test_shingles_of_short_slices(n):
    assert len(BOOK) > 3_000_000
    for part in ([0], [1], [4], [5], [0, 2], [2, 1], range(len(TEXTS))):
        got = list(shingle_sets(pa.array([TEXTS[i] for i in part]), n))
        assert [len(g) for g in got] == [len(plain(TEXTS[i], n)) for i in part]
    alone = [next(shingle_sets(pa.array([t]), n)).tolist() for t in TEXTS]
    assert [g.tolist() for g in shingle_sets(pa.array(TEXTS), n)] == alone


def test_near_duplicates_of_short_partitions(spark):
    # One partition of a two-word text, one with a short text before a long one.
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(i, t) for i, t in enumerate(TEXTS[:4])], 4), "doc_id long, text string").coalesce(3)
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in near_duplicates(docs, shingle=5, percent=80).collect()}
    assert got == {0: (0, 1), 1: (1, 1), 2: (2, len(plain(BOOK, 5))), 3: (0, 1)}
