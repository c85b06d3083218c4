"""Threshold-scaled document fingerprints.

A shingle is 16 code points (a shorter text is one shingle). Of all shingle hashes those below a fixed
fraction of the hash range are kept, whatever the length of the text, so the sketches of two texts, or of
their parts, can be merged and compared at any ratio of lengths. A text that keeps fewer than ``LEAST`` hashes
also keeps its next smallest ones up to that number; such a sketch has a lower sampled range, its largest
hash, and comparisons use the smaller range of the two.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import mix

WIDTH = 16
SCALE = 32
LEAST = 16
LIMIT = np.uint32(2**32 // SCALE)


def sketch(text: str) -> np.ndarray:
    """Sorted 32-bit hashes kept of a text; none for an empty one."""
    if not text:
        return np.empty(0, np.uint32)
    h = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    base, width = np.uint64(0x9E3779B97F4A7C15), 1
    if len(h) < WIDTH:
        powers = np.cumprod(np.full(len(h), base))
        h = (h * powers).sum(keepdims=True) + np.uint64(len(h))
    else:
        # Doubling: a window of 2 w is its two halves of w.
        while width < WIDTH:
            h = h[:-width] * base + h[width:]
            base, width = base * base, 2 * width
    h = (mix(h) >> np.uint64(32)).astype(np.uint32)
    kept = np.unique(h[h < LIMIT])
    if len(kept) >= LEAST:
        return kept
    if len(h) > 4 * LEAST:
        # The smallest positions may repeat a hash: widen until enough differ.
        want = 4 * LEAST
        while want < len(h) and len(np.unique(np.partition(h, want)[:want])) < LEAST:
            want *= 4
        h = np.partition(h, want)[:want] if want < len(h) else h
    return np.unique(h)[:LEAST]


def sampled_range(kept: np.ndarray) -> int:
    """Upper end (exclusive) of the hashes that a sketch holds completely."""
    if len(kept) < LEAST:
        return 1 << 32
    return max(int(LIMIT), int(kept[-1]) + 1)


def to_text(kept: np.ndarray) -> str:
    """Eight hexadecimal digits a hash, ascending."""
    return kept.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    top = min(sampled_range(left), sampled_range(right))
    both = np.union1d(left, right)
    small = both[both < LIMIT]
    if len(small) >= LEAST:
        return small
    return both[both < top][:LEAST]


def containment(own: np.ndarray, other: np.ndarray) -> float:
    """Estimated share of one text's shingles that the other has too; two empty texts contain each other."""
    if not len(own) or not len(other):
        return float(len(own) == len(other))
    top = min(sampled_range(own), sampled_range(other))
    seen = own[own < top]
    if not len(seen):
        return 0.0
    return len(np.intersect1d(seen, other, assume_unique=True)) / len(seen)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many from the start of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut] if cut else text


def _upto(value: Column, bounds: list, kind: str) -> Column:
    """How many of the ascending ``bounds`` are not above ``value``: blocks first, then one block's bounds."""
    size = math.isqrt(len(bounds) - 1) + 1
    blocks = [bounds[k : k + size] for k in range(0, len(bounds), size)]
    literal = lambda values: F.array(*(F.lit(b).cast(kind) for b in values))
    before = F.size(F.filter(literal(b[0] for b in blocks), lambda e: e <= value)) - 1
    table = F.array(*(literal(b) for b in blocks))
    inside = F.size(F.filter(F.element_at(table, before + 1), lambda e: e <= value))
    return F.when(before < 0, F.lit(0)).otherwise(before * size + inside)


def fingerprint_documents(docs: DataFrame, per_bucket: int = 5_000) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The next document is the one of the next larger id; the last is followed by the first. Rows that repeat
    an id follow each other by text, rows with a null id come last. A null text counts as empty; an empty
    text has an empty fingerprint. Other columns are ignored; an empty table gives an empty result. Rows of one id
    are read by one task, as are those of a null id, one text at a time. One job counts ids and picks bounds between
    buckets, among which an id is found in blocks; texts are then shuffled once.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    n, least = docs.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    buckets = max(1, min(10_000, n // per_bucket))
    bounds = []
    if buckets > 1:
        # An approximate percentile is one of the ids.
        shares = [k / buckets for k in range(buckets)]
        bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or []))
        bounds = [b for b in bounds if b > least]
    # Bucket k holds the ids from bounds[k - 1] up to bounds[k]; null ids are in the last one.
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(bounds)))
    if bounds:
        bucket = bucket.otherwise(_upto(F.col("doc_id"), bounds, kind))
    else:
        bucket = bucket.otherwise(F.lit(0))
    placed = docs.withColumn("bucket", bucket)
    starts = F.col("doc_id").isin(bounds) if bounds else F.lit(False)
    tails = F.when(starts, F.col("bucket") - 1)
    head = F.col("doc_id").eqNullSafe(F.lit(least).cast(kind))
    # A row goes to its bucket, as a tail to the one before, and the very first as a tail to the last.
    copies = F.filter(
        F.array(
            F.struct(F.col("bucket").alias("to"), F.lit(0).alias("tail")),
            F.struct(tails.alias("to"), F.lit(1).alias("tail")),
            F.struct(F.when(head, F.lit(len(bounds))).alias("to"), F.lit(2).alias("tail")),
        ),
        lambda c: c["to"].isNotNull(),
    )
    sent = placed.select("doc_id", "text", F.explode(copies).alias("c")).select("c.to", "c.tail", "doc_id", "text")
    ordered = sent.repartition("to").sortWithinPartitions("to", "tail", F.col("doc_id").asc_nulls_last(), "text")

    def run(batches):
        waiting = None
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("to", "tail", "doc_id", "text")]
            for i in range(batch.num_rows):
                to, tail, doc_id, text = (c[i].as_py() for c in columns)
                if waiting is not None and waiting[0] == to:
                    out.append(finish(waiting, text))
                    waiting = None
                if tail == 0:
                    waiting = (to, doc_id, text)
                if len(out) == 500:
                    yield table(out, columns[2].type)
                    out = []
            if out:
                yield table(out, columns[2].type)

    known: dict[str, tuple] = {}

    def finish(row, following):
        _, doc_id, text = row
        own = known.pop(text, None)
        own = sketch(text) if own is None else own
        after = edited(text, following)
        changed = own if after == text else sketch(after)
        known.clear()
        known[following] = sketch(following)
        return (
            doc_id, len(text), hashlib.sha256(after.encode()).hexdigest(), to_text(own), to_text(changed),
            containment(own, changed), containment(own, known[following]),
        )

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def table(rows, kind_of_id):
        kinds = [kind_of_id, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, schema)
