"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

Statistics are taken per document with numpy. Trees are grown level by level from histograms of binned
statistics and stored as flat arrays, so that scoring walks all documents of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remainder
from .text import LOWER, SPACE, buffers, slices, word_hashes, words

# Labelled rows the trees are grown from, at most; the rows with the smallest hash of their id are taken.
TRAIN_ROWS = 20_000

STATISTICS = (
    "log_chars", "log_words", "word_mean", "word_max", "upper", "lower", "digit", "punct", "other", "space",
    "lines", "line_repeat", "distinct", "top_word", "same_as_last", "pair_repeat", "exclaim", "bar", "stop",
    "at_sign", "long_words", "entropy", "line_mean", "short_lines",
)

_CLASS = np.zeros((8, 256), dtype=bool)
_CLASS[0, 65:91] = True
_CLASS[1, 97:123] = True
_CLASS[2, 48:58] = True
_CLASS[3, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_CLASS[4, 128:] = True
_CLASS[5] = SPACE
_MARKS = {"exclaim": ord("!"), "bar": ord("|"), "stop": ord("."), "at_sign": ord("@")}


def _row(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, lines: list[bytes]) -> list[float]:
    counts = np.bincount(data, minlength=256)
    size, n = max(1, len(data)), max(1, len(starts))
    classes = (_CLASS[:6] * counts).sum(axis=1) / size
    lengths = ends - starts
    _, tally = np.unique(hashes, return_counts=True)
    pairs = hashes[:-1] * np.uint64(31) + hashes[1:]
    used = np.array([len(line) for line in lines if line.strip()] or [0])
    share = counts[counts > 0] / size
    return [
        np.log1p(len(data)), np.log1p(len(starts)),
        lengths.mean() if len(starts) else 0.0, lengths.max() if len(starts) else 0.0,
        *classes,
        len(used) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        len(tally) / n,
        tally.max() / n if len(tally) else 0.0,
        (hashes[:-1] == hashes[1:]).mean() if len(starts) > 1 else 0.0,
        1 - len(np.unique(pairs)) / len(pairs) if len(pairs) else 0.0,
        *(counts[c] / n for c in _MARKS.values()),
        (lengths > 20).mean() if len(starts) else 0.0,
        float(-(share * np.log(share)).sum()),
        np.log1p(used.mean()), (used < 30).mean(),
    ]


def statistics(column) -> np.ndarray:
    """One row of STATISTICS per text; null counts as empty."""
    data, offsets = buffers(column)
    rows = []
    for first, last in slices(offsets):
        part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends, at = words(part, bounds)
        hashes = word_hashes(part, starts, ends)
        for k in range(last - first):
            lo, hi = bounds[k], bounds[k + 1]
            a, b = at[k], at[k + 1]
            lines = LOWER[part[lo:hi]].tobytes().split(b"\n") if hi > lo else []
            rows.append(_row(part[lo:hi], starts[a:b], ends[a:b], hashes[a:b], lines))
    return np.array(rows, dtype=np.float32).reshape(-1, len(STATISTICS))


@dataclass
class Trees:
    """Flat trees: node ``i`` of tree ``t`` is at ``t * size + i``, its children at ``2 i + 1`` and ``2 i + 2``."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(x), self.start)
        size = (1 << (self.depth + 1)) - 1
        rows = np.arange(len(x))
        for base in range(0, len(self.feature), size):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[base + node]
                right = x[rows, f] > self.cut[base + node]
                node = 2 * node + 1 + right
            total += self.value[base + node]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 5.0) -> Trees:
    """Boosted trees for 0/1 labels. Without rows, or with one label only, every score is the label's share."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    size = (1 << (depth + 1)) - 1
    start = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), depth, start)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    feature, cut, value = (np.zeros(trees * size, dtype) for dtype in (np.int64, np.float64, np.float64))
    cut[:] = np.inf
    total = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), dtype=np.int64)
        base = t * size
        for level in range(depth):
            low, width = (1 << level) - 1, 1 << level
            place = node - low
            gain = np.full((width, x.shape[1], bins), -np.inf)
            sum_g, sum_h = np.bincount(place, g, width)[:, None], np.bincount(place, h, width)[:, None]
            for f in range(x.shape[1]):
                cell = place * bins + binned[:, f]
                left_g = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(axis=1)
                left_h = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(axis=1)
                right_h = sum_h - left_h
                with np.errstate(divide="ignore", invalid="ignore"):
                    got = left_g**2 / (left_h + 1) + (sum_g - left_g) ** 2 / (right_h + 1) - sum_g**2 / (sum_h + 1)
                got[(left_h < least) | (right_h < least)] = -np.inf
                got[:, len(edges[f]) :] = -np.inf
                gain[:, f] = got
            best = gain.reshape(width, -1).argmax(axis=1)
            useful = gain.reshape(width, -1).max(axis=1) > 1e-6
            f, b = best // bins, best % bins
            for k in np.flatnonzero(useful):
                feature[base + low + k], cut[base + low + k] = f[k], edges[f[k]][b[k]]
            right = useful[place] & (binned[np.arange(len(y)), f[place]] > b[place])
            node = 2 * node + 1 + right
        low = (1 << depth) - 1
        leaf = rate * np.bincount(node - low, g, 1 << depth) / (np.bincount(node - low, h, 1 << depth) + 1)
        value[base + low : base + size] = leaf
        total += leaf[node - low]
    return Trees(feature, cut, value, depth, start)


def _with_statistics(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = statistics(batch.column("_text"))
            columns = [batch.column(c) for c in range(batch.num_columns - 1)]
            columns.append(pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32())))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "_x"])

    rest = [c for c in docs.columns if c != "_text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema), "_x array<float>"])
    return docs.select(*rest, "_text").mapInArrow(run, schema)


def fit_quality(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = 7, **options) -> Trees:
    """Trees from ``stats`` (``doc_id, _x``) and ``labels`` (``doc_id, quality``).

    At most ``train_rows`` labelled rows are used, those with the smallest hash of their id; labels other
    than 0 and 1 are left out, of several labels of a document the smallest counts.
    """
    known = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_y"))
    joined = stats.join(known, F.col("doc_id") == F.col("_id")).select("_x", "_y", F.xxhash64(F.lit(seed), "doc_id").alias("_h"), "doc_id")
    rows = joined.orderBy("_h", "doc_id", "_x").limit(train_rows).select("_x", "_y").toArrow()
    x = np.array(rows.column("_x").to_pylist(), dtype=np.float32).reshape(-1, len(STATISTICS))
    return grow(x, np.array(rows.column("_y").to_pylist(), dtype=np.float64), **options)


def score_quality(docs: DataFrame, labels: DataFrame, holdout=None, train_rows: int = TRAIN_ROWS, **options) -> DataFrame:
    """``doc_id, score`` (0 to 1, higher: label 1 likelier) for each row of ``docs`` (``doc_id, text``).

    ``holdout`` is a condition on ``doc_id``; where it holds, labels are not learnt from. Only the text enters
    a score. Null and empty texts are scored too, repeated rows alike, other columns are ignored; an empty
    table gives an empty result, no usable label the same score for all. Runs a job that stores the
    statistics and one that fits.
    """
    stats = materialize(_with_statistics(docs.select("doc_id", F.col("text").alias("_text"))), "stats")
    usable = labels.select("doc_id", "quality")
    usable = usable.where(~F.coalesce(holdout, F.lit(False))) if holdout is not None else usable
    return _score(stats, fit_quality(stats, usable, train_rows, **options))


def _score(stats: DataFrame, trees: Trees) -> DataFrame:
    def run(batches):
        for batch in batches:
            flat = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            scores = pa.array(trees.score(flat), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    kind = dict(stats.dtypes)["doc_id"]
    return stats.select("doc_id", "_x").mapInArrow(run, f"doc_id {kind}, score double")


def keep_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows scored below ``least``. All labels are learnt from, unless ``holdout`` says else.

    Trees are fitted first; then every row is scored where it is read, so that texts are not shuffled.
    """
    holdout = options.pop("holdout", None)
    usable = labels.select("doc_id", "quality")
    usable = usable.where(~F.coalesce(holdout, F.lit(False))) if holdout is not None else usable
    stats = materialize(_with_statistics(docs.select("doc_id", F.col("text").alias("_text"))), "stats")
    trees = fit_quality(stats, usable, **options)

    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array(trees.score(statistics(text)) >= least))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    return remainder(doc_id, 3) == 1
