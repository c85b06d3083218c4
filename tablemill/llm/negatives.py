"""Hard negatives by threshold joins over an inverted index that leaves out what a bound covers (L2AP style).

For each anchor the best rows of its label are its positives; the hard negatives of a positive are the best rows of
other labels whose score lies in a window below the positive's. Both are searches "best ``k`` below an upper bound",
answered by joins of all pairs that reach a threshold:

- Components are ordered by their energy. An anchor's first components are not indexed as long as their norm, times
  the largest such norm of any row, stays below the threshold: alone they cannot reach it.
- The rest is accumulated index block by index block; a row whose partial scores plus the product of the remaining
  norms stay below all thresholds is dropped on the way.
- Only the surviving pairs get the components that were left out, and so their exact scores.

Thresholds start high, from a bounded sample of rows, and are lowered for the windows that were not filled until
they are, or the window's own lower end is reached; so a threshold decides the work, never the result. Anchors
and rows meet in cells of bounded size, dealt by hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

# Values of one cell's rows and of its anchors, and rows scored at once.
ROW_VALUES, ANCHOR_VALUES, AT_ONCE = 1 << 21, 1 << 18, 1024
# Rows that first thresholds are read from. They never decide a result.
SAMPLE = 4096
HASHES = 1 << 40
INDEX_BLOCK = 16
LOWEST, HIGHEST = -(1 << 62), 1 << 62

ANCHOR = ["anchor_id", "anchor_key"]


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, vector`` with ``floor(scale * x)`` of each component, in double precision.

    Rows with a null label, a null vector or a component that is null or not finite are left out, and so are
    vectors whose squared norm would leave the range of scores (2^62).
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    norm = F.aggregate("_scaled", F.lit(0.0), lambda total, x: total + x * x)
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    rows = rows.select("vec_id", "label", scaled.alias("_scaled")).where(norm < float(HIGHEST))
    return rows.select("vec_id", "label", F.col("_scaled").cast("array<long>").alias("vector"))


class Index:
    """Anchors' components at and above ``skipped``, with the norms that bound the rest."""

    def __init__(self, anchors: np.ndarray, thresholds: np.ndarray, row_norms: np.ndarray):
        self.norms = _prefix_norms(anchors)
        # A hair of slack keeps rounded norms on the safe side.
        covered = self.norms * row_norms.max(axis=0, initial=0) * (1 + 1e-9) < thresholds[:, None]
        self.skipped = np.where(covered.all(axis=1), anchors.shape[1], covered.argmin(axis=1) - 1).clip(0)
        self.order = np.argsort(self.skipped, kind="stable")
        self.skipped = self.skipped[self.order]
        self.thresholds, self.norms = thresholds[self.order], self.norms[self.order]
        indexed = np.arange(anchors.shape[1]) >= self.skipped[:, None]
        self.indexed = np.where(indexed, anchors[self.order], 0)
        self.left_out = anchors[self.order] - self.indexed

    def candidates(self, rows: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor and exact score of every pair that reaches the anchor's threshold."""
        kept = np.arange(len(rows))
        partial = np.zeros((len(rows), len(self.indexed)), rows.dtype)
        width = rows.shape[1]
        least = int(self.skipped.min(initial=width))
        for high in range(width, least, -INDEX_BLOCK):
            low = max(high - INDEX_BLOCK, 0)
            active = int(np.searchsorted(self.skipped, high, side="left"))
            partial[:, :active] += rows[kept, low:high] @ self.indexed[:active, low:high].T
            below = np.maximum(self.skipped, low)
            rest = norms[kept][:, below] * self.norms[np.arange(len(below)), below] * (1 + 1e-9)
            alive = (partial + rest >= self.thresholds).any(axis=1)
            if not alive.all():
                kept, partial = kept[alive], partial[alive]
        rest = norms[kept][:, self.skipped] * self.norms[np.arange(len(self.skipped)), self.skipped] * (1 + 1e-9)
        at, anchor = np.nonzero(partial + rest >= self.thresholds)
        score = partial[at, anchor]
        for first in range(0, len(at), 1 << 16):
            part = slice(first, first + (1 << 16))
            score[part] += (rows[kept[at[part]]] * self.left_out[anchor[part]]).sum(axis=1)
        return kept[at], self.order[anchor], score.astype(np.int64)


def _prefix_norms(vectors: np.ndarray) -> np.ndarray:
    """Norms of the first 0, 1, ... components."""
    squares = np.cumsum(vectors.astype(np.float64) ** 2, axis=1)
    return np.sqrt(np.concatenate([np.zeros((len(vectors), 1)), squares], axis=1))


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The first ``k`` per window of ``window, score, id, id is null``: higher scores, then smaller ids."""
    window, score, ids, missing = found
    order = np.lexsort((ids, missing, -score, window))
    window = window[order]
    rank = np.arange(len(window)) - np.searchsorted(window, window)
    return [column[order[rank < k]] for column in found]


def _search_cell(table: pa.Table, k: int, same: bool) -> list[np.ndarray]:
    """Windows, scores and ids found in one cell, and its windows' anchors and slots."""
    tag = table["tag"].to_numpy()
    anchors, rows = (table.filter(pa.array(tag == t)).combine_chunks() for t in (0, 1))
    width = int(table["width"][0].as_py())
    matrix = lambda t: t["vector"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, width)
    slots = [s or [] for s in anchors["slots"].to_pylist()]
    owner = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    upper = np.array([w["upper"] for s in slots for w in s], np.int64)
    floor = np.array([w["floor"] for s in slots for w in s], np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in slots])])
    q, x = matrix(anchors), matrix(rows)
    energy = np.sqrt((q.astype(np.float64) ** 2).sum(axis=0) * (x.astype(np.float64) ** 2).sum(axis=0))
    order = np.argsort(energy, kind="stable")
    largest = max((np.linalg.norm(m.astype(np.float64), axis=1).max(initial=0) for m in (q, x)), default=0)
    kind = np.float64 if largest**2 < 2**52 else np.int64  # both add the integers exactly
    q, x = (np.ascontiguousarray(m[:, order]).astype(kind) for m in (q, x))
    ids = lambda t: (t["vec_id"].fill_null(0).to_numpy().astype(np.int64), t["vec_id"].is_null().to_numpy())
    anchor_id, row_id, row_null = ids(anchors)[0], *ids(rows)
    labels = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    anchor_label, row_label = labels[tag == 0], labels[tag == 1]
    best = [np.empty(0, np.int64) for _ in range(3)] + [np.empty(0, bool)]
    for first in range(0, len(x), AT_ONCE):
        part = slice(first, first + AT_ONCE)
        norms = _prefix_norms(x[part])
        least = np.minimum.reduceat(floor, bounds[:-1]).astype(np.float64)
        index = Index(q, least - np.abs(least) * 1e-12, norms)
        at, anchor, score = index.candidates(x[part], norms)
        at = at + first
        wanted = ((row_label[at] == anchor_label[anchor]) == same) & (row_null[at] | (row_id[at] != anchor_id[anchor]))
        at, anchor, score = at[wanted], anchor[wanted], score[wanted]
        for j in range(int(np.diff(bounds).max(initial=0))):
            has = np.diff(bounds)[anchor] > j
            window = bounds[anchor[has]] + j
            inside = (score[has] >= floor[window]) & (score[has] <= upper[window])
            mine = [window[inside], score[has][inside], row_id[at[has]][inside], row_null[at[has]][inside]]
            best = [np.concatenate(pair) for pair in zip(best, mine)]
        best = _best(best, k)
        full = np.flatnonzero(np.bincount(best[0], minlength=len(floor)) >= k)
        floor[full] = best[1][np.searchsorted(best[0], full, side="right") - 1]  # the k-th best so far
    window, score, found, missing = best
    owner, numbers = owner[window], np.array([w["slot"] for s in slots for w in s], np.int32)[window]
    return [anchors["vec_id"].take(pa.array(owner)), anchors["key"].take(pa.array(owner)), pa.array(numbers), pa.array(found, pa.int64(), mask=missing), pa.array(score)]


def _threshold_join(rows: DataFrame, anchors: DataFrame, slots: DataFrame, k: int, same: bool) -> DataFrame:
    """``anchor_id, anchor_key, slot, vec_id, score, rank``: the best ``k`` rows of each slot at or above its floor.

    ``slots`` (``anchor_id, anchor_key, slot, upper, floor``) holds a few rows per anchor. Anchors meet the rows of
    their label only if ``same``.
    """
    part = "label" if same else None
    kinds = dict(rows.dtypes)
    group = F.col(part).cast("string") if part else F.lit("")
    own = slots.groupBy(*ANCHOR).agg(F.collect_list(F.struct("slot", "upper", "floor")).alias("slots"))
    asked = anchors.join(own, [F.col("vec_id") == F.col("anchor_id"), F.col("key") == F.col("anchor_key")]).drop(*ANCHOR)
    asked = asked.withColumns({"tag": F.lit(0), "part": group})
    met = rows.withColumns({"tag": F.lit(1), "part": group, "slots": F.lit(None).cast("array<struct<slot:int,upper:long,floor:long>>")})

    def cells(df: DataFrame, values: int, least: int) -> DataFrame:
        n = F.ceil(F.count(F.lit(1)) * F.greatest("width", F.lit(1)) / values)
        spread = F.least(F.ceil(F.count(F.lit(1)) / 512), F.lit(least))
        return df.groupBy("width", "part").agg(F.greatest(n, spread).cast("long").alias("n"))

    threads = rows.sparkSession.sparkContext.defaultParallelism
    grid = cells(met, ROW_VALUES, 4 * threads).withColumnRenamed("n", "row_cells").join(cells(asked, ANCHOR_VALUES, 1).withColumnRenamed("n", "anchor_cells"), ["width", "part"])
    grid = materialize(grid, "grid")
    total = grid.agg(F.sum(F.col("row_cells") * F.col("anchor_cells"))).first()[0] or 1
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    mine = lambda n: F.pmod("key", F.col(n))
    left = asked.join(grid, ["width", "part"]).withColumn("anchor_cell", mine("anchor_cells")).withColumn("row_cell", every("row_cells"))
    right = met.join(grid, ["width", "part"]).withColumn("row_cell", mine("row_cells")).withColumn("anchor_cell", every("anchor_cells"))
    names = ["width", "part", "row_cell", "anchor_cell", "tag", "vec_id", "key", "label", "vector", "slots"]
    dealt = left.select(*names).unionByName(right.select(*names)).repartition(int(min(total, 20 * threads + total // 16)), *names[:4])
    schema = f"anchor_id {kinds['vec_id']}, anchor_key long, slot int, vec_id {kinds['vec_id']}, score long"

    def run(table: pa.Table) -> pa.Table:
        tags = table["tag"].to_numpy()
        if tags.min() == tags.max():
            columns = [pa.array([], pa.int64())] * 2 + [pa.array([], pa.int32())] + [pa.array([], pa.int64())] * 2
        else:
            columns = _search_cell(table, k, same)
        kinds = [table.schema.field("vec_id").type, pa.int64(), pa.int32(), table.schema.field("vec_id").type, pa.int64()]
        return pa.table([c.cast(t) for c, t in zip(columns, kinds)], names=["anchor_id", "anchor_key", "slot", "vec_id", "score"])

    found = dealt.groupBy(*names[:4]).applyInArrow(run, schema)
    order = Window.partitionBy(*ANCHOR, "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _fill_windows(rows: DataFrame, anchors: DataFrame, slots: DataFrame, k: int, same: bool, share: float) -> DataFrame:
    """The best ``k`` rows of each slot (``anchor_id, anchor_key, slot, lower, upper``) between its bounds."""
    # The lowest hashes, few enough before any task sends its first ones.
    hashed = F.pmod(F.col("key"), F.lit(HASHES))
    sample = materialize(rows.where(hashed < int(HASHES * min(1.0, 1.2 * share))).orderBy(hashed, "vec_id").limit(SAMPLE), "sample")
    known = _threshold_join(sample, anchors, slots.withColumnRenamed("lower", "floor"), k, same)
    first = min(k, int(np.ceil(k * share)) + 1)
    score = lambda r: F.max(F.when(F.col("rank") == r, F.col("score")))
    known = known.groupBy(*ANCHOR, "slot").agg(score(first).alias("high"), score(k).alias("sure"))
    # Each slot's thresholds: the sample's guess, its k-th best (which k rows reach), the lower bound.
    levels = F.array_distinct(F.filter(F.array("high", "sure", F.when(F.col("sure").isNull(), F.col("lower"))), lambda t: t.isNotNull()))
    left = materialize(slots.join(known, [*ANCHOR, "slot"], "left").withColumn("levels", levels).drop("high", "sure"), "slots")
    done = []
    for step in range(3):
        floor = F.get("levels", F.lit(step))
        found = materialize(_threshold_join(rows, anchors, left.withColumn("floor", floor), k, same), "found")
        filled = found.groupBy(*ANCHOR, "slot").agg(F.count(F.lit(1)).alias("n"))
        state = left.join(filled, [*ANCHOR, "slot"], "left").withColumn("open", (F.coalesce("n", F.lit(0)) < k) & (F.size("levels") > step + 1))
        state = materialize(state, "state")
        done.append(found.join(state.where(~F.col("open")).select(*ANCHOR, "slot"), [*ANCHOR, "slot"], "left_semi"))
        left = state.where("open").drop("n", "open")
        if left.isEmpty():
            break
    total = done[0]
    for more in done[1:]:
        total = total.unionByName(more)
    return total


def hard_negatives(rows: DataFrame, anchors: Column, k: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors among ``rows``.

    ``rows`` has ``vec_id, label, vector`` (array of long). A score is the inner product with the anchor; higher
    ones come first, ties by smaller id (null last). Positives: the first ``k`` other rows of the anchor's label.
    Negatives of a positive: the first ``k`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    A row with the anchor's id is none of its others. Rows that agree in id, label and vector count once; rows
    that share only the id are rows of their own, as anchors too. Vectors of another length have no score. A null
    label or vector takes no part, a null id can be found but is no anchor. An anchor without positives or
    negatives gives no row; an empty table gives an empty result; other columns are ignored. Jobs run at once;
    rows, thresholds and what was found are stored in the shared folder.
    """
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).select("vec_id", "label", "vector").distinct()
    rows = materialize(rows.withColumns({"key": F.xxhash64("vec_id", "label", "vector"), "width": F.size("vector")}), "rows")
    chosen = materialize(rows.where(anchors & F.col("vec_id").isNotNull()), "anchors")
    share = SAMPLE / max(SAMPLE, rows.count())
    ask = chosen.select(F.col("vec_id").alias("anchor_id"), F.col("key").alias("anchor_key"))
    ask = ask.withColumns({"slot": F.lit(0), "lower": F.lit(LOWEST), "upper": F.lit(HIGHEST)})
    positives = materialize(_fill_windows(rows, chosen, ask, k, True, share), "positives")
    positives = positives.select(*ANCHOR, F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # A positive below zero has no window.
    scaled = lambda percent, more: F.expr(f"({percent} * CAST(positive_score AS DECIMAL(38, 0)) + {more}) DIV 100")
    windows = positives.where("positive_score >= 0").select(
        *ANCHOR, "slot", scaled(low, 99).alias("lower"), scaled(high, 0).alias("upper")
    )
    negatives = _fill_windows(rows, chosen, windows, k, False, share)
    found = negatives.select(*ANCHOR, "slot", F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(found, [*ANCHOR, "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
