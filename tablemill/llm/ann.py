"""Approximate nearest neighbours with an inverted multi-index.

Vectors are scaled to length 1 and cut into halves; each half has its own small set of centroids, fitted on a
bounded sample, and a cell is a pair of centroids. A query walks the pairs in ascending order of the summed
distance with a heap until the cells seen hold enough entries, and the entries are ranked by exact cosine.

For many queries at once the cells of one left centroid form a list, lists are cut into blocks, and a block
meets the queries that visit one of its cells in chunks: memory is bounded by block and chunk.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

# Vectors the centroids are fitted on, at most: those with the smallest hash of their id.
SAMPLE = 20_000
# Centroids of a half, at most, so that the table of cell sizes stays below 4 million numbers.
MOST_CENTROIDS = 2048
# Part of the distinct vectors that a query meets, at least. Of close to random ones it holds the nearest five with a
# recall of 0.94 among 10,256 and 0.98 among 51,282.
SHARE = 0.4
# Entries, and queries, that are compared together.
BLOCK, CHUNK = 4096, 512
# Queries whose cells one task walks.
WALKS = 256


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _stack(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def fit_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Plain k-means from distinct starting points."""
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    centroids = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (centroids**2).sum(axis=1) - 2 * x @ centroids.T
        owner = near.argmin(axis=1)
        counts = np.bincount(owner, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, x)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def _assign(unit: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    half = unit.shape[1] // 2
    parts = []
    for x, book in zip((unit[:, :half], unit[:, half:]), books):
        parts.append(((book**2).sum(axis=1) - 2 * x @ book.T).argmin(axis=1))
    return parts[0] * len(books[1]) + parts[1]


def cells_by_distance(left: np.ndarray, right: np.ndarray):
    """Pairs (i, j) by ascending ``left[i] + right[j]``: the multi-sequence walk."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen = [(left[a[0]] + right[b[0]], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield a[i], b[j]
        for i2, j2 in ((i + 1, j), (i, j + 1)):
            if i2 < len(a) and j2 < len(b) and (i2, j2) not in seen:
                seen.add((i2, j2))
                heapq.heappush(heap, (left[a[i2]] + right[b[j2]], i2, j2))


def nearest_neighbours(vectors: DataFrame, queries, k: int = 5, entries: int = 20_000, sample: int = SAMPLE, share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (``vec_id, embedding``) where ``queries`` holds.

    Score is the cosine in double precision; a query is no neighbour of its own id; ties go to the smaller
    id. A query meets at least ``entries`` distinct vectors and at least ``share`` of them, or all there are. Equal vectors are indexed once
    with their ``k + 1`` smallest ids, which is all that an answer can hold. Vectors that are null, zero, of
    another length than most, or hold null or non-finite numbers take no part; other columns are ignored; an
    empty table gives an empty result. Repeated rows of an id count as one candidate.
    """
    kind = dict(vectors.dtypes)["vec_id"]
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL").where(sound)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    schema = f"query_id {kind}, rank int, vec_id {kind}, score double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    # Minus zero equals zero as a number, and so as a vector.
    rows = rows.where(F.size("v") == sizes[0]["n"]).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    partial = rows.select("v", F.col("vec_id").alias("id"), F.xxhash64("v").alias("h"))
    entries_of = materialize(distinct_vectors(partial, k + 1), "vectors")
    n = entries_of.count()
    entries = max(entries, int(np.ceil(share * n)))
    fitted = entries_of.select("v", F.xxhash64("v", F.lit(1)).alias("h")).orderBy("h").limit(sample).toArrow()
    unit = _unit(_stack(fitted.column("v").combine_chunks()))
    half = unit.shape[1] // 2
    many = int(min(MOST_CENTROIDS, max(4, np.sqrt(n / 3))))
    books = [fit_centroids(x, many) for x in (unit[:, :half], unit[:, half:])]

    def index(batches):
        for batch in batches:
            cells = _assign(_unit(_stack(batch.column("v"))), books) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), batch.column("ids"), batch.column("v")], names=["cell", "ids", "v"])

    indexed = materialize(entries_of.select("ids", "v").mapInArrow(index, f"cell long, ids array<{kind}>, v array<double>"), "index")
    held = indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    right_size = len(books[1])
    # Entries per cell, 4 bytes each: at most MOST_CENTROIDS squared of them, 16 MB.
    filled = held.toArrow()
    per_cell = np.zeros(len(books[0]) * right_size, np.uint32)
    per_cell[filled.column("cell").to_numpy()] = filled.column("n").to_numpy()
    shared = vectors.sparkSession.sparkContext.broadcast(per_cell)
    asked = materialize(rows.where("q").select("vec_id", "v").dropDuplicates(["vec_id"]), "queries")
    n_asked = asked.count()
    chunks = -(-n_asked // CHUNK)

    def walk(batches):
        counted = shared.value
        for batch in batches:
            rows, lists, cells, chunk = [], [], [], []
            for row, v in enumerate(_unit(_stack(batch.column("v"))) if batch.num_rows else []):
                left = ((books[0] - v[:half]) ** 2).sum(axis=1)
                right = ((books[1] - v[half:]) ** 2).sum(axis=1)
                met, visited = 0, {}
                for i, j in cells_by_distance(left, right):
                    size = int(counted[int(i) * right_size + int(j)])
                    if size:
                        visited.setdefault(int(i), []).append(int(j))
                        met += size
                        if met >= entries:
                            break
                # Queries of near lists share a chunk.
                place = int(left.argmin()) * chunks // len(books[0]) + row % max(1, chunks // len(books[0]))
                for i, js in visited.items():
                    rows.append(row)
                    lists.append(i)
                    cells.append(js)
                    chunk.append(place)
            picked = pa.array(rows, pa.int64())
            columns = [batch.column("vec_id").take(picked), pa.array(lists, pa.int64()), pa.array(cells, pa.list_(pa.int64())), pa.array(chunk, pa.int64()), batch.column("v").take(picked)]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "list", "cells", "chunk", "qv"])

    # The queries are a small file, the walk is not: tasks of WALKS queries.
    visits = asked.repartition(-(-n_asked // WALKS) or 1, "vec_id").mapInArrow(walk, f"query_id {kind}, list long, cells array<long>, chunk long, qv array<double>")
    visits = materialize(visits, "visits")
    listed = indexed.withColumn("list", F.floor(F.col("cell") / right_size)).withColumn("cell", F.col("cell") % right_size)
    blocks = listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n"))
    wanted = visits.select("list", "chunk").distinct().join(blocks, "list")
    stored = listed.join(wanted, "list").select("list", "chunk", F.pmod(F.xxhash64("v"), F.col("n")).alias("block"), "cell", "ids", "v")
    asking = visits.join(blocks, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n").cast("long") - 1))).drop("n")
    asking = materialize(asking, "asking")

    def rank(found: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(found) and len(queries):
            x, ids, cell = np.stack(found["v"].to_numpy()), found["ids"].to_numpy(), found["cell"].to_numpy()
            q_all = np.stack(queries["qv"].to_numpy())
            scores = (x @ q_all.T) / (np.sqrt((x * x).sum(axis=1))[:, None] * np.sqrt((q_all * q_all).sum(axis=1)))
            open_cells = np.zeros(right_size, dtype=bool)
            for c, (q, visited) in enumerate(zip(queries["query_id"], queries["cells"])):
                open_cells[:] = False
                open_cells[visited] = True
                seen = np.flatnonzero(open_cells[cell])
                score = scores[seen, c]
                # Ties with the last one kept stay in.
                rest = max(0, len(score) - k - 1)
                last = np.partition(score, rest)[rest] if len(score) else 0.0
                best = [(-scores[i, c], vec) for i in seen[score >= last] for vec in ids[i] if vec != q]
                out += [(q, vec, -s) for s, vec in heapq.nsmallest(k, best)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["list", "chunk", "block"]
    found = stored.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(rank, f"query_id {kind}, vec_id {kind}, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``v, ids``: each vector once, with its ``keep`` smallest ids.

    Equal vectors meet in two steps, first within 64 groups of ids, so that one very common vector is not
    gathered in one task.
    """
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    smallest = Window.partitionBy("h", "v", "salt").orderBy("id")
    some = rows.distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= keep)
    return some.groupBy("h", "v").agg(F.slice(F.array_sort(F.collect_set("id")), 1, keep).alias("ids")).select("v", "ids")
