"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A piece of length ``l`` belongs to class ``k`` when ``capacity / (k + 1) < l <= capacity / k``; a bin of class
``k`` holds exactly ``k`` pieces. As documents may be cut freely, a document is cut into full sequences and
then into the longest piece ``capacity // k`` that fits, again and again, so that bins close nearly full; what
is shorter than ``least_cut`` stays whole. Workers fill bins independently. Pieces that do not fill a bin of
their worker meet those of neighbouring workers, ``FAN`` of them in a group, then the groups meet in the same way,
so that no group grows with the input; the few pieces left after the last round are packed first fit.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .tokens import ByteBpe

PIECE = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, cls int, sequence_id long, offset long, worker long"
# Workers, or groups of them, whose left-over pieces of a class meet in one group: fewer than FAN * class pieces.
FAN = 32
# Sequence numbers of a round start at its multiple; the first six are enough for FAN**6 workers.
ROUND, LAST_ROUND = 1 << 60, 7


def cut_lengths(n: int, capacity: int, least_cut: int) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document of ``n`` tokens, in order."""
    out = [(1, capacity)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = -(-capacity // rest)
        if rest <= least_cut or (capacity // rest) * rest >= capacity - capacity // 64:
            out.append((capacity // rest, rest))
            break
        out.append((k, capacity // k))
        rest -= capacity // k
    return out


def _tokenised(path: str, capacity: int, least_cut: int, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        encode = ByteBpe(path)
        worker = TaskContext.get().partitionId()
        made, waiting = 0, {}
        columns = [[] for _ in range(9)]

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(columns[5], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[6:])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "cls", "sequence_id", "offset", "worker"],
            )
            for c in columns:
                c.clear()
            return out

        def put(piece, sequence, offset):
            for c, v in zip(columns, (*piece, sequence, offset, worker)):
                c.append(v)

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            texts = batch.column("text")
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = encode(text.as_py() or "") + end_id.to_bytes(4, "little")
                n, start = len(ids) // 4, 0
                for cls, length in cut_lengths(n, capacity, least_cut):
                    piece = (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, cls)
                    start += length
                    group = waiting.setdefault(cls, [])
                    group.append(piece)
                    if len(group) == cls:
                        at = 0
                        for p in group:
                            put(p, (worker << 32) + made, at)
                            at += p[2]
                        made += 1
                        group.clear()
                if len(columns[0]) >= 50_000:
                    yield flush()
        for group in waiting.values():
            for p in group:
                put(p, None, None)
        yield flush()

    return run


def _close_bins(pieces: DataFrame, round_no: int) -> DataFrame:
    """Fills bins of ``cls`` pieces within each group ``worker``; pieces left over keep a null sequence."""
    keys = ["cls", "worker"]
    along = Window.partitionBy(*keys).orderBy("doc_id", "start", "length", "ids_crc32")
    numbered = pieces.withColumn("_n", F.row_number().over(along) - 1).withColumn(
        "_total", F.count(F.lit(1)).over(Window.partitionBy(*keys))
    )
    numbered = numbered.withColumn("_bin", F.floor(F.col("_n") / F.col("cls")))
    closed = (F.col("_bin") + 1) * F.col("cls") <= F.col("_total")
    inside = Window.partitionBy(*keys, "_bin").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    # Round, group, class and bin make the number of the sequence.
    number = F.lit(ROUND * round_no) + F.col("worker") * F.lit(1 << 40) + F.col("cls").cast("long") * F.lit(1 << 28) + F.col("_bin")
    return numbered.withColumns({
        "offset": F.when(closed, F.coalesce(F.sum("length").over(inside), F.lit(0))),
        "sequence_id": F.when(closed, number),
    }).drop("_n", "_total", "_bin")


def _pack_rest(capacity: int):
    """First fit decreasing; fewer than ``k`` pieces of each class ``k`` are left, so the group is bounded."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        free = np.empty(0, dtype=np.int64)
        sequence, offset = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
        for i, length in enumerate(pdf["length"].to_numpy()):
            fits = np.flatnonzero(free >= length)
            if not len(fits):
                free = np.append(free, capacity)
                fits = [len(free) - 1]
            sequence[i], offset[i] = ROUND * LAST_ROUND + fits[0], capacity - free[fits[0]]
            free[fits[0]] -= length
        pdf["sequence_id"], pdf["offset"] = sequence, offset
        return pdf

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, least_cut: int = 32, end_id: int = 1) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of all of ``docs``.

    A document is the ids of its text and then ``end_id``; a null or empty text is ``end_id`` alone. Every id
    lies in exactly one piece; offsets of a sequence run from 0 without gaps. Repeated rows are packed each
    on their own, other columns are ignored, an empty table gives an empty result. Texts are read and
    tokenised once; the pieces, a few numbers each, are stored before the left-over ones are regrouped.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = PIECE.format(kind=kind)
    run = _tokenised(tokenizer_path, capacity, least_cut, end_id)
    pieces = materialize(docs.select("doc_id", "text").mapInArrow(run, schema), "pieces")
    packed = pieces.where("sequence_id IS NOT NULL")
    rest = pieces.where("sequence_id IS NULL")
    last_worker = rest.agg(F.max("worker")).first()[0] or 0
    for round_no in range(1, LAST_ROUND):
        grouped = rest.withColumn("worker", F.floor(F.col("worker") / FAN))
        met = materialize(_close_bins(grouped, round_no), "met")
        packed = packed.unionByName(met.where("sequence_id IS NOT NULL"))
        rest = met.where("sequence_id IS NULL")
        last_worker //= FAN
        if not last_worker:
            break
    # One group is left, with fewer pieces of each class than fill a bin.
    last = rest.groupBy().applyInPandas(_pack_rest(capacity), schema)
    return packed.unionByName(last).drop("cls", "worker")
