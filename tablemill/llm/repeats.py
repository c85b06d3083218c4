"""Removal of repeated byte strings of a minimum length, exact, over all documents.

Every window of 100 bytes has an anchor: of its 24-byte strings the one with the smallest hash (the leftmost
of equals). Equal windows have equal anchors, so windows are compared per anchor only. Consecutive windows
with the same anchor form a run, and a run's context is the bytes of its windows.

1. A run whose context already occurred earlier is removed as a whole; only the first run of each context goes
   on, and only where its anchor has another context.
2. These contexts are joined into a text, its suffixes are sorted, and the common prefixes are derived from the
   Burrows-Wheeler transform by increasing value: intervals of suffixes are extended backwards, breadth first,
   and every interval border found at length ``l`` is a common prefix of ``l``. The search stops at the
   minimum length; borders not found by then are windows that agree.
3. Of the windows that agree, all but the first are removed.

An anchor with more contexts than a task should hold is decided by 128-bit hashes of its single windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.ordering import chunk_borders, in_chunks

from .common import materialize
from .text import _BYTE, _ODD, buffers, mix, slices

ANCHOR = 24
# Contexts of one anchor that are sorted together, and bytes of contexts sorted at a time.
MOST_CONTEXTS, CHUNK = 4096, 1 << 18
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_TABLES: dict[str, np.ndarray] = {}
POSITION = np.uint64((1 << 28) - 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _TABLES or len(_TABLES["up"]) < n:
        size = 1 << max(16, int(n).bit_length())
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            _TABLES[name] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, base))])
    return _TABLES["up"], _TABLES["down"]


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each position."""
    h, base, width, eight = _BYTE[data], _ODD, 1, None
    while width < 16:
        h = h[:-width] * base + h[width:]
        base, width = base * base, 2 * width
        if width == 8:
            eight, base8 = h, base
    # 24 = 16 + 8
    return mix(h[:-8] * base8 + eight[16:])


def runs(data: np.ndarray, offsets: np.ndarray, least: int):
    """(row, first window, last window, anchor, context hash) of all runs of a few documents."""
    n, w = len(data), least - ANCHOR + 1
    if n < least:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    anchors = _anchor_hashes(data)
    key = (anchors & ~POSITION) | np.arange(len(anchors), dtype=np.uint64)
    # Sliding minimum: ends of blocks of w from the left and from the right.
    blocks = -(-len(key) // w)
    padded = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(key)] = key
    table = padded.reshape(blocks, w)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(key) - w + 1
    at = (np.minimum(right[:windows], left[w - 1 : w - 1 + windows]) & POSITION).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:windows] == row[least - 1 : least - 1 + windows]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    at = at[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = starts[new]
    last = starts[np.concatenate([np.flatnonzero(new)[1:], [len(starts)]]) - 1]
    place = at[new]
    up, down = _powers(n + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[:n])])
    context = mix((sums[last + least] - sums[first]) * down[first] + (place - first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    rows = row[first]
    return rows, first - offsets[rows], last - offsets[rows], anchors[place], context


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the first ``depth`` or more bytes from them, by doubling."""
    n = len(text)
    packed = np.zeros(n + 8, np.uint64)
    packed[:n] = text
    key, width = packed[:n].copy(), 1
    for k in range(1, 8):
        key = (key << np.uint64(8)) | packed[k : n + k]
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]])).astype(np.uint64) + np.uint64(1)
        if width >= depth or int(rank.max()) == n:
            return order
        nxt = np.zeros(n, np.uint64)
        nxt[: max(0, n - width)] = rank[width:]
        key = (rank << np.uint64(32)) | nxt
        width *= 2


def agreeing_suffixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and for each place in it whether ``least`` bytes agree with the place before.

    Byte 0 separates contexts: no string that is extended holds it, so places of suffixes that start less
    than ``least`` before a separator mean nothing.
    """
    n = len(text)
    order = suffix_order(text, least)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    to_front = np.empty(n, np.int64)
    to_front[by_symbol] = np.arange(n)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    before = np.full(n, -1, np.int64)
    after = np.full(n, n, np.int64)
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    open_border = np.ones(n + 1, dtype=bool)
    open_border[[0, n]] = False
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        if not len(low):
            break
        sizes = high - low
        which = np.repeat(np.arange(len(low)), sizes)
        place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]
        real = bwt[place] != 0
        first = real & (before[place] < low[which])
        last = real & (after[place] >= high[which])
        # Within an interval the symbols' first and last places have the same order in front.
        f = np.sort(which[first] * (n + 1) + to_front[place[first]])
        e = np.sort(which[last] * (n + 1) + to_front[place[last]])
        low, high = f % (n + 1), e % (n + 1) + 1
        new = open_border[high]
        low, high = low[new], high[new]
        open_border[high] = False
    return order, open_border[:n]


def repeated_windows(contexts: list[bytes], least: int) -> list[np.ndarray]:
    """For each context, given in order, which of its windows occur in an earlier one or earlier in it."""
    text = np.frombuffer(b"".join(map(_safe, contexts)), np.uint16)
    # 16-bit symbols keep byte 0 apart from the separator; ranks need few symbols.
    symbols, text = np.unique(text, return_inverse=True)
    order, agree = agreeing_suffixes(text.astype(np.uint8 if len(symbols) < 256 else np.uint16), least)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(~agree)
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    counts = sizes - least + 1
    window = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begin, counts)
    _, first = np.unique(group[window], return_index=True)
    repeated = np.ones(len(window), dtype=bool)
    repeated[first] = False
    return np.split(repeated, np.cumsum(counts)[:-1])


def _safe(context: bytes) -> bytes:
    """A context as 16-bit symbols above 0, and the separator 0."""
    return np.append(np.frombuffer(context, np.uint8).astype(np.uint16) + 1, np.uint16(0)).tobytes()


def _batch(names, kinds, columns):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


FOUND = ["anchor", "context", "id", "first", "last"]
FOUND_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
FOUND_SCHEMA = "anchor long, context long, id long, first int, last int"


def _all_runs(least: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            data, offsets = buffers(batch.column("text"))
            found = []
            for a, b in slices(offsets):
                part = runs(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], least)
                found.append((ids[a:b][part[0]], *part[1:]))
            if not found:
                continue
            doc, first, last, anchor, context = (np.concatenate(c) for c in zip(*found))
            # Of equal contexts in this batch only the first is compared with others; the rest is repeated.
            order = np.lexsort((first, doc, context, anchor))
            doc, first, last, anchor, context = (c[order] for c in (doc, first, last, anchor, context))
            again = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])]) if len(doc) else np.empty(0, bool)
            twin = np.concatenate([[False], (doc[1:] == doc[:-1]) & (first[1:] == first[:-1])]) & again if len(doc) else again
            keep = ~twin
            anchors = pa.array(anchor[keep].view(np.int64), pa.int64(), mask=again[keep])
            contexts = pa.array(context[keep].view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([anchors, contexts, pa.array(doc[keep], pa.int64()), pa.array(first[keep].astype(np.int32)), pa.array(last[keep].astype(np.int32))], names=FOUND)

    return run


def _first_contexts(batches):
    """Rows by anchor, context, document: later rows of a context are repeated (null anchor), the first ones of
    anchors with several contexts go on. Holds one row over batches."""
    held, held_sent = None, True
    for batch in batches:
        known = batch.column("anchor").is_null().to_numpy(zero_copy_only=False)
        anchor = batch.column("anchor").fill_null(0).to_numpy(zero_copy_only=False)
        context, doc, first, last = (batch.column(c).to_numpy(zero_copy_only=False) for c in FOUND[1:])
        out = [[], [], [], [], []]

        def put(rows, a, c, out=out, doc=doc, first=first, last=last):
            for column, values in zip(out, (a, c, doc[rows], first[rows], last[rows])):
                column.append(values)

        n = len(anchor)
        gone = np.flatnonzero(known)
        rest = np.flatnonzero(~known)
        none = np.full(n, -1)
        put(gone, np.zeros(len(gone), np.int64), none[gone])
        if len(rest):
            a, c = anchor[rest], context[rest]
            same = np.concatenate([[held is not None and a[0] == held[0] and c[0] == held[1]], (a[1:] == a[:-1]) & (c[1:] == c[:-1])])
            # The row that the repeated one repeats; the very same place of a repeated row is not repeated.
            lead = np.maximum.accumulate(np.where(same, -1, np.arange(len(rest))))
            lead_doc = np.where(lead >= 0, doc[rest][lead], held[2] if held else 0)
            lead_first = np.where(lead >= 0, first[rest][lead], held[3] if held else 0)
            later = same & ((doc[rest] != lead_doc) | (first[rest] != lead_first))
            put(rest[later], np.zeros(int(later.sum()), np.int64), none[: int(later.sum())])
            heads = np.flatnonzero(~same)
            if len(heads):
                h = a[heads]
                with_before = np.concatenate([[held is not None and h[0] == held[0]], h[1:] == h[:-1]])
                if with_before[0] and not held_sent:
                    for column, value in zip(out, (held[0], 0, *held[2:])):
                        column.append(np.array([value]))
                with_after = np.concatenate([h[1:] == h[:-1], [False]])
                sent = with_before | with_after
                rows = rest[heads[sent]]
                put(rows, anchor[rows], np.zeros(len(rows), np.int64))
                end = rest[heads[-1]]
                held, held_sent = (anchor[end], context[end], doc[end], first[end], last[end]), bool(sent[-1])
        yield _batch(FOUND, FOUND_KINDS, [np.concatenate(c) if c else [] for c in out])


def _cut_contexts(least: int, many: bool):
    """The bytes of wanted contexts; with ``many`` the hash of each single window instead."""

    def run(batches):
        for batch in batches:
            size, out = 0, []
            for doc, text, wanted in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("wanted")):
                data = text.as_buffer() if text.as_py() is not None else b""
                for w in wanted.as_py():
                    context = bytes(data[w["first"] : w["last"] + least])
                    if many:
                        out += [(int.from_bytes(d[:8], "little", signed=True), d, doc, w["first"] + s, w["first"] + s) for s in range(len(context) - least + 1) for d in (hashlib.md5(context[s : s + least]).digest(),)]
                    else:
                        out.append((w["anchor"], context, doc, w["first"], w["last"]))
                    size += len(context)
                    if size > 1 << 22:
                        yield _contexts(out)
                        size, out = 0, []
            yield _contexts(out)

    def _contexts(out):
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
        return _batch(["anchor", "bytes", "id", "first", "last"], kinds, list(zip(*out)) if out else [[]] * 5)

    return run


def _compare(least: int):
    """Complete anchors, sorted by document, in chunks."""

    def run(batches):
        rows, size, anchors = [], 0, []
        for batch in batches:
            for anchor, context, doc, first in zip(*(batch.column(c).to_pylist() for c in ("anchor", "bytes", "id", "first"))):
                if anchors and anchor != anchors[-1] and size > CHUNK:
                    yield solve(rows)
                    rows, size, anchors = [], 0, []
                anchors.append(anchor)
                rows.append((doc, first, context))
                size += len(context)
        if rows:
            yield solve(rows)

    def solve(rows):
        rows.sort(key=lambda r: r[:2])
        out = []
        for (doc, first, _), repeated in zip(rows, repeated_windows([r[2] for r in rows], least)):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.view(np.int8), [0]])))
            out += [(doc, first + int(a), first + int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]
        return _batch(["id", "first", "last"], [pa.int64(), pa.int32(), pa.int32()], list(zip(*out)) if out else [[]] * 3)

    return run


def _numbered_texts(own: DataFrame) -> DataFrame:
    """``own`` with ``id`` replaced by the number of its (id, text) in order of id and the text's SHA-256."""
    keyed = own.withColumn("_sha", F.sha2("text", 256))
    pairs = materialize(keyed.select(F.col("id").alias("_id"), F.col("_sha").alias("_s")).distinct(), "texts")
    ordered = in_chunks(pairs, ["_id", "_s"], pairs.count(), 1 << 20, "numbered-texts")
    borders = chunk_borders(ordered, []).select(F.col("_chunk").alias("_c"), "_offset")
    numbers = ordered.join(borders, F.col("_chunk") == F.col("_c")).select("_id", "_s", (F.col("_offset") + F.col("_place")).alias("_number"))
    joined = keyed.join(numbers, (F.col("id") == F.col("_id")) & (F.col("_sha") == F.col("_s")))
    return materialize(joined.select("doc_id", F.col("_number").alias("id"), "text"), "texts")


def remove_repeats(docs: DataFrame, least: int = 100) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for each row of ``docs`` (``doc_id, text``).

    Every byte covered by a string of ``least`` bytes that also starts earlier (smaller id, or the same
    document further left) is removed; ``kept`` are the other bytes, joined. Null text counts as empty, a
    null id as the smallest. Texts shorter than ``least`` stay whole. Rows repeated in id and text are one
    document and have equal results; different texts that share an id, null ids among them, are documents of their
    own, ordered by SHA-256 of the text. Other columns are ignored; an empty table gives an empty result; a text
    is read whole, whatever its length. Anchors are shuffled once, texts twice (three times where ids are shared);
    what lies between is stored.
    """
    if least < ANCHOR:
        raise ValueError(f"least must be {ANCHOR} or more")
    own = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = own.groupBy("id").agg(F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
    if not texts.where("low <> high").isEmpty():
        own = _numbered_texts(own)
    found = own.select("id", "text").mapInArrow(_all_runs(least), FOUND_SCHEMA)
    # Runs that are known to be repeated only pass through.
    by_anchor = found.repartition(F.coalesce("anchor", F.xxhash64("id", "first"))).sortWithinPartitions("anchor", "context", "id", "first")
    found = materialize(by_anchor.mapInArrow(_first_contexts, FOUND_SCHEMA), "runs")
    wanted = found.where("context = 0").select("anchor", "id", "first", "last").distinct()
    crowd = wanted.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    wanted = materialize(wanted.join(crowd, "anchor"), "wanted")

    def contexts(rows: DataFrame, many: bool) -> DataFrame:
        lists = rows.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("anchor", "first", "last")).alias("wanted"))
        joined = own.select("id", "text").join(lists.hint("merge"), F.col("id") == F.col("_id")).select("id", F.col("text").cast("binary").alias("text"), "wanted")
        return joined.mapInArrow(_cut_contexts(least, many), "anchor long, bytes binary, id long, first int, last int")

    few = contexts(wanted.where(f"n <= {MOST_CONTEXTS}"), False).distinct().repartition("anchor").sortWithinPartitions("anchor", "id", "first")
    removed = [found.where("context = -1").select("id", "first", "last"), few.mapInArrow(_compare(least), "id long, first int, last int")]
    hot = wanted.where(f"n > {MOST_CONTEXTS}")
    if not hot.isEmpty():
        windows = materialize(contexts(hot, True), "windows")
        earliest = windows.groupBy(F.col("bytes").alias("_w")).agg(F.min(F.struct("id", "first")).alias("_e"))
        later = windows.join(earliest, F.col("bytes") == F.col("_w")).where(F.struct("id", "first") > F.col("_e"))
        removed.append(later.select("id", "first", "last"))
    gone = removed[0]
    for more in removed[1:]:
        gone = gone.unionByName(more)
    gone = gone.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    gone = materialize(gone, "spans")
    joined = own.join(gone.hint("merge"), F.col("id") == F.col("_id"), "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans")):
                mark = np.zeros(len(text) + 1, np.int32)
                if spans.is_valid:
                    a = spans.values.field("first").to_numpy()
                    b = spans.values.field("last").to_numpy() + least
                    np.add.at(mark, np.minimum(a, len(text)), 1)
                    np.add.at(mark, np.minimum(b, len(text)), -1)
                covered = np.cumsum(mark)[:-1] > 0
                kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
                spans_n = int(np.count_nonzero(np.diff(np.concatenate([[0], covered.view(np.int8)])) == 1))
                out.append((len(text), len(text) - len(kept), spans_n, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
