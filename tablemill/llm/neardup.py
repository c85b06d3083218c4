"""Near-duplicate documents by MinHash, with odd sketches to choose what is compared in full.

A document is the set of its word shingles. Documents with equal sets form a class; the rest works on one
representative of each class. Of 1024 MinHash samples 128 give 32 band keys, and all are folded into an odd
sketch: sample ``j`` flips one of 4096 bits. The XOR of two sketches counts the samples that
differ, which tells similarities near 1 apart precisely, so only pairs that share a band and whose sketches
are close are compared on their full sets.

A group of thousands of near copies does not become pairs: first every member is compared with one member of
its bands, the one that shares most bands with others (as the original of many copies does). Then the members of
a band that are still outside its main component meet all others of the band in cells of up to ``CELL`` by ``CELL``
members: sketches first, then the texts of those that have a partner there, each shipped once to a cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components
from .text import mix, shingle_sets

BANDS, ROWS, SAMPLES, BITS = 32, 4, 1024, 4096
WORDS64 = BITS // 64
# Most differing bits at which a pair is still compared: over four standard deviations above the mean at a
# similarity of 0.8 (371 bits), as at a similarity of 0.74. A pair of similarity 0.8 shares no band with a chance below 1e-7.
MOST_BITS = 470
# Members of a band on each side of a cell.
CELL = 1024

_RNG = np.random.default_rng(20240501)
_MULTIPLY = (_RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32)


def min_samples(hashes: np.ndarray) -> np.ndarray:
    """The MinHash samples of a non-empty set of 64-bit hashes."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for first in range(0, len(short), 128):
        block = short[first : first + 128, None] * _MULTIPLY
        block += _ADD
        np.minimum(least, block.min(axis=0), out=least)
    return least


def _sketch_batch(column, shingle: int):
    samples, sizes, keys = [], [], []
    for found in shingle_sets(column, shingle):
        sizes.append(len(found))
        if len(found):
            samples.append(min_samples(found))
            keys.append((mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(), mix(found + np.uint64(0x14057B7EF767814F)).sum()))
        else:
            samples.append(np.zeros(SAMPLES, np.uint32))
            keys.append((np.uint64(0), np.uint64(0)))
    samples = np.array(samples, dtype=np.uint32).reshape(-1, SAMPLES).astype(np.uint64)
    numbered = mix(samples + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))
    bands = numbered[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    band_keys = np.zeros(bands.shape[:2], dtype=np.uint64)
    for r in range(ROWS):
        band_keys = mix(band_keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, r])
    bits = (numbered >> np.uint64(20)) % np.uint64(BITS)
    flat = np.arange(len(bits))[:, None] * BITS + bits.astype(np.int64)
    parity = (np.bincount(flat.ravel(), minlength=len(bits) * BITS) & 1).astype(np.uint8)
    odd = np.packbits(parity.reshape(-1, BITS), axis=1).view(np.int64).reshape(-1, WORDS64)
    return sizes, np.array(keys, dtype=np.uint64).reshape(-1, 2).view(np.int64), band_keys.view(np.int64), odd


def odd_sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, n_shingles, k0, k1`` (the set's 128-bit key), ``bands`` and the sketch ``o0``, ``o1`` ...."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["n_shingles", "k0", "k1", "bands", *(f"o{i}" for i in range(WORDS64))]

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                sizes, keys, bands, odd = _sketch_batch(part.column(1), shingle)
                lists = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), bands.ravel())
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), lists]
                columns += [pa.array(np.ascontiguousarray(odd[:, i])) for i in range(WORDS64)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    schema = f"doc_id {kind}, n_shingles long, k0 long, k1 long, bands array<long>, " + ", ".join(f"o{i} long" for i in range(WORDS64))
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def differing_bits(left: str, right: str) -> Column:
    return sum(F.bit_count(F.col(f"{left}.o{i}").bitwiseXOR(F.col(f"{right}.o{i}"))) for i in range(WORDS64))


def _comparable(left: str, right: str, percent: int) -> Column:
    """Sizes that allow the similarity, and sketches that make it likely."""
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (differing_bits(left, right) <= MOST_BITS)


def confirm_links(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int, block: int = 64) -> DataFrame:
    """The ``pairs`` (``a, b``) with ``100 * |A & B| >= percent * |A | B|`` on their full sets.

    The partners ``b`` of a document meet it in blocks of about ``block``. In a sorted block the document's
    set comes first and is the only one held, whatever the number of partners.
    """
    kind = dict(pairs.dtypes)["a"]
    degree = pairs.groupBy(F.col("a").alias("_a")).agg(F.ceil(F.count(F.lit(1)) / block).alias("_n"))
    blocked = pairs.join(degree, F.col("a") == F.col("_a")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("_n")).alias("_block"))
    blocked = materialize(blocked, "pairs")
    wanted = (
        blocked.select(F.col("b").alias("_id"), F.col("a").alias("hub"), "_block", F.lit(1).alias("role"))
        .unionByName(blocked.select(F.col("a").alias("_id"), F.col("a").alias("hub"), "_block", F.lit(0).alias("role")).distinct())
    )
    # The ids wanted grow with the documents, so the plan is the same at every size.
    texts = docs.select("doc_id", "text").join(wanted.hint("merge"), F.col("doc_id") == F.col("_id")).select("hub", "_block", "role", "doc_id", "text")
    spread = texts.repartition("hub", "_block").sortWithinPartitions("hub", "_block", "role", "doc_id")

    def run(batches):
        at, own = None, np.empty(0, np.uint64)
        for batch in batches:
            hubs, blocks, roles, ids = (batch.column(c).to_pylist() for c in ("hub", "_block", "role", "doc_id"))
            out = []
            for hub, part, role, doc_id, found in zip(hubs, blocks, roles, ids, shingle_sets(batch.column("text"), shingle)):
                if role == 0:
                    at, own = (hub, part), found
                elif at == (hub, part):
                    both = len(np.intersect1d(own, found, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(found) - both):
                        out.append((hub, doc_id))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], batch.schema.field("hub").type), pa.array([p[1] for p in out], batch.schema.field("hub").type)], names=["a", "b"])

    return spread.mapInArrow(run, f"a {kind}, b {kind}")


CELL_KEY = ["band", "outer", "inner"]


def _cells(batches):
    """The consecutive rows of each cell, in batches sorted by CELL_KEY, as one table."""
    held: list[pa.Table] = []
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in CELL_KEY], axis=1)
        if not len(keys):
            continue
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if held and (np.array([held[0].column(k)[0].as_py() for k in CELL_KEY]) != keys[0]).any():
            yield pa.concat_tables(held).combine_chunks()
            held = []
        bounds = [0, *cuts.tolist(), len(keys)]
        for first, last in zip(bounds[:-1], bounds[1:]):
            held.append(pa.Table.from_batches([batch.slice(first, last - first)]))
            if last < len(keys):
                yield pa.concat_tables(held).combine_chunks()
                held = []
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _partners(percent: int):
    """Per cell the members outside the main component with their likely partners, and these partners."""
    names = [*CELL_KEY, "role", "rep", "partners"]

    def run(batches):
        for cell in _cells(batches):
            role, size, part, rep = (cell[c].to_numpy() for c in ("role", "n_shingles", "part", "rep"))
            left, right = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
            if not len(left) or not len(right):
                continue
            odd = np.stack([cell[f"o{i}"].to_numpy() for i in range(WORDS64)], axis=1).view(np.uint64)
            bands = cell["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            band, main = cell["band"][0].as_py(), cell["main"].to_numpy()
            found: dict[int, list[int]] = {}
            for x in left:
                y = right
                close = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
                # A pair of two outer members is taken from the smaller one.
                y = y[close & (part[y] != part[x]) & ((part[y] == main[y]) | (rep[x] < rep[y]))]
                y = y[np.bitwise_count(odd[y] ^ odd[x]).sum(axis=1, dtype=np.int64) <= MOST_BITS]
                if len(y):
                    # Pairs that share several bands are taken in the first one.
                    shared = np.where((bands[y][:, :, None] == bands[x]).any(axis=2), bands[y], np.iinfo(np.int64).max).min(axis=1)
                    y = y[shared == band]
                if len(y):
                    found[int(x)] = y.tolist()
            if not found:
                continue
            wanted = sorted({j for many in found.values() for j in many})
            rows = [*found, *wanted]
            taken = cell.take(rows).select([*CELL_KEY, "role", "rep"])
            lists = pa.array([rep[found[x]].tolist() for x in found] + [None] * len(wanted), pa.list_(cell.schema.field("rep").type))
            yield from taken.append_column("partners", lists).select(names).combine_chunks().to_batches()

    return run


def _confirm(shingle: int, percent: int):
    """Per cell, partners first: the links whose full sets reach the similarity."""

    def run(batches):
        at, sets = None, {}
        for batch in batches:
            out = []
            keys = zip(*(batch.column(k).to_pylist() for k in CELL_KEY))
            lists = (batch.column(c).to_pylist() for c in ("role", "rep", "partners"))
            for key, role, rep, partners, found in zip(keys, *lists, shingle_sets(batch.column("text"), shingle)):
                if key != at:
                    at, sets = key, {}
                if role == 0:
                    sets[rep] = found
                    continue
                for other in partners:
                    both = len(np.intersect1d(found, sets[other], assume_unique=True))
                    if both and 100 * both >= percent * (len(found) + len(sets[other]) - both):
                        out.append((min(rep, other), max(rep, other)))
            kind = batch.schema.field("rep").type
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i in (0, 1)], names=["a", "b"])

    return run


def links_across(docs: DataFrame, inside: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``a, b`` between members of a band of which one at least is outside the band's main component.

    ``inside`` has ``band, rep, part, main, n_shingles, bands`` and the sketch. Each cell holds up to about ``CELL``
    outer members and ``CELL`` of all, so that ``g`` members with ``o`` outer ones take ``2 g o / CELL`` rows.
    """
    kind = dict(inside.dtypes)["rep"]
    outer = F.col("part") != F.col("main")
    sizes = inside.groupBy(F.col("band").alias("_band")).agg(
        F.ceil(F.count(F.lit(1)) / CELL).alias("inners"), F.ceil(F.count_if(outer) / CELL).alias("outers")
    )
    dealt = inside.join(sizes, F.col("band") == F.col("_band")).drop("_band")
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    own = lambda n: F.array(F.pmod(F.xxhash64("rep"), F.col(n)))
    sides = dealt.withColumn("side", F.explode(F.array(F.struct(F.lit(0).alias("role"), every("outers").alias("o"), own("inners").alias("i")), F.when(outer, F.struct(F.lit(1).alias("role"), own("outers").alias("o"), every("inners").alias("i"))))))
    sides = sides.where("side IS NOT NULL").withColumns({"role": F.col("side.role"), "outer": F.explode("side.o")})
    sides = sides.withColumn("inner", F.explode("side.i")).drop("side", "outers", "inners")
    cells = sides.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY)
    schema = f"band long, outer long, inner long, role int, rep {kind}, partners array<{kind}>"
    wanted = materialize(cells.mapInArrow(_partners(percent), schema), "partners")
    # The members wanted grow with the documents, so the plan is the same at every size.
    texts = docs.select("doc_id", "text").join(wanted.hint("merge"), F.col("doc_id") == F.col("rep")).drop("doc_id")
    texts = texts.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY, "role", "rep")
    return texts.mapInArrow(_confirm(shingle, percent), f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (``doc_id, text``).

    Linked are documents whose sets reach the similarity ``percent``; a component is all that links reach and
    is named by its smallest id, which is ``kept``. A null or blank text has no shingle and no link; a text
    with fewer than ``shingle`` words is one shingle. Rows with a null id are kept. Rows that repeat an id
    share its component. Other columns are ignored; an empty table gives an empty result. Several jobs run
    at once; sketches, candidate pairs and links are stored in the shared folder.
    """
    sketches = materialize(odd_sketches(docs, shingle), "sketches")
    own = [f"o{i}" for i in range(WORDS64)]
    key = ["n_shingles", "k0", "k1"]
    sets = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), *(F.first(o).alias(o) for o in own)
    )
    sets = materialize(sets, "sets")
    rows = sets.select("rep", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = materialize(rows.join(shared, "band"), "bands")
    weight = rows.groupBy("rep").agg(F.sum("n").alias("weight"))
    rows = materialize(rows.select("rep", "band").join(weight, "rep"), "bands")
    hubs = rows.groupBy("band").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("hub"))

    # One partner for each document: the hub of a band whose sketch is closest.
    small = sets.select("rep", "n_shingles", *own)
    star = rows.join(hubs, "band").where("rep <> hub").select("hub", F.col("rep").alias("member")).distinct()
    near = (
        star.join(small.alias("x"), F.col("hub") == F.col("x.rep"))
        .join(small.alias("y"), F.col("member") == F.col("y.rep"))
        .where(_comparable("x", "y", percent))
        .groupBy("member")
        .agg(F.min_by("hub", F.struct(differing_bits("x", "y"), "hub")).alias("hub"))
    )
    first = materialize(confirm_links(docs, near.select(F.col("hub").alias("a"), F.col("member").alias("b")), shingle, percent), "links")
    parts = materialize(connected_components(first), "parts")

    # Bands whose members are not all in one component yet.
    placed = rows.select("band", "rep").join(parts, F.col("rep") == F.col("node"), "left")
    placed = placed.select("band", "rep", F.coalesce("component", "rep").alias("part"))
    mixed = placed.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n"))
    mixed = mixed.groupBy("band").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    inside = materialize(placed.join(mixed.select("band", "main"), "band").join(sets.select("rep", "n_shingles", "bands", *own), "rep"), "mixed")
    second = materialize(links_across(docs, inside, shingle, percent), "links")
    parts = materialize(connected_components(first.unionByName(second)), "parts")

    named = sets.select(*(F.col(c).alias(f"_{c}") for c in key), "rep").join(parts, F.col("rep") == F.col("node"), "left")
    named = named.select(*(f"_{c}" for c in key), F.coalesce("component", "rep").alias("_component"))
    match = [F.col(c) == F.col(f"_{c}") for c in key]
    joined = sketches.select("doc_id", *key).join(named, match, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of its component. Rows with a null id stay."""
    gone = near_duplicates(docs, shingle, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
