"""Mixing sources to target weights by Pareto order sampling.

Each document of a source is due a number of copies in proportion to its weight, ``max_copies`` at most,
so that the words due in a source are its target. A document due ``d`` copies gets ``floor(d)`` certain ones. One
more copy goes to documents drawn with inclusion probability ``p = d - floor(d)``: each document gets the key
``odds(U) / odds(p)`` with ``U`` uniform from its id, and the smallest keys are taken until the source's
rest in words is filled (the sample size is fixed in words). By default a document weighs the logarithm of
its size, so inclusion odds differ within a source and longer documents are more often repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, word_count

# Grid that finds the cutting point of a source in two passes before keys are sorted.
CELLS = 4096

def _id() -> Column:
    """The id, with null as the smallest."""
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63)))


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_copies: int = 3) -> DataFrame:
    """Targets per source from ``source, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes; no
    target exceeds ``max_copies`` times its source, the excess is shared again by weight. The windows run
    over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_n") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("_n", F.row_number().over(order) - 1).withColumn("_w", weight)
    ranked = ranked.withColumn("_cap", F.lit(max_copies) * F.col("source_size")).withColumn("_fill", F.col("_cap") / F.col("_w"))
    everything = Window.partitionBy()
    before = Window.orderBy("_fill", "_n").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    levelled = ranked.withColumn("_level", level)
    # The first source, by cap over weight, that the level leaves below its cap sets the level of all others.
    chosen = F.min(F.when(F.col("_level") <= F.col("_fill"), F.struct("_fill", "_n", "_level"))).over(everything)
    levelled = levelled.withColumn("_level", chosen["_level"])
    target = F.when(F.col("_level").isNull(), F.col("_cap").cast("double")).otherwise(
        F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w"))
    )
    return levelled.select("source", "source_size", target.alias("target"))


def _uniform(seed: int) -> Column:
    return (F.pmod(F.xxhash64(F.lit(seed), _id()), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _classed(weight: Column) -> Column:
    """The weight to the nearest quarter power of two, so that a source has few different ones; 0 if not positive."""
    known = weight.cast("double")
    finite = (known > 0) & (known < float("inf"))
    return F.when(finite, F.pow(F.lit(2.0), F.round(4 * F.log2(F.when(finite, known))) / 4)).otherwise(0.0)


def copies_due(narrow: DataFrame, totals: DataFrame, max_copies: int) -> DataFrame:
    """``narrow`` with its source's totals and ``_due``, the copies each document is due.

    ``_due`` is ``least(max_copies, level * weight)``, with the level of a source at which its words due are its target.
    The windows run over the weight classes of a source: heavier ones are at the cap first, and
    the level is that of the heaviest class which stays below it. Sums start from whole numbers per class in a fixed
    order, so reruns agree.
    """
    classes = narrow.where("_weight > 0").groupBy("source", "_weight").agg(F.sum("size").alias("_words"))
    classes = classes.join(totals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    lighter = Window.partitionBy("source").orderBy("_weight")
    heavier = Window.partitionBy("source").orderBy(F.desc("_weight")).rowsBetween(Window.unboundedPreceding, -1)
    open_words = F.sum(F.col("_words") * F.col("_weight")).over(lighter.rowsBetween(Window.unboundedPreceding, 0))
    closed = F.coalesce(F.sum("_words").over(heavier), F.lit(0)) * max_copies
    tried = classes.withColumn("_level", F.when(open_words > 0, (F.col("target") - closed) / open_words))
    held = F.col("_level") * F.col("_weight") <= max_copies
    levels = tried.groupBy(F.col("source").alias("_s")).agg(F.max_by("_level", F.when(held, F.col("_weight"))).alias("_level"))
    named = totals.join(levels, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumnRenamed("source", "_s")
    # One stored row a source: its size is known, so the planner need not shuffle documents by source.
    named = materialize(named, "levels")
    state = narrow.join(named, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    # Without a level even the lightest class is at the cap.
    due = F.least(F.lit(float(max_copies)), F.coalesce(F.col("_level") * F.col("_weight"), F.lit(float(max_copies))))
    return state.withColumn("_due", F.when((F.col("source_size") > 0) & (F.col("_weight") > 0), due).otherwise(0.0)).drop("_level")


def mix_sources(
    docs: DataFrame,
    weights=(1, 2, 3),
    max_copies: int = 3,
    weight: Column | None = None,
    seed: int = 20,
) -> DataFrame:
    """Copies per document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``docs`` has ``doc_id, source, text``; other columns are ignored. Size is the number of words, null text
    counts as empty, a null source is a source of its own, a null id sorts first. Rows that agree in id and
    source are taken or left together. Documents without words follow their key like any other. An empty
    table gives an empty result; a text of any length is one row of its size. ``weight`` is an expression over ``docs``,
    used to the nearest quarter power of two; ``F.lit(1.0)`` gives the documents of a source equal odds, without it a
    document weighs ``log2(size + 2)``. Documents with a null weight, or one that is not positive and finite, get no copy;
    a source whose other documents cannot fill its target stays below it.
    Runs one job that stores ids and sizes; texts are read once.
    """
    given = [_classed(weight).alias("_weight")] if weight is not None else []
    sized = docs.select("doc_id", "source", word_count("text").alias("size"), *given)
    if weight is None:
        sized = sized.withColumn("_weight", _classed(F.log2(F.col("size") + 2)))
    narrow = materialize(sized, "sizes")
    totals = source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_copies)
    due = copies_due(narrow, totals, max_copies)
    whole = F.floor("_due")
    p = F.col("_due") - whole
    u = _uniform(seed)
    key = F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))
    keyed = due.withColumns({"_whole": whole, "_key": key, "_place": key / (1 + key), "_id": _id()})
    grid = (F.col("_place") * (CELLS * CELLS)).cast("long")
    keyed = keyed.withColumns({"_cell": F.least(F.lit(CELLS * CELLS - 1), grid)}).withColumn("_coarse", F.floor(F.col("_cell") / CELLS))

    rest = keyed.groupBy(F.col("source").alias("_s")).agg(
        (F.first("target") - F.sum(F.col("size") * F.col("_whole"))).alias("_rest")
    )
    drawn = keyed.where(F.col("_key").isNotNull()).select("source", "size", "_key", "_id", "_cell", "_coarse")

    def cut(cells: DataFrame, rest: DataFrame, by: list[str]) -> DataFrame:
        """The row of each source, in the order ``by``, in which the words reach the rest."""
        along = Window.partitionBy("source").orderBy(*by)
        found = (
            cells.join(rest, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("_upto", F.sum("_words").over(along))
            .where(F.col("_upto") >= F.col("_rest"))
        )
        first = F.min_by(F.struct(*by, "_upto", "_words", "_rest"), F.struct(*by))
        return found.groupBy(F.col("source").alias("_s")).agg(first.alias("_at")).select("_s", "_at.*")

    def within(rows: DataFrame, at: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        inside = rows.join(
            at.select("_s", F.col(column).alias("_hit")),
            F.col("source").eqNullSafe(F.col("_s")) & (F.col(column) == F.col("_hit")),
        ).drop("_s", "_hit")
        return inside, at.select("_s", (F.col("_rest") - (F.col("_upto") - F.col("_words"))).alias("_rest"))

    words = F.sum("size").alias("_words")
    coarse = cut(drawn.groupBy("source", "_coarse").agg(words), rest, ["_coarse"])
    inside, left = within(drawn, coarse, "_coarse")
    fine = cut(inside.groupBy("source", "_cell").agg(words), left, ["_cell"])
    inside, left = within(drawn, fine, "_cell")
    last = cut(inside.groupBy("source", "_key", "_id").agg(words), left, ["_key", "_id"])
    # The document in which the rest is reached counts when that comes nearer to the rest.
    last = last.select(
        "_s",
        F.col("_key").alias("_last_key"),
        F.col("_id").alias("_last_id"),
        (F.col("_upto") - F.col("_rest") <= F.col("_rest") - (F.col("_upto") - F.col("_words"))).alias("_in"),
    )
    result = keyed.join(materialize(last, "cuts"), F.col("source").eqNullSafe(F.col("_s")), "left")
    before = (F.col("_key") < F.col("_last_key")) | ((F.col("_key") == F.col("_last_key")) & (F.col("_id") < F.col("_last_id")))
    at = (F.col("_key") == F.col("_last_key")) & (F.col("_id") == F.col("_last_id")) & F.col("_in")
    # A source whose words never reach the rest (rounding) gives all it has.
    extra = F.when(F.col("_key").isNull(), 0).when(F.col("_last_key").isNull() | before | at, 1).otherwise(0)
    copies = (F.col("_whole") + extra).cast("long")
    return result.select(
        "doc_id", "source", "size", F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"),
        "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; documents without a copy go.

    Row copies that agree in id and source stay together, as in ``mix_sources``. An empty table gives an empty one;
    columns may have any name.
    """
    taken = [c.lower() for c in docs.columns]
    mark = "_copies"
    while mark in taken:
        mark += "_"
    copies = mix_sources(docs, **options).groupBy("doc_id", "source").agg(F.max("copies").alias("n"))
    copies = copies.where("n > 0").select(F.struct(F.col("doc_id").alias("id"), "source", "n").alias(mark))
    joined = docs.join(
        copies,
        docs["doc_id"].eqNullSafe(copies[mark]["id"]) & docs["source"].eqNullSafe(copies[mark]["source"]),
    )
    # Exploding in a select of its own leaves every column of the documents as it is.
    names = [F.col(f"`{c}`") for c in docs.columns]
    repeated = joined.select(*names, F.explode(F.sequence(F.lit(1), F.col(f"{mark}.n").cast("int"))).alias(mark))
    return repeated.select(*names)
