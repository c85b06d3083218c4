"""Repair of conversations: the cheapest edits that give ``(system)? (user assistant)+``, ties to the least audit.

A conversation is walked row by row through four states: nothing yet, after a system row, after a user row,
after an assistant row. An edit keeps a row (K), gives it the role that is due (R), deletes it (D) or inserts an
empty row of the role that is due (I), so the letters of the edits, the audit, say all.

Costs to the end come from min-plus products of 4 x 4 step matrices, taken over 1, 2, 4, ... rows. The arcs that
lie on cheapest walks are then ranked by the first 1, 2, 4, ... letters of their least audits (prefix doubling),
and the pointers doubled on the way give every step of the least walk at once. All conversations of a piece of
65,536 rows go through numpy together.

A conversation over several pieces, however long, is split: its pieces' matrices give the costs at the borders,
each piece then says where it ends for each state it may begin in, and these maps give the states it does.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.joins import match_rows

from .common import materialize

PIECE_BITS = 16
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
LETTERS = "DIKR"  # in the order of ties
FAR = 1 << 40

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. Initials: 0 other, 1 s, 2 u, 3 a.
DUE = np.array([2, 2, 3, 2])
KEPT = np.full((4, 4), -1)
KEPT[0, 1], KEPT[0, 2], KEPT[1, 2], KEPT[2, 3], KEPT[3, 2] = 1, 2, 2, 3, 2
END = np.array([0, 4, 2, 0])  # cost to close a conversation from each state
CLOSING = ("", "II", "I", "")
ROLE_DUE = {2: "user", 3: "assistant"}
ROW = ["conv_id", "turn", "role", "h0", "h1"]

_INSERTS = np.full((4, 4), FAR)
for _s in range(4):
    _INSERTS[_s, DUE[DUE[_s]]] = 4
    _INSERTS[_s, DUE[_s]] = 2
    _INSERTS[_s, _s] = 0


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def _edit_costs(n: np.ndarray, fault: np.ndarray, initial: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of D, of K from each state and of R, for a row and the deletion of its ``n - 1`` further copies."""
    copies = 3 * (n - 1)
    held = np.where((fault == BLANK) | (fault == DUPLICATE), FAR, (fault == TRUNCATED) + copies)
    keep = np.where(KEPT[:, initial].T >= 0, held[:, None], FAR)
    return 3 + copies, keep, np.minimum(held + 2, FAR)


def step_matrices(n: np.ndarray, fault: np.ndarray, initial: np.ndarray) -> np.ndarray:
    """Least cost from each state before a row (insertions included) to each state after it."""
    drop, keep, rerole = _edit_costs(n, fault, initial)
    steps = np.full((len(n), 4, 4), FAR)
    rows = np.arange(len(n))
    for s in range(4):
        steps[:, s, s] = drop
        steps[:, s, DUE[s]] = np.minimum(steps[:, s, DUE[s]], rerole)
        to = KEPT[s, initial]
        ok = to >= 0
        steps[rows[ok], s, to[ok]] = np.minimum(steps[rows[ok], s, to[ok]], keep[ok, s])
    return _product(_INSERTS[None], steps)


def suffix_products(steps: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Product of the matrices from each row to the end of its segment, over doubling distances."""
    last = np.repeat(bounds[1:], np.diff(bounds))
    total, far = steps, 1
    while far < np.diff(bounds).max(initial=0):
        rows = np.flatnonzero(np.arange(len(steps)) + far < last)
        joined = total.copy()
        joined[rows] = _product(total[rows], total[rows + far])
        total, far = joined, 2 * far
    return total


class Walks:
    """Cheapest walks through all segments of a piece; ``tails`` are the costs after each segment, by state."""

    def __init__(self, n, fault, initial, bounds, tails):
        rows, lengths = len(n), np.diff(bounds)
        self.rows, self.bounds, self.n = rows, bounds, n
        segment = np.repeat(np.arange(len(lengths)), lengths)
        total = suffix_products(step_matrices(n, fault, initial), bounds)
        cost = (total + tails[segment][:, None, :]).min(axis=2)
        ends = bounds[segment + 1] - 1 == np.arange(rows)
        after = np.where(ends[:, None], tails[segment], np.concatenate([cost[1:], cost[:1]]))
        # Node 4 i + s is state s before row i; the four nodes after a segment come behind all rows.
        below = np.where(ends, rows + segment, np.arange(rows) + 1)[:, None] * 4
        drop, keep, rerole = _edit_costs(n, fault, initial)
        states = np.arange(4)
        to = np.maximum(KEPT[:, initial].T, 0)
        price = np.stack(
            [drop[:, None] + after, 2 + cost[:, DUE], keep + np.take_along_axis(after, to, axis=1), rerole[:, None] + after[:, DUE]],
            axis=2,
        )
        heads = np.stack([below + states, np.arange(rows)[:, None] * 4 + DUE, below + to, below + DUE], axis=2)
        self.source, self.letter = np.nonzero((price == cost[:, :, None]).reshape(rows * 4, 4))
        self.head = heads.reshape(rows * 4, 4)[self.source, self.letter]
        self._rank()

    def _rank(self) -> None:
        """Rank the optimal arcs by their least audits; the last arc number stands for the end."""
        arcs = len(self.source)
        rank = np.append(self.letter + 1, 0)
        # Arcs are stored by node and letter, and no two arcs of a node share one: the first goes on the least audit.
        first = np.searchsorted(self.source, np.arange(self.rows * 4 + 1))
        jump = np.append(first[np.minimum(self.head, self.rows * 4)], arcs)
        steps = np.append(np.ones(arcs, np.int64), 0)
        self.jumps = [jump]
        while (jump < arcs).any():
            steps = steps + steps[jump]
            _, rank = np.unique(rank * (arcs + 6) + rank[jump], return_inverse=True)
            jump = jump[jump]
            self.jumps.append(jump)
        self.steps = steps
        self.chosen = np.lexsort((rank[:arcs], self.source))[first[:-1]]  # of each node, by whole audits

    def follow(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Insertions before, letter and state of each row, and each segment's last state, from its first one."""
        start = self.chosen[self.bounds[:-1] * 4 + states]
        lengths = self.steps[start]
        at = np.repeat(start, lengths)
        place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        for k, jump in enumerate(self.jumps):
            moved = (place >> k) & 1 == 1
            at[moved] = jump[at[moved]]
        row, state, letter = self.source[at] // 4, self.source[at] % 4, self.letter[at]
        inserted = np.bincount(row[letter == 1], minlength=self.rows)
        own = letter != 1
        letters, entered, last = np.empty(self.rows, np.int64), np.empty(self.rows, np.int64), np.array(states)
        letters[row[own]] = letter[own]
        opening = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
        entered[row[opening]] = state[opening]
        if len(at):
            last = self.head[at[np.cumsum(lengths) - 1]] % 4
        return inserted, letters, entered, last


def _bounds(codes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)]])


def _sorted(table: pa.Table) -> tuple[pa.Table, np.ndarray, list[np.ndarray]]:
    table = table.sort_by("_at").combine_chunks()
    codes = table["conv_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return table, _bounds(codes), [table[c].to_numpy().astype(np.int64) for c in ("n", "fault", "initial")]


def _with_edits(table: pa.Table, walks: Walks, states: np.ndarray, closed: np.ndarray) -> pa.Table:
    inserted, letters, entered, last = walks.follow(states)
    edits = ["I" * i + LETTERS[k] + "D" * (n - 1) for i, k, n in zip(inserted.tolist(), letters.tolist(), walks.n.tolist())]
    for end, state, done in zip(walks.bounds[1:].tolist(), last.tolist(), closed.tolist()):
        if done:
            edits[end - 1] += CLOSING[state]
    kept = [*ROW, "n", "fault", "initial", "_at"]
    return table.select(kept).append_column("edit", pa.array(edits, pa.string())).append_column("entered", pa.array(entered, pa.int32()))


def _solve_whole(table: pa.Table) -> pa.Table:
    table, bounds, (n, fault, initial) = _sorted(table)
    segments = len(bounds) - 1
    walks = Walks(n, fault, initial, bounds, np.tile(END, (segments, 1)))
    return _with_edits(table, walks, np.zeros(segments, np.int64), np.ones(segments, bool))


def _piece_matrix(table: pa.Table) -> pa.Table:
    table, bounds, (n, fault, initial) = _sorted(table)
    matrix = suffix_products(step_matrices(n, fault, initial), bounds)[0]
    return table.slice(0, 1).select(["conv_id", "piece"]).append_column("matrix", pa.array([matrix.ravel().tolist()], pa.list_(pa.int64())))


def _border_costs(table: pa.Table) -> pa.Table:
    table = table.sort_by("piece")
    tails, tail = [], END
    for matrix in reversed(table["matrix"].to_pylist()):
        tails.append(tail.tolist())
        tail = (np.array(matrix).reshape(4, 4) + tail).min(axis=1)
    closed = [i == 0 for i in range(len(tails))][::-1]
    return table.select(["conv_id", "piece"]).append_column("tail", pa.array(tails[::-1], pa.list_(pa.int64()))).append_column("closed", pa.array(closed))


def _piece_exits(table: pa.Table) -> pa.Table:
    table, bounds, (n, fault, initial) = _sorted(table)
    walks = Walks(n, fault, initial, bounds, np.array([table["tail"][0].as_py()]))
    exits = [int(walks.follow(np.array([s]))[3][0]) for s in range(4)]
    return table.slice(0, 1).select(["conv_id", "piece", "tail", "closed"]).append_column("exits", pa.array([exits], pa.list_(pa.int64())))


def _piece_entries(table: pa.Table) -> pa.Table:
    table = table.sort_by("piece")
    states, state = [], 0
    for exits in table["exits"].to_pylist():
        states.append(state)
        state = exits[state]
    return table.select(["conv_id", "piece", "tail", "closed"]).append_column("state", pa.array(states, pa.int64()))


def _solve_piece(table: pa.Table) -> pa.Table:
    table, bounds, (n, fault, initial) = _sorted(table)
    walks = Walks(n, fault, initial, bounds, np.array([table["tail"][0].as_py()]))
    return _with_edits(table, walks, np.array([table["state"][0].as_py()]), np.array([table["closed"][0].as_py()]))


def _read_rows(turns: DataFrame) -> DataFrame:
    """The turns with a key for their text; a null role or text counts as one space."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.withColumns({"h0": F.xxhash64("text"), "h1": F.xxhash64(F.lit(1), "text")})


def _faults(rows: DataFrame) -> DataFrame:
    """One row for equal rows: their number ``n``, the first one's ``fault`` and the role's ``initial``."""
    last = F.right(F.rtrim("text", F.lit("\x20\x09\x0a\x0b\x0c\x0d")), F.lit(1))
    marked = rows.select(*ROW, F.when(last == "", BLANK).when(last.isin(".", "!", "?"), NONE).otherwise(TRUNCATED).alias("own"))
    rows = marked.groupBy(*ROW).agg(F.count(F.lit(1)).alias("n"), F.first("own").alias("own"))
    said = rows.where(F.col("own") != BLANK).groupBy("conv_id", "role", "h0", "h1").agg(
        F.count(F.lit(1)).alias("times"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unnumbered")
    )
    said = said.where("times > 1").select(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "h0", "h1")), "least", "unnumbered")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "role", "h0", "h1")]
    joined = rows.join(said, same, "left")
    seen = F.coalesce((F.col("turn") > F.col("least")) | (F.col("unnumbered") & F.col("turn").isNotNull()), F.lit(False))
    fault = F.when(F.col("own") == BLANK, BLANK).when(seen, DUPLICATE).otherwise(F.col("own"))
    initial = F.left("role", F.lit(1))
    code = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    return joined.select(*ROW, "n", fault.cast("int").alias("fault"), code.cast("int").alias("initial"))


def plan_edits(turns: DataFrame, piece_bits: int = PIECE_BITS) -> DataFrame:
    """The cheapest edits of each conversation of ``turns`` (``conv_id, turn, role, text``).

    One row for the rows that agree in every column: ``conv_id, turn, role, h0, h1`` (a 128-bit key of the text),
    their number ``n``, ``fault`` (0 none, 1 blank, 2 duplicate, 3 truncated; further copies are blank or
    duplicate), ``initial``, the place ``_at``, the letters ``edit`` and the state ``entered`` before the row.

    Rows go by turn, nulls first, then role, then key. A null role or text counts as one space, null ids are one
    conversation; other columns are ignored; a text is read whole, whatever its length; an empty table gives an
    empty result. Jobs run at once; the ordered rows are stored in the shared folder.
    """
    types = dict(turns.dtypes)
    ordered = _faults(_read_rows(turns)).repartitionByRange(*ROW).sortWithinPartitions(*ROW)
    ordered = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "turns")
    placed = ordered.withColumn("piece", F.shiftright("_at", piece_bits))
    edges = placed.groupBy("piece").agg(F.min_by("conv_id", "_at").alias("first"), F.max_by("conv_id", "_at").alias("last"))
    edges = edges.select("piece", F.explode(F.array("first", "last")).alias("conv_id")).distinct()
    wide = materialize(edges.groupBy("conv_id").agg(F.count(F.lit(1)).alias("pieces")).where("pieces > 1").select("conv_id"), "wide")
    row = f"conv_id {types['conv_id']}, turn {types['turn']}, role string, h0 long, h1 long, n long, fault int, initial int, _at long, edit string, entered int"
    whole = match_rows(placed, wide, ["conv_id"], "left_anti").groupBy("piece").applyInArrow(_solve_whole, row)
    if wide.isEmpty():
        return whole
    key = f"conv_id {types['conv_id']}, piece long"
    parts = match_rows(placed, wide, ["conv_id"], "left_semi")

    def beside(found: DataFrame) -> DataFrame:
        found = materialize(found, "pieces").withColumnsRenamed({"conv_id": "_conv", "piece": "_piece"})
        on = (F.col("piece") == F.col("_piece")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
        return parts.join(found, on).drop("_conv", "_piece").groupBy("conv_id", "piece")

    matrices = materialize(parts.groupBy("conv_id", "piece").applyInArrow(_piece_matrix, f"{key}, matrix array<long>"), "matrices")
    borders = matrices.groupBy("conv_id").applyInArrow(_border_costs, f"{key}, tail array<long>, closed boolean")
    exits = materialize(beside(borders).applyInArrow(_piece_exits, f"{key}, tail array<long>, closed boolean, exits array<long>"), "exits")
    entries = exits.groupBy("conv_id").applyInArrow(_piece_entries, f"{key}, tail array<long>, closed boolean, state long")
    return whole.unionByName(beside(entries).applyInArrow(_solve_piece, row))


def _beside_texts(turns: DataFrame, edits: DataFrame, together: bool) -> DataFrame:
    """Each planned row followed by its texts; ``together`` puts a whole conversation into one partition."""
    plans = edits.select(*ROW, F.lit(0).alias("tag"), "n", "fault", "initial", "edit", "entered", F.lit(None).cast("string").alias("text"))
    nothing = {c: F.lit(None).cast(t) for c, t in (("n", "long"), ("fault", "int"), ("initial", "int"), ("edit", "string"), ("entered", "int"))}
    texts = _read_rows(turns).withColumns({"tag": F.lit(1), **nothing})
    both = plans.unionByName(texts)
    both = both.repartition("conv_id") if together else both.repartitionByRange(*ROW)
    return both.sortWithinPartitions(*ROW, "tag")


def _repaired(plan: tuple, text: str):
    """``role, text, letter`` of the rows that the edit of one planned row gives."""
    edit, state, role = plan
    for letter in edit:
        if letter == "I":
            state = int(DUE[state])
            yield ROLE_DUE[state], "", letter
        elif letter == "R":
            state = int(DUE[state])
            yield ROLE_DUE[state], text, letter
        elif letter == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            yield role, text, letter


def repair_conversations(turns: DataFrame, edits: DataFrame | None = None) -> DataFrame:
    """The repaired rows ``conv_id, turn, step, role, text, edit`` of ``turns``.

    Within a turn ``step`` counts from 0 along the repaired conversation: rows of one ``conv_id`` go by ``turn``
    (nulls first), ``role`` of the source row and ``step``; ``edit`` is K, R or I, deleted rows are left out.
    A conversation of any length is spread over tasks. ``edits`` is a stored ``plan_edits(turns)``.
    """
    types = dict(turns.dtypes)
    edits = materialize(plan_edits(turns), "edits") if edits is None else edits

    def run(batches):
        plan = None
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if r["tag"] == 0:
                    plan = (r["edit"], r["entered"], r["role"])
                elif plan is not None:
                    done = enumerate(_repaired(plan, r["text"]))
                    out += [(r["conv_id"], r["turn"], r["role"], i, *found) for i, found in done]
                    plan = None  # further copies are deleted
            names = ["conv_id", "turn", "source_role", "step", "role", "text", "edit"]
            kinds = [batch.schema.field("conv_id").type, batch.schema.field("turn").type, pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=names)

    schema = f"conv_id {types['conv_id']}, turn {types['turn']}, source_role string, step int, role string, text string, edit string"
    return _beside_texts(turns, edits, together=False).mapInArrow(run, schema)


def report_conversations(turns: DataFrame, edits: DataFrame | None = None) -> DataFrame:
    """Per conversation ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``gaps`` counts the turns missing between the first and the last, ``illegal`` the neighbours whose role
    initials are not su, ua or au. A checksum reads its text in order, so each conversation is one task's
    work, streamed row by row: memory holds its audit only.
    """
    types = dict(turns.dtypes)
    edits = materialize(plan_edits(turns), "edits") if edits is None else edits
    legal = {(1, 2), (2, 3), (3, 2)}
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches):
        nobody = object()
        conv, plan = nobody, None

        def close():
            span = seen["high"] - seen["low"] + 1 - seen["turns"] if seen["turns"] else 0
            return (conv, span, *(seen[c] for c in counts[1:]), "".join(audit), digest.hexdigest())

        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if r["tag"] == 0:
                    if conv is nobody or r["conv_id"] != conv:
                        if conv is not nobody:
                            out.append(close())
                        conv, audit, digest, written = r["conv_id"], [], hashlib.sha256(), False
                        seen = dict.fromkeys([*counts, "low", "high", "turns"], 0)
                        last_turn = last_initial = None
                    n, fault, initial, turn = r["n"], r["fault"], r["initial"], r["turn"]
                    plan = (r["edit"], r["entered"], r["role"])
                    audit.append(r["edit"])
                    seen["blank"] += n if fault == BLANK else 0
                    seen["duplicate"] += n if fault == DUPLICATE else (n - 1) * (fault != BLANK)
                    seen["truncated"] += fault == TRUNCATED
                    seen["illegal"] += n - 1 + (last_initial is not None and (last_initial, initial) not in legal)
                    held = any(c in "KR" for c in r["edit"])
                    prices = {"I": 2, "D": 3, "R": 2}
                    seen["cost"] += sum(prices[c] * r["edit"].count(c) for c in prices) + (held and fault == TRUNCATED)
                    last_initial = initial
                    if turn is not None and turn != last_turn:
                        seen["low"] = turn if not seen["turns"] else seen["low"]
                        seen["high"], last_turn = turn, turn
                        seen["turns"] += 1
                elif plan is not None:
                    for role, text, _ in _repaired(plan, r["text"]):
                        digest.update(("\n" * written + f"{role}:{text}").encode())
                        written = True
                    plan = None
            yield _report(out, batch.schema)
        if conv is not nobody:
            yield _report([close()], batch.schema)

    def _report(out, schema):
        kinds = [schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = ["conv_id", *counts, "audit", "repaired_sha256"]
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=names)

    schema = f"conv_id {types['conv_id']}, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string"
    return _beside_texts(turns, edits, together=True).mapInArrow(run, schema)


def damage_conversations(turns: DataFrame) -> DataFrame:
    """``turns`` with faults planted by the checksum of ``conv_id:turn``, for trials of the repair."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    changed = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).when(kind == 0, 0).otherwise(1).alias("_times"),
    )
    return changed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times", "_copy")


def repair_report(turns: DataFrame, damaged: DataFrame) -> DataFrame:
    """The report of ``damaged`` for every ``conv_id`` of ``turns``; one without rows left has zeros and no text."""
    found = report_conversations(damaged).withColumnRenamed("conv_id", "_conv")
    ids = turns.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id",
        *(zero[c].alias(c) for c in zero),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
