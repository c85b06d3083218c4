"""Conversation repair against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from tablemill.llm import queries as registered
from tablemill.llm.dialogue import damage_conversations, plan_edits, repair_conversations, repair_report, report_conversations

SOLID = re.compile(r"[^\x20\x09-\x0D]")
DUE = {"": "u", "s": "u", "u": "a", "a": "u"}
FOLLOWS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        last = SOLID.findall(text)[-1:]
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, kinds):
    @functools.cache
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        def take(price, letter, rest, said=()):
            found.append((rest[0] + price, letter + rest[1], said + rest[2]))
        if inserts < 3:
            due = DUE[state]
            take(2, "I", best(i, due, inserts + 1), (({"u": "user", "a": "assistant"}[due] + ":"),))
        if i < len(rows):
            _, role, text = rows[i]
            take(3, "D", best(i + 1, state, 0))
            if kinds[i] not in ("blank", "duplicate"):
                cut = kinds[i] == "truncated"
                if (state, role[:1]) in FOLLOWS:
                    take(cut, "K", best(i + 1, role[:1], 0), (f"{role}:{text}",))
                due = DUE[state]
                take(2 + cut, "R", best(i + 1, due, 0), ({"u": "user", "a": "assistant"}[due] + ":" + text,))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "~", ())

    return best(0, "", 0)


def expected(rows):
    kinds = faults(rows)
    cost, audit, said = cheapest(rows, kinds)
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum((a[1][:1], b[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def damaged(turns):
    out = {}
    for conv, turn, role, text in turns:
        rows = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    return {conv: sorted(rows, key=order) for conv, rows in out.items()}


def by_conversation(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_op13_equals_brute_force(spark, sf):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = by_conversation(registered.QUERIES["op13_repair"](spark, sf))
    assert got == {conv: expected(rows) for conv, rows in damaged(turns).items()}


@pytest.fixture(scope="module")
def made():
    """Random conversations with every fault, ties of nothing but turn and role, repeated rows and odd roles."""
    draw = random.Random(7)
    turns = []
    for conv in [None, *range(400)]:
        for turn in range(draw.randrange(1, 9)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown", "User"])
            text = draw.choice([f"t{turn}.", f"t{turn}", "same!", " \t", "", None, "same!  \n", "x?"])
            row = (conv, None if draw.random() < 0.05 and turn == 0 else turn + draw.randrange(2) * (turn > 5), role, text)
            turns += [row] * draw.choice([1, 1, 1, 2, 3])
    seen, alone = {}, []
    for row in turns:  # rows of one conversation, turn and role have one text, as their order is free otherwise
        kept = seen.setdefault((row[0], row[1], " " if row[2] is None else row[2]), row)
        alone.append(kept)
    return alone


def test_random_conversations(spark, made):
    turns = spark.createDataFrame(made, SCHEMA)
    got = by_conversation(repair_report(turns, damage_conversations(turns)))
    assert got == {conv: expected(rows) for conv, rows in damaged(made).items()}


def test_long_conversations_are_split(spark, made):
    """Pieces of eight rows: conversations over several pieces give the same report and the same rows."""
    draw = random.Random(11)
    long = [(1000 + c, t, draw.choice(["user", "assistant", "system"]), draw.choice([f"t{t}.", f"t{t}", "same!", ""])) for c in range(3) for t in range(150)]
    turns = spark.createDataFrame(made + long, SCHEMA)
    whole = by_conversation(report_conversations(turns))
    split = by_conversation(report_conversations(turns, plan_edits(turns, piece_bits=3)))
    assert split == whole
    rows = {}
    for r in repair_conversations(turns, plan_edits(turns, piece_bits=3)).collect():
        rows.setdefault(r["conv_id"], []).append(((r["turn"] is not None, r["turn"] or 0), r["source_role"], r["step"], f"{r['role']}:{r['text']}"))
    for conv, report in whole.items():
        said = "\n".join(r[-1] for r in sorted(rows.get(conv, [])))
        assert hashlib.sha256(said.encode()).hexdigest() == report[-1]


def test_edges(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x" * 300_000 + ".", 5), (1, 1, None, None, 5), (2, None, None, "a.", 5)], SCHEMA + ", edit int").withColumnRenamed("edit", "audit")
    got = by_conversation(report_conversations(turns))
    assert got[1][:7] == (0, 1, 0, 0, 1, 5, "KDI") and got[2][:7] == (0, 0, 0, 0, 0, 3, "D")
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair_report(nothing, damage_conversations(nothing)).count() == 0
    assert repair_conversations(nothing).count() == 0
    gone = by_conversation(repair_report(turns, turns.limit(0)))
    assert set(gone.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
