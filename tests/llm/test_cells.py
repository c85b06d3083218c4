"""Bands whose members mostly stay unlinked, in cells of few members, against comparing every pair."""

import random

import pytest

from tablemill.llm import neardup


@pytest.mark.parametrize("cell", [3, 1024])
def test_cells_lose_no_link(spark, monkeypatch, cell):
    monkeypatch.setattr(neardup, "CELL", cell)
    draw = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for at in draw.sample(range(120), draw.choice([3, 6, 9, 12])):
            words[at] = f"x{draw.randrange(40)}"
        rows.append((i * 3 + 1, " ".join(words)))
    rows += [(500, rows[0][1]), (2, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(p) for p in zip(t.split(), t.split()[1:])} for i, t in rows}
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                part[y] = x
    want = {i: root(i) for i in sets}
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, 2, 80).collect()}
    assert got == want and 1 < len(set(want.values())) < len(want)
