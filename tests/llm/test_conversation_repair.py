"""Composition against searches over all edits, over segments of any size, and on edge cases."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from functools import cache

import duckdb
import pytest
from pyspark.sql import functions as F

from weftline.llm import conversation_repair as repair

SPACES = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        w = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if w:
            text = "" if w == 1 else "".join(c for c in text if c not in ".!?") if w == 2 else text
            out += [(conv, turn, "user" if w == 4 else role, text)] * (2 if w == 3 else 1)
    return out


def faults(rows):
    seen = set()
    for _, _, role, text in rows:
        inked = text.rstrip(SPACES)
        yield "blank" if not inked else "duplicate" if (role, text) in seen else "" if inked[-1] in ".!?" else "truncated"
        seen.add((role, text))


def options(row, fault, state):
    yield 2, "D", [], state
    if fault not in ("blank", "duplicate"):
        extra = 5 * (fault == "truncated")
        for price, label, role in ((0, "K", row[2]), (1, "R", "user"), (1, "R", "assistant")):
            if (state, role[:1]) in NEXT:
                yield price + extra, label, [f"{role}:{row[3]}"], NEXT[state, role[:1]]


def backward(rows, found):
    """(cost, labels, lines) from the end: least first, as the label goes before what follows."""
    least = {g: (0, "", ()) if g in ("", "a") else None for g in ("", "s", "u", "a")}

    def closed(best):
        for _ in range(3):
            for g in best:
                for r in "ua":
                    to = NEXT.get((g, r))
                    if to is not None and best[to] is not None:
                        c = (best[to][0] + 5, "I" + best[to][1], (f"{NAMES[r]}:", *best[to][2]))
                        best[g] = c if best[g] is None else min(best[g], c)
        return best

    least = closed(least)
    for row, fault in reversed(list(zip(rows, found, strict=True))):
        new = {}
        for g in least:
            c = [(p + least[to][0], label + least[to][1], (*line, *least[to][2])) for p, label, line, to in options(row, fault, g) if least[to] is not None]
            new[g] = min(c) if c else None
        least = closed(new)
    return least[""]


def searched(rows, found):
    """All paths in the order of (cost, labels), until one ends."""
    heap = [(0, "", 0, "", ())]
    while True:
        cost, labels, i, g, lines = heapq.heappop(heap)
        if i == len(rows) and g in ("", "a"):
            return cost, labels, lines
        for r in "ua":
            if (g, r) in NEXT and not labels.endswith("III"):
                heapq.heappush(heap, (cost + 5, labels + "I", i, NEXT[g, r], (*lines, f"{NAMES[r]}:")))
        if i < len(rows):
            for p, label, line, to in options(rows[i], found[i], g):
                heapq.heappush(heap, (cost + p, labels + label, i + 1, to, (*lines, *line)))


def plain(original, rows, solve=backward):
    out = []
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        found = list(faults(mine))
        turns = [r[1] for r in mine if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit, lines = solve(mine, found)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def got(spark, rows, damage=True):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("_c", "_k", "n", "seg", "we`ird")}).repartition(3)
    return sorted((tuple(r) for r in repair.repaired_conversations(df, repair.damaged(df) if damage else df).collect()), key=str)


def some(seed, convs, length):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "So", "well\n", " \t", "", None, "Why? ", "a.b", "Et é"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent", "User"]
    return [(c if c else None, rng.choice([t, t, t + 1, t, None]), rng.choice(roles[: rng.choice([2, 5, 10])]), rng.choice(texts) or rng.choice(texts)) for c in range(convs) for t in range(rng.randrange(1, length))]


def test_small_conversations_against_all_paths(spark):
    rows = [(r[0], i, *r[2:]) for i, r in enumerate(some(1, 120, 7))]
    want = plain(rows, damaged(rows), searched)
    assert want == plain(rows, damaged(rows)) == got(spark, rows)
    assert {"D", "K", "R"} <= set("".join(r[7] for r in want))


@pytest.mark.parametrize("segment", [1, 3, 1024])
def test_segments_of_any_size(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = some(2, 60, 12) + [(500, t, ("user", "assistant")[t % 2], f"{t // 7}.") for t in range(400)]
    assert got(spark, rows) == plain(rows, damaged(rows))


def test_the_given_table_and_its_sql(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = repair.op12_conversation_repair(spark, d)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows, damaged(rows))


def test_sql_of_odd_rows(spark):
    rows = [(r[0], i, *r[2:]) for i, r in enumerate(some(3, 80, 9))] + [(7, None, "user", "x."), (7, None, "user", "x.")]
    c = duckdb.connect()
    c.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    c.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(c.execute(repair.ORACLE).fetchall(), key=str) == plain(rows, damaged(rows)) == got(spark, rows)


def test_edges(spark):
    rows = [(1, None, None, None), (None, 3, "user", "Hi."), (None, 9, "assistant", "Ho."), (2, 0, "user", "")] + [(3, 1, "user", "Same.")] * 40 + [(3, 2, "assistant", "End.")]
    assert got(spark, rows, False) == plain(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    assert got(spark, []) == []


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C."), (1, 3, "tool", "D."), (2, 0, "system", "S.")]
    audits, out = repair.repair(spark.createDataFrame(rows, SCHEMA))
    assert {r["_c"]: (r.cost, r.audit) for r in audits.collect()} == {"=1": (3, "KRRR"), "=2": (2, "D")}
    assert [(r.role, r.text) for r in out.filter("_c = '=1'").orderBy("place").collect()] == [("user", "A."), ("assistant", "B."), ("user", "C."), ("assistant", "D.")]


@cache
def _paths():
    return tuple(((state, w), to) for state in ("", "s", "u", "a") for w, to in repair.insertions(state))


def test_insertions_are_layers():
    assert (("", (10, "II")), "a") in _paths() and (("s", (5, "I")), "u") in _paths() and max(w[0] for (_, w), _ in _paths()) == 10
