"""Importance resampling against plain counting and sorting, and on edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(docs, target):
    s, t = [0] * 10000, [0] * 10000
    for texts, into in ((docs, s), (target, t)):
        for _, text in texts:
            for b in buckets(text)[1]:
                into[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10000) / ((x + 1) * (sum(t) + 10000)))) for x, y in zip(s, t, strict=True)]
    rows = []
    for doc, text in docs:
        n, found = buckets(text)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([n, doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    rank = {id(r): i + 1 for i, r in enumerate(able[: 5 * len(able) // 100])}
    return sorted(((*r[1:], rank.get(id(r))) for r in rows), key=str)


def got(spark, docs, target, parts=3):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_row", "score", "rank", "n", "we`ird")}).repartition(parts)
    out = importance.resample(d, spark.createDataFrame(target, "item_id long, text string"))
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_whole_results(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdéß9") for _ in range(rng.choice([1, 2, 3, 9, 80])))
    vocabulary = [word() for _ in range(200)]
    docs = [(rng.choice([i, -i]), rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))).title()) for i in range(600)]
    target = [(i, " ".join(rng.choice(vocabulary[:30]) for _ in range(40))) for i in range(20)]
    want = plain(docs, target)
    assert sum(r[4] is not None for r in want) > 20
    assert got(spark, docs, target) == want
    assert got(spark, docs, target, 1) == want


def test_given_tables(spark):
    d = "/root/testdata/sf0.001"
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{d}/{name}.parquet").select(*c).collect()]
    out = importance.op13_importance(spark, d)
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))


def test_ties_and_repeated_rows(spark):
    docs = [(1, "same words over " * 10)] * 150 + [(None, "same words over " * 10)] * 30 + [(2, None), (3, ""), (4, " "), (4, "few words")]
    want = plain(docs, [(1, None)])
    assert sum(r[4] is not None for r in want) == 9
    assert got(spark, docs, [(1, None)]) == want


def test_edges(spark):
    long = "x" * 300_000 + " " + "many words " * 30_000
    docs = [(i, t) for i, t in enumerate([long, None, "", "\n", "é " * 19, "é " * 20])] + [(None, "a b c")]
    assert got(spark, docs, []) == plain(docs, [])
    assert got(spark, [], [(1, "a")]) == []
    assert all(r[4] is None for r in got(spark, docs[:3], [(1, "a")]))


@pytest.mark.parametrize("k", [0, 1, 7, 250, 499, 500])
def test_cut_of_far_keys(spark, k):
    rng = random.Random(k)
    rows = [(rng.choice([-(1 << 63) + 1, -5, 0, 3, 1 << 40, (1 << 63) - 1]), rng.randrange(-(1 << 62), 1 << 62), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    cut = importance.radix_cut(df, [F.col("a"), F.col("b"), F.col("c")], k)
    assert sorted(tuple(r) for r in df.filter(cut).collect()) == sorted(rows)[:k]


def test_gains_round_down():
    assert importance.gains(np.array([9, 0]), np.array([0, 0])).tolist() == [math.floor(1000 * math.log(11 / (10 * 2))), math.floor(1000 * math.log(11 / 2))]
