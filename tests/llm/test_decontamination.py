"""Winnowing against every window compared with every other, and on edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import decontamination
from weftline.llm._words import Words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = split(text)
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_row", "h", "left", "we`ird")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("window", "n", "doc_id")})
    out = decontamination.contamination(d, i)
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_random_texts_of_few_words(spark):
    rng = random.Random(3)
    text = lambda n, v: " ".join(rng.choice("abcdefgh"[:v]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 8, 9, 10, 11, 14, 30]), 4 if i % 3 else 8)) for i in range(24)]
    items += [(100, items[5][1]), (101, text(40, 2)), (102, "x y z"), (102, "other words " * 8)]
    docs = [(i, text(rng.randrange(0, 60), 3)) for i in range(150)]
    docs += [(200 + i, f"{text(5, 8)} {t.upper()}! {text(5, 8)} {t}") for i, (_, t) in enumerate(items)]
    assert got(spark, docs, items) == plain(docs, items)


def test_spans_of_one_word_less_are_no_hit(spark):
    item = " ".join(f"w{i}" for i in range(40))
    words = item.split()
    docs = [(i, "q " * 7 + " ".join(words[i : i + 9]) + " q" * 9) for i in range(31)] + [(100 + i, "q " * 3 + " ".join(words[i : i + 10]) + " q") for i in range(31)]
    result = got(spark, docs, [(1, item)])
    assert result == plain(docs, [(1, item)])
    assert [r[2] for r in result if r[0] < 100] == [0] * 31 and [r[2] for r in result if r[0] >= 100] == [10] * 31


def test_edges(spark):
    passage = "Été 12 ünd zehn mehr wörter als \U0001f600 nötig sind hier wirklich alle"
    items = [(1, passage), (None, "one two three four five six seven eight nine ten"), (2, None), (3, ""), (4, " .,! "), (5, "lone"), (6, passage)]
    docs = [(1, None), (2, ""), (3, " \n"), (4, passage.upper().replace("É", "é")), (5, "lone-lone"), (5, "lone-lone"), (None, passage), (7, "one two three four five six seven eight nine ten"), (8, "w " * 50_000 + passage), (9, "lonely")]
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, []) == plain(docs, [])
    assert got(spark, [], items) == []


def test_documents_without_text_beside_a_hot_passage(spark):
    passage = " ".join(f"hot{i}" for i in range(30))
    docs = [(i, f"own{i} {passage if i % 3 else 'cold'} tail{i}") for i in range(3000)]
    result = got(spark, docs, [(i, passage) for i in range(5)] + [(9, "cold tail6")])
    assert result == plain(docs, [(i, passage) for i in range(5)] + [(9, "cold tail6")])


def test_the_last_least_gram_is_kept():
    left = np.arange(12, 0, -1)
    assert decontamination.winnowed(np.array([5, 1, 1, 7, 9], np.uint64), left, 10, 8).tolist() == [2]
    assert decontamination.winnowed(np.array([5, 1, 1, 7, 9], np.uint64), left - 3, 10, 8).tolist() == []


@pytest.mark.parametrize("text", ["", "a", " A.b é", "\x00a\x7fb", "x" * 9])
def test_words(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    w = Words(raw, np.array([0, len(raw)]))
    assert w.texts().to_pylist() == split(text)
