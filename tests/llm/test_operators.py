"""Operators against plain versions and on edge cases: nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm import exact_dedup, jaccard, language_id, mixing, packing, pii, quality_classifier, quality_rules, queries, secret_scan, toxicity
from weftline.llm._text import chunks, shingles
from weftline.llm.components import components

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, token string"
ROWS = [
    (1, "one two three four five six", "en", "a", 1, 0, "x"),
    (2, None, None, None, None, 0, None),
    (3, "", "en", "a", 0, 1, "x"),
    (4, " \n\t ", "fr", "b", 0, 1, "x"),
    (5, "one  two\nthree four five six", "en", "b", 1, 1, "x"),
    (5, "one  two\nthree four five six", "en", "b", 1, 1, "x"),
    (6, "été 12 \U0001f600 mail a.b@c.de +1 (555) 123-4567 token = 'abcdefgh'", "fr", None, 1, 1, "x"),
    (7, "word " * 30_000, "en", "c", 1, 1, "x"),
    (None, "one two three", "en", "a", 1, 1, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (7, None, None)], "doc_id long, quality int, toxic int")


def scored(docs, labels):
    return {
        "rules": quality_rules.judge(docs, quality_rules.train(docs, labels)),
        "classifier": quality_classifier.score(docs, quality_classifier.train(docs, labels)),
        "toxicity": toxicity.score(docs, toxicity.train(docs, labels)),
        "language": language_id.identify(docs, language_id.train(docs)),
        "secrets": secret_scan.scan(docs),
        "pii": pii.scan(docs),
        "mixing": mixing.mix_sizes(mixing.sizes(docs)),
        "dedup": exact_dedup.classes(docs),
        "near": jaccard.near_duplicates(docs, 3, 90),
    }


def test_edges_keep_every_row(docs, none, labels):
    for name, out in scored(docs, labels).items():
        assert out.count() == len(ROWS), name
    for name, out in scored(none, labels.limit(0)).items():
        assert out.count() == 0, name


def test_pipeline_stages_on_edges(spark, docs, none, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for start in (docs, none):
        start.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        at = spark.read.parquet(str(tmp_path / "documents.parquet"))
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            at = stage(spark, at, str(tmp_path))
            assert at.columns == start.columns or i == len(corpus_pipeline.STAGES) - 1, name
            at.write.mode("overwrite").parquet(str(tmp_path / name))
            at = spark.read.parquet(str(tmp_path / name))


HELPERS = ["we`ird", "a.b", "_row", "_h", "_h1", "_h2", "_maybe", "_slot", "_bucket", "_bits", "_sha", "_size", "_copies", "_copy", "_lap", "_laps", "_last", "_place", "_source", "_shard", "_shards", "_s", "_i", "_start", "_words", "_text", "_id", "_drop", "_y", "_n", "key", "name", "n", "g", "size", "taken", "target", "score", "kept", "count", "part"]


def test_stages_keep_clashing_columns(spark, tmp_path):
    rows = [(i, f"text number {i % 7} " + "with many more words " * 20 + str(i % 14), "s", *[f"{i}:{h}" for h in HELPERS]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{h.replace('`', '``')}` string" for h in HELPERS))
    spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    whole = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and {tuple(r) for r in got} <= whole, name
        if name == "exact_dedup":
            assert {r.doc_id for r in got} == set(range(14))


def test_dedup_values(spark):
    rows = [(3, "a  b", "x", 1), (2, "a b", "y", 1), (2, "a\nb", "z", 2), (None, "a b", "w", 1), (5, None, "n", 1), (4, "", "e", 1), (6, " ", "e", 1), (7, "é", "u", 1), (7, "É", "u", 1)]
    for part in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _h1 int").repartition(part)
        got = {tuple(r) for r in exact_dedup.dedup(docs).collect()}
        first = [x for x in got if x[0] == 2]
        assert len(first) == 1 and first[0] in rows[1:3]
        if part == 1:
            was = first
        assert first == was and got - set(first) == {rows[5], rows[6], rows[7], rows[8]}
    kept = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.classes(docs).collect()}
    assert kept == {(3, 2, 4, False), (2, 2, 4, True), (2, 2, 4, False), (None, 2, 4, False), (5, 4, 2, False), (4, 4, 2, True), (6, 6, 1, True), (7, 7, 1, True)}


@pytest.mark.parametrize("most", [1 << 15, 1 << 17])
def test_bitmaps_in_pieces(spark, most, monkeypatch):
    digests = spark.range(20_000).select(F.xxhash64(F.when(F.col("id") % 10 == 0, F.col("id") % 1000).otherwise(F.col("id"))).alias("_h")).cache()
    whole = exact_dedup.possibly_repeated(digests, 20_000)
    pieces = exact_dedup.possibly_repeated(digests, 20_000, most=most)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(pieces) == key(whole) and 0 < whole.filter("_maybe").count() < 6000
    monkeypatch.setattr(exact_dedup, "ROUNDS", 1)
    assert exact_dedup.possibly_repeated(digests, 20_000, most=most).filter("_maybe").count() == 20_000


@pytest.mark.parametrize("text", [".eyJ" + "eyJ" * 350_000, ".eyJaaaaaaaaa" * 80_000, "eyJ" + "a" * 1_000_000, "-----BEGIN " * 90_000])
def test_secrets_of_long_runs_take_a_second(text):
    find = secret_scan.find_secrets()
    find(pa.array(["eyJabcdefgh.eyJabcdefgh.abcdefgh"]))
    begin = time.monotonic()
    find(pa.array([text]))
    assert time.monotonic() - begin < 3


@pytest.mark.parametrize("bits", [1, 16, 4096])
def test_bitmaps_lose_no_repeat(spark, bits):
    docs = spark.range(3000).select("id", F.concat(F.lit("t"), F.when(F.col("id") % 10 == 0, F.col("id") % 100).otherwise(F.col("id"))).alias("text"))
    digests = docs.select("text", F.xxhash64("text").alias("_h"))
    marked = exact_dedup.possibly_repeated(digests, 3000, bits).groupBy("text").agg(F.count("*").alias("n"), F.min("_maybe").alias("m")).collect()
    assert len(marked) == 2710 and all(r.m for r in marked if r.n > 1)
    assert bits < 16 or sum(r.m for r in marked if r.n == 1) < 0.15 * len(marked)


def test_mix_takes_what_the_quota_says(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").dropDuplicates(["doc_id"])
    sized = mixing.sizes(docs)
    want = {r.doc_id: r.c for r in mixing.mix_sizes(sized).filter("size > 0").select("doc_id", F.round(F.col("taken") / F.col("size")).cast("int").alias("c")).filter("c > 0").collect()}
    out = mixing.mix(docs)
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want
    goal = {r.source: (r.target, r.largest, r.shards) for r in mixing.mix_sizes(sized).groupBy("source").agg(F.first("target").alias("target"), F.max("size").alias("largest"), F.lit(1).alias("shards")).collect()}
    for r in mixing.sizes(out).groupBy("source").agg(F.sum("size").alias("n")).collect():
        assert abs(r.n - goal[r.source][0]) <= goal[r.source][1] / 2 + 64, r.source


def test_mix_of_rows_that_share_a_doc_id(spark):
    rows = [(1, "a " * 100, "s"), (1, "b " * 300, "s"), (1, "", "s"), (None, "c " * 50, None), (2, None, "t"), (3, "d " * 10, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(tuple(r) for r in mixing.mix(docs, block=1).collect())
    words = sum(len((r[1] or "").split()) * c for r, c in got.items())
    assert set(got) <= set(rows) and all(c <= 2 for c in got.values()) and not [r for r in got if not (r[1] or "").strip()]
    assert abs(words - 1.5 * 460) <= 200


def test_shingles_fall_short():
    texts = ["a b", "a b c", "a b c d", "", " x "]
    got = [Counter(d.tolist()) for _, _, b, o in chunks(pa.array(texts)) for d, _ in [shingles(b, o, 3)]]
    assert got == [Counter({0: 1, 1: 1, 2: 2, 4: 1})]


def test_rules_statistics():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["ab", "cd ", " ", "\n", "#", "é", "x y z "]) for _ in range(rng.randrange(60))) for _ in range(400)]
    at = 0
    for lo, hi, buf, off in chunks(pa.array(texts), 900):
        base, _ = quality_rules.statistics(buf, off)
        for text, row in zip(texts[lo:hi], base.tolist(), strict=True):
            w = brute.WORD.findall(text)
            times = Counter(zip(w, w[1:], w[2:], strict=False))
            covered = {i + j for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for j in range(3)}
            lines = [x for x in text.split("\n") if brute.WORD.search(x)]
            assert row == [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)]
            at += 1
    assert at == len(texts)


def test_trees_are_monotonic():
    rng = np.random.default_rng(0)
    x = rng.random((600, 2))
    y = (x[:, 0] + 0.5 * np.sin(9 * x[:, 0]) + 0.2 * rng.random(600) > 0.7).astype(float)
    forest = quality_rules.grow(x, y, np.array([1, 0]), trees=20)
    line = np.column_stack([np.linspace(0, 1, 200), np.full(200, 0.5)])
    assert (np.diff(forest.score(line)) >= -1e-12).all()


def test_rules_query_against_plain_counts_and_a_walk_of_the_trees(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    forest = quality_rules.train(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    got = {r.doc_id: r for r in quality_rules.judge(docs, forest).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        text, r = text or "", got[doc_id]
        w = brute.WORD.findall(text)
        times = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + j for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if brute.WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        (_, _, buf, off), = chunks(pa.array([text]))
        x = quality_rules.statistics(buf, off)[1][0]
        total = forest.bias
        for node in forest.roots.tolist():
            while forest.left[node] != node:
                node = forest.left[node] if x[forest.feature[node]] <= forest.cut[node] else forest.right[node]
            total += forest.value[node]
        score = 1 / (1 + np.exp(-total))
        assert abs(r.score - score) < 1e-9 and r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)


def test_ftrl_against_plain_dicts():
    rng = random.Random(6)
    rows = []
    for _ in range(150):
        y = rng.random() < 0.4
        slots = sorted(rng.sample(range(40), 8) + ([41] if y else [42]))
        rows.append((np.array(slots, np.int32), np.array([rng.random() for _ in slots], np.float32), int(y)))
    bias, weights = quality_classifier.ftrl(rows, 2)
    alpha, beta, l1, l2 = quality_classifier.ALPHA, quality_classifier.BETA, quality_classifier.L1, quality_classifier.L2
    z, n, zb, nb = Counter(), Counter(), 0.0, 0.0
    share = (sum(r[2] for r in rows) + 0.5) / (len(rows) + 1)
    b0 = float(np.log(share / (1 - share)))

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    def intercept():
        return b0 - zb / ((beta + nb**0.5) / alpha + l2)

    for _ in range(2):
        for slots, values, y in rows:
            own = {i: (float(v), weight(i)) for i, v in zip(slots.tolist(), values.tolist(), strict=True)}
            b = intercept()
            p = 1 / (1 + np.exp(-(b + sum(v * w for v, w in own.values()))))
            for i, (v, w) in own.items():
                g = (p - y) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w
                n[i] += g * g
            g = p - y
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / alpha * (b - b0)
            nb += g * g
    assert abs(bias - intercept()) < 1e-6
    assert np.allclose([weights[i] for i in range(45)], [weight(i) for i in range(45)], atol=1e-5)
    assert weights[41] > 0.1 > -0.1 > weights[42]


def test_classifier_scores_are_dot_products():
    texts = ["", "one two two, THREE", "one one", " \n", "é é ü 12 a-b " * 50]
    w = np.random.default_rng(1).normal(size=1 << quality_classifier.BITS).astype(np.float32)
    for lo, hi, buf, off in chunks(pa.array(texts), 20):
        doc, slot = quality_classifier.features(buf, off)
        got = quality_classifier.score_bytes(buf, off, 0.25, w)
        for i in range(hi - lo):
            own = slot[doc == i].tolist()
            words = len(brute.WORD.findall(texts[lo + i]))
            assert len(own) == words * 2 + max(0, words - 1) * 2 + max(0, words - 2)
            dot = sum(float(w[s]) for s in own) * quality_classifier.SCALE / max(1, len(own))
            assert abs(got[i] - 1 / (1 + np.exp(-(0.25 + dot)))) < 1e-9


def test_quality_and_near_stages_keep_what_they_should(spark, tmp_path):
    rng = random.Random(12)
    rows = []
    for i in range(90):
        w = [rng.choice(["stone", "river", "green", "walk", "slow", "light", "house", "under"]) + str(rng.randrange(40)) for _ in range(60)]
        if i % 9 == 8:
            w = [x + "$$$" for x in w]
        if i % 10 == 5 and rows:
            w = rows[-1][1].split(" ")
            w[7] = "changed"
        rows.append((i, " ".join(w), "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bad = {i for i, t, _ in rows if "$$$" in t}
    spark.createDataFrame([(i, int(i not in bad)) for i, _, _ in rows], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.stage_quality(spark, docs, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == set(range(90)) - bad
    left = corpus_pipeline.stage_near_dedup(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in left} == {root for _, root in near_brute([r[:2] for r in rows], 5, 80).values()}
    assert {tuple(r) for r in left} <= set(rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    theirs = duck.sql(queries.ORACLES[name])
    ours = queries.QUERIES[name](spark, DIR).select(*theirs.columns)
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())


def near_brute(rows, k, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = brute.WORD.findall((text or "").translate(lower))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent", "group"), [(3, 90, 256), (5, 80, 4), (1, 50, 3)])
def test_near_duplicates(spark, k, percent, group):
    rng = random.Random(percent)
    rows = []
    for i in range(220):
        if i % 3 and rows:
            w = (rng.choice(rows)[1] or "a").split(" ")
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = str(rng.randrange(50))
        else:
            w = [str(rng.randrange(300)) for _ in range(rng.randrange(1, 90))]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, k, percent, group).collect()}
    assert got == near_brute(rows, k, percent)


def test_near_duplicates_with_a_larger_third(spark):
    """A and B (J 0.91) share passages alone; C, larger and in A's group, stands on the later ones of their firsts only."""
    name = lambda kind, n: [f"{kind}{i}" for i in range(n)]
    early, late, last = name("e", 30), name("l", 870), name("x", 177)
    sets = [[*name("a", 43), *early, *late], [*name("b", 42), *early, *late], [*late, *last]]
    for i in range(40):  # many documents share the passages, so a document's own words rank first
        passages = [*last, *(late if i < 20 else []), *(early if i < 10 else [])]
        sets.append([*passages, *name(f"own{i}_", 2000 - len(passages))])
    rows = [(i, " ".join(s)) for i, s in enumerate(sets)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, 1, 90, 2).collect()}
    assert got[1] == (942, 0)
    assert got == near_brute(rows, 1, 90)


def test_a_large_cluster_is_compared_in_proportion_to_its_size(spark, monkeypatch):
    """300 near copies of one text, and texts that share a passage alone: links as by brute force, rows opened well under the square."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(300):
        w = list(base)
        w[rng.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(w)))
    for i in range(300, 400):
        rows.append((i, " ".join([*base[:20], *(f"own{i}_{j}" for j in range(60))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    opened = []
    plain = jaccard._opened

    def counted(docs, k, percent, some):
        opened.append(some.count())
        return plain(docs, k, percent, some)

    monkeypatch.setattr(jaccard, "_opened", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, 1, 90, 16).collect()}
    assert got == near_brute(rows, 1, 90)
    assert len(opened) == 2 and sum(opened) < 300 * 300 / 16 / 2


def test_blocks_of_large_sets_hold_fewer(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TOKENS", 400)
    rng = random.Random(9)
    rows = []
    for i in range(60):
        w = [f"w{j}" for j in range(100)]
        w[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(w if i % 3 else w[:15])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = []
    plain = jaccard._opened

    def counted(docs, k, percent, some):
        found = some.groupBy("g", "part", "member").count()
        sizes.extend(r["count"] for r in found.collect())
        return plain(docs, k, percent, some)

    monkeypatch.setattr(jaccard, "_opened", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, 1, 90, 256).collect()}
    assert got == near_brute(rows, 1, 90)
    assert sizes and max(sizes) <= 30


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_components(spark, monkeypatch, few):
    from weftline.llm import components as module

    monkeypatch.setattr(module, "FEW", few)
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 101)], "src long, dst long")
    got = dict(map(tuple, components(chain).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    star = spark.range(1, 3000).selectExpr("id % 2 * 5000 + 7000 AS src", "id AS dst").unionByName(spark.createDataFrame([(7000, 12000)], "src long, dst long"))
    assert {r.root for r in components(star).collect()} == {1} and components(star).count() == 3000


def test_secrets_and_pii():
    rng = random.Random(5)
    parts = ["0", "12", "255", "256", ".", "-", " ", "+", "(", "@", "a", "b.c", "token", "=", '"', "AKIA", "ABCDEF0123456789", "0123456789abcdef", "é", "4111111111111111", "PASSWORD", "ſecret", "٣"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(8000)]
    for find, plain in ((secret_scan.find_secrets(), brute.secrets), (pii.find_pii(), brute.pii)):
        for text, (base, every) in zip(texts, find(pa.array(texts)), strict=True):
            assert base == plain(text)
            assert set(base) <= set(every)


def test_added_spans():
    key = "ghp_" + "Zx" * 18
    assert secret_scan.find_secrets()(pa.array([f"x {key}"]))[0][1] == [("github", 2, 42)]
    assert [s[0] for s in pii.find_pii()(pa.array(["SSN 123-45-6789", "iban: DE89 3704 0044 0532 0130 00"]))[1][1]] == ["iban"]


def test_added_pii_whole():
    def added(text):
        base, every = pii.find_pii()(pa.array([text]))[0]
        return [(k, text[s:e]) for k, s, e in every if (k, s, e) not in base]

    one, two = "123-45-6789", "987-65-4321"
    assert added(f"SSN: {one}, {two}") == [("ssn", one), ("ssn", two)]
    assert added("sSn: " + ", ".join([one] * 20)) == [("ssn", one)] * 20
    assert added(f"é Ssn {one} SOCIAL Security {two}") == [("ssn", one), ("ssn", two)]
    assert added("Iban: DE89 3704 0044 0532 0130 00") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("see (HTTPS://u:p@ex.org:80/a_(b)?q=1#x), http://[::1]/.") == [("url", "HTTPS://u:p@ex.org:80/a_(b)?q=1#x"), ("url", "http://[::1]/")]
    assert added("Mailto:a@b.com,c@d.org?subject=x; tel:+1-201-555-0123;ext=5. tel:555-0100.") == [("url", "Mailto:a@b.com,c@d.org?subject=x"), ("url", "tel:+1-201-555-0123;ext=5"), ("url", "tel:555-0100")]
    for text in ("a :// b", "http://", "http:///x", "hotel:12345", "mailto:a@b", "tel:no", "mailto:", "tel:12", "ssn", "ssn 123-45-67890"):
        assert added(text) == [], text


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]+") is None
    assert secret_scan.trigram_query(r"(?<!z)ab(?:c|d)?\.ef{2}[gh]i$") == frozenset({frozenset({b"ab.", b"b.e", b".ef"}), frozenset({b"abc", b"bc.", b"c.e", b".ef"}), frozenset({b"abd", b"bd.", b"d.e", b".ef"})})
    assert secret_scan.trigram_query(r"abc|x[a-z]{1}(?i:Y\x20Z)|\d*qrs+") == frozenset({frozenset({b"abc"}), frozenset({b"y z"}), frozenset({b"qrs"})})
    assert secret_scan.trigram_query("(abc){1}[]x-]d?") == frozenset({frozenset({b"abc", b"bc" + c}) for c in (b"]", b"x", b"-")})
    assert secret_scan.trigram_query("ab(cd|ef)x") == frozenset({frozenset({b"abc", b"bcd", b"cdx"}), frozenset({b"abe", b"bef", b"efx"})})


TERMS = [("idiot", toxicity.WORD), ("scum", toxicity.WORD), ("lowei", toxicity.STEMS), ("boo", toxicity.WORD), ("idioms", toxicity.EXACT), ("\U0001d51e\U0001d51f\U0001d520\U0001d521", toxicity.WORD)]


def look(automaton, word):
    points = np.array([ord(c) for c in word], np.uint32)
    s = int(automaton.run(points, np.array([0]), np.array([len(word)]))[0])
    return (int(automaton.exact[s]), int(automaton.fuzzy[s]), int(automaton.stem[s])) if s else (-1, -1, -1)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_levenshtein_automaton_against_plain_edit_distance():
    rng = random.Random(8)
    automaton = toxicity.Automaton.build(TERMS)
    words = [t for t, _ in TERMS] + ["loweix", "idiotic", "\U0001f600\U0001f601\U0001f602", "scun", "bo", "oidiot"]
    for _ in range(6000):
        w = list(rng.choice(TERMS)[0])
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice(["", "x", "o", "i", "\U0001d51f", "\U0001f600"])
            w = w or ["z"]
        words.append("".join(w))
    for word in words:
        exact, fuzzy, stem = look(automaton, word)
        same = [i for i, (t, k) in enumerate(TERMS) if k != toxicity.STEMS and t == word]
        near = [i for i, (t, k) in enumerate(TERMS) if k == toxicity.WORD and len(t) >= toxicity.FUZZY_LENGTH and edits(t, word) == 1]
        heads = [i for i, (t, k) in enumerate(TERMS) if k == toxicity.STEMS and word.startswith(t)]
        assert exact == (same[0] if same else -1), word
        assert stem == (heads[0] if heads else -1), word
        if not same:
            assert (fuzzy in near) if near else fuzzy == -1, word


def test_misspelled_terms_and_quotations():
    rng = random.Random(3)
    prose = ["".join(rng.choice(["ta", "ri", "mo", "sen", "ku"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    texts, toxic = [], []
    for i in range(900):
        w = [rng.choice(prose) for _ in range(60)]
        if i % 4 == 0:
            w[rng.randrange(60)] = rng.choice(["idiot", "scum!", "moron"])
        elif i % 5 == 0:
            w[rng.randrange(60)] = "oron"
        texts.append(" ".join(w))
        toxic.append(int(i % 4 == 0))
    model = toxicity.fit(texts, toxic)
    assert {t for t, w in zip(model.terms, model.weight, strict=True) if w > 0} == {(t, toxicity.WORD) for t in ("idiot", "scum", "moron")}
    tail = " ".join(prose[:20])
    asked = ["an idiot", "an idi0t", "such scun", "an oron", "they said “you idiot” to me", "nothing"]
    got = {t: float(model.score(b, o)[0]) for t in asked for _, _, b, o in chunks(pa.array([f"{t} {tail}"]))}
    assert got["an idiot"] > got["an idi0t"] > 0.5 and got["such scun"] > 0.5
    assert got["an oron"] == got["nothing"] < 0.1 and got["they said “you idiot” to me"] < got["an idi0t"]


def test_words_of_training_are_those_of_scoring():
    texts = ["Idiot\u00a0x y", "\u2003 A-B (c) \U0001f600\U0001d51e\n\x1cÉ!", "", " "]
    assert toxicity.word_sets(texts) == [{"idiot\u00a0x", "y"}, {"a-b", "c", "\U0001d51e", "é"}, set(), set()]


PACKED = ["", None, "a b", "x" * 5000, "a <|endoftext|> b", "<|endoftext|>", "été <|endoftext|> \U0001f600", "<|endoftext", "word " * 4000, "  \n "]


@pytest.mark.parametrize("tasks", [packing.MAX_TASKS, 2])
def test_packing_round_trip(spark, monkeypatch, tasks):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "MAX_TASKS", tasks)
    slow = Tokenizer.from_file(packing.default_tokenizer())
    assert slow.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    texts = list(enumerate(PACKED))
    df = spark.createDataFrame([(i, t, f"s{i % 2}") for i, t in texts], "doc_id long, text string, source string")
    rows = packing.pack(df, length=64, window=256, part_tokens=2000).collect()
    for i, t in texts:
        ids = np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in own] == [sum(r.length for r in own[:j]) for j in range(len(own))]
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    pieces = {}
    for r in rows:
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in map(sorted, pieces.values()):
        total = sum(n for _, n in own)
        assert [o for o, _ in own] == [sum(n for _, n in own[:j]) for j in range(len(own))]
        assert total == 64 or total & (total - 1) == 0


def test_texts_of_fixtures_have_the_ids_of_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.default_tokenizer())
    texts = [r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    encode, _ = packing._encoder(packing.default_tokenizer())
    assert [encode(t).tolist() for t in texts] == [slow.encode(t, add_special_tokens=False).ids for t in texts]


def windows(robin, window):
    stream = [name for name, start, end in robin.take(robin.waiting - 40 * window) for _ in range(end - start)]
    return [Counter(stream[at : at + window]) for at in range(0, len(stream) - window, window)]


@pytest.mark.parametrize("shares", [{"a": 0.75, "b": 0.25}, {"a": 0.9, "b": 0.07, None: 0.03}])
def test_every_window_holds_the_targets(shares):
    window = 8 * 1024
    robin = packing.RoundRobin(window)
    for name, share in shares.items():
        robin.source(name, share, 0.0)
        for i in range(3000):
            robin.put(name, 10 + i % 700 if name == "a" else 2000 + i, name)
    found = windows(robin, window)
    assert len(found) > 20
    for sent in found:
        assert all(abs(sent[name] - share * window) <= 2 for name, share in shares.items())


def test_deficits_open_a_partition():
    robin = packing.RoundRobin(1024)
    robin.source("a", 0.5, -512.0)
    robin.source("b", 0.5, 512.0)
    for name in "ab":
        for _ in range(1000):
            robin.put(name, 100, name)
    first, second = windows(robin, 1024)[:2]
    assert (first["b"], second["a"]) == (1024, 512)


def test_packing_targets(spark):
    rows = [(i, "word " * (50 + i % 90), "ab"[i % 2]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = packing.pack(docs, length=64, window=512, part_tokens=10_000, targets={"a": 3, "b": 1}).join(docs, "doc_id")
    assert out.agg(F.sum("length")).first()[0] == packing.pack(docs).agg(F.sum("length")).first()[0]
    early = out.filter("sequence_id < 48").groupBy("source").agg(F.sum("length").alias("n")).collect()
    n = {r.source: r.n for r in early}
    assert abs(n["a"] / (n["a"] + n["b"]) - 0.75) < 0.05


@pytest.mark.parametrize(("op", "column"), [("op4_quality_classifier", "quality"), ("op7_toxicity", "toxic")])
def test_held_out_accuracy(spark, op, column):
    d = "/root/testdata/sf0.1"
    got = queries.QUERIES[op](spark, d).filter("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    assert got.agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0] > 0.97


def test_language_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op3_language_id"](spark, d).join(spark.read.parquet(f"{d}/documents.parquet"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_language_filters_against_plain_sets(spark):
    """The bit-sliced filter names every language that holds an n-gram, few others, and decides as plain sets do."""
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    filters = language_id.train(docs)
    owned = language_id.owned_grams(docs)
    assert sorted(owned) == sorted(filters.languages) and all(len(x) for x in owned.values())
    sets = {k: set(x.tolist()) for k, x in owned.items()}
    texts = [r.text for r in docs.filter("text IS NOT NULL").limit(300).collect()]
    agree = 0
    for lo, hi, buf, off in chunks(pa.array(texts)):
        doc, code = language_id.grams(buf, off)
        total, hits = filters.counts(buf, off)
        best, _ = filters.predict(buf, off)
        for i in range(hi - lo):
            own = code[doc == i].tolist()
            assert total[i] == len(own)
            exact = [sum(c in sets[k] for c in own) for k in filters.languages]
            extra = hits[i] - exact
            assert (extra >= 0).all() and (extra <= 5 + 3 * filters.rate * len(own)).all()
            agree += exact[best[i]] == max(exact)
    assert agree >= 0.99 * len(texts)


def test_rare_languages_are_learned(spark):
    common = [(i, " ".join(f"wab{(i * j) % 97} kolim" for j in range(1, 9)), "aa") for i in range(3000)]
    rare = [(5000 + i, " ".join(f"\u00fczt\u00f6 gr\u00fcn{(i * j) % 31}" for j in range(1, 9)), "zz") for i in range(12)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    filters = language_id.train(docs, sample=100)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, filters).collect()}
    assert all(got[i] == "aa" for i, _, _ in common) and all(got[i] == "zz" for i, _, _ in rare)


def test_mixture_is_near_its_targets(spark):
    d = "/root/testdata/sf0.01"
    got = mixing.op2_mixing(spark, d).groupBy("target", "source_size").agg(F.sum("taken").alias("taken"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    for r in got.collect():
        assert abs(r.taken - r.target) <= 64 and r.over <= 0


def test_forgotten_tables_are_gone(spark, tmp_path):
    from weftline.llm import _text

    _text.forget()
    path = _text.written(spark.range(3).coalesce(1), "x").inputFiles()[0]
    assert spark.read.parquet(path).count() == 3
    _text.forget()
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(path).count()


def test_samples_are_bounded_and_agree(spark):
    from weftline.llm import _text

    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', 100) AS text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality").unionByName(docs.filter("doc_id < 10").selectExpr("doc_id", "1 AS quality"))
    whole = _text.labelled_sample(docs, labels, "quality", 10_000, 1 << 30).collect()
    assert len(whole) == len({r.doc_id for r in whole}) and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in whole)
    assert all(r._y == 1 for r in whole if r.doc_id < 10)
    some = [_text.labelled_sample(docs.repartition(k), labels, "quality", 500, 20_000).collect() for k in (1, 5)]
    assert {r.doc_id for r in some[0]} == {r.doc_id for r in some[1]} and 100 < len(some[0]) < 320


def test_normalised_spaces():
    assert re.sub(exact_dedup.SPACE, " ", "a\x0b\x0c b") == "a b"
