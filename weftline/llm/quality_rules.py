"""Quality rules: gradient-boosted trees over document statistics.

Base rules drop documents that are too short or repeat themselves; trees over
a dozen statistics decide about the rest.  The trees are grown on the driver
from a bounded sample of labelled rows (`sample` rows of a dozen floats), with
monotonic constraints on chosen statistics, and flattened into numpy node
arrays: a batch of documents steps through one level of all its paths at once.

Rows whose crc32(doc_id) is 0 modulo 5 are never learned, so held-out accuracy
can be measured.

Edge cases: a null text has no words and fails the base rules; so does an
empty one; without labels, or with labels of one kind, the trees keep all that
pass the base rules; repeated rows are judged each; an empty table gives an
empty result; extra columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weftline.llm._text import CONT, WS, Hasher, chunks, documents, labelled_sample, map_text, mix, per_doc, words

SAMPLE = 20_000
SAMPLE_BYTES = 256 << 20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS, MIN_LEAF, L2 = 60, 4, 0.15, 64, 10, 1.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_RANGE = lambda a, b: (np.arange(256) >= ord(a)) & (np.arange(256) <= ord(b))
_UPPER, _DIGIT = _RANGE("A", "Z"), _RANGE("0", "9")
_LETTER = _UPPER | _RANGE("a", "z") | (np.arange(256) >= 0xC0)
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".?!"]] = True

#: Name and direction of each statistic: -1 if more of it may never raise the score, 0 if free.
STATISTICS = (("log_words", 0), ("word_length", 0), ("symbols_per_word", -1), ("dup_line_share", -1), ("repeat_share", -1), ("upper_share", -1), ("digit_share", -1), ("letter_share", 0), ("stops_per_word", 0), ("words_per_line", 0), ("twice_share", -1))
MONOTONE = np.array([m for _, m in STATISTICS])


def _repeated(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which (doc, key) occur twice or more."""
    k = mix(key + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(k)
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[order][1:] == k[order][:-1]
    out = np.empty(len(k), bool)
    out[order] = same[1:] | same[:-1]
    return out


def statistics(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base columns (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the matrix of STATISTICS."""
    n = len(off) - 1
    base, x = np.zeros((n, 5), np.int64), np.zeros((n, len(STATISTICS)))
    if not len(buf):
        return base, x
    s, e, doc = words(buf, off)
    hasher = Hasher(buf)
    count = np.bincount(doc, minlength=n)
    chars = per_doc(~WS[buf] & ~CONT[buf], off)
    symbols = per_doc(_SYMBOL[buf], off)

    cut = np.unique(np.concatenate([off[:-1], np.flatnonzero(buf == 10) + 1]))
    cut = cut[cut < len(buf)]
    filled = np.unique(np.searchsorted(cut, s, "right") - 1)
    first = cut[filled]
    last = np.append(cut[1:], len(buf))[filled]
    last = np.where(buf[last - 1] == 10, last - 1, last)
    owner = np.searchsorted(off, first, "right") - 1
    line = mix(hasher(first, last) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((first, line))
    again = np.zeros(len(line), bool)
    again[order[1:]] = line[order][1:] == line[order][:-1]
    lines, dup = np.bincount(owner, minlength=n), np.bincount(owner[again], minlength=n)

    h = hasher(s, e)
    covered = np.zeros(len(s), bool)
    if len(s) > 2:
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        a = np.uint64(0x9E3779B97F4A7C15)
        window = mix(mix(h[inside] * a + h[inside + 1]) * a + h[inside + 2])
        hit = inside[_repeated(doc[inside], window)]
        for j in range(3):
            covered[hit + j] = True
    repeat = np.bincount(doc[covered], minlength=n)
    twice = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=n)

    base[:] = np.stack([count, chars, symbols, dup, repeat], 1)
    w, c = np.maximum(1, count), np.maximum(1, chars)
    letters = per_doc(_LETTER[buf], off)
    x[:] = np.stack([np.log1p(count), chars / w, symbols / w, dup / np.maximum(1, lines), repeat / w, per_doc(_UPPER[buf], off) / np.maximum(1, letters), per_doc(_DIGIT[buf], off) / c, letters / c, per_doc(_STOP[buf], off) / w, count / np.maximum(1, lines), twice / w], 1)
    return base, x


@dataclass
class Forest:
    """All trees in flat arrays; a leaf points at itself."""

    bias: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                go = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(go, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def grow(x: np.ndarray, y: np.ndarray, monotone: np.ndarray = MONOTONE, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosted trees for the log loss; leaf values respect the constraints by bounds handed down at each split."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    nodes: list[list[float]] = []  # feature, cut, left, right, value
    roots: list[int] = []
    bias = float(np.log(share / (1 - share)))
    if 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
        raw = np.full(len(y), bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, hess = p - y, p * (1 - p)

            def build(rows: np.ndarray, level: int, low: float, high: float) -> int:
                G, H = g[rows].sum(), hess[rows].sum()
                value = float(np.clip(-G / (H + L2), low, high))
                at = len(nodes)
                nodes.append([0, 0.0, at, at, RATE * value])
                best = (1e-6, None)
                if level < depth and len(rows) >= 2 * MIN_LEAF:
                    for j, c in enumerate(cuts):
                        if not len(c):
                            continue
                        b = binned[rows, j]
                        gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                        hl = np.cumsum(np.bincount(b, hess[rows], len(c) + 1))[:-1]
                        nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                        vl = np.clip(-gl / (hl + L2), low, high)
                        vr = np.clip(-(G - gl) / (H - hl + L2), low, high)
                        cost = lambda v, gg, hh: gg * v + 0.5 * (hh + L2) * v * v
                        gain = cost(value, G, H) - cost(vl, gl, hl) - cost(vr, G - gl, H - hl)
                        ok = (nl >= MIN_LEAF) & (len(rows) - nl >= MIN_LEAF)
                        if monotone[j]:
                            ok &= (vr - vl) * monotone[j] >= 0
                        gain = np.where(ok, gain, -1.0)
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], (j, k, float(vl[k]), float(vr[k])))
                if best[1]:
                    j, k, vl, vr = best[1]
                    go = binned[rows, j] <= k
                    mid = (vl + vr) / 2
                    bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[int(monotone[j])]
                    left = build(rows[go], level + 1, *bounds[0])
                    right = build(rows[~go], level + 1, *bounds[1])
                    nodes[at] = [j, float(cuts[j][k]), left, right, 0.0]
                else:
                    raw[rows] += RATE * value
                return at

            roots.append(build(np.arange(len(y)), 0, -np.inf, np.inf))
    flat = np.array(nodes).reshape(-1, 5)
    return Forest(bias, np.array(roots, int), flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4], depth)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    rows = labelled_sample(docs, labels, "quality", sample, SAMPLE_BYTES)

    def measure(batches):
        for b in batches:
            for lo, hi, buf, off in chunks(b.column(0)):
                yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), pa.array(list(statistics(buf, off)[1]), pa.list_(pa.float64()))], ["y", "x"])

    got = map_text(rows, measure, "y int, x array<double>", "text", "_y").toArrow()
    if not got.num_rows:
        return grow(np.zeros((0, len(STATISTICS))), np.zeros(0))
    x = np.array(got.column("x").to_pylist())
    y = (got.column("y").to_numpy() > 0).astype(float)
    order = np.lexsort((y, *x.T))  # the trees do not depend on the order of arrival
    return grow(x[order], y[order])


def judge(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base columns, base_failed, kept and score of every row."""
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for b in batches:
            for lo, hi, buf, off in chunks(b.column(1)):
                base, x = statistics(buf, off)
                failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
                score = model.value.score(x)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *[pa.array(base[:, j]) for j in range(5)], pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)], schema.names)

    longs = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    schema = T.StructType([docs.schema["doc_id"], *longs, T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("score", T.DoubleType())])
    return map_text(docs, run, schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
