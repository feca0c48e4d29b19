"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

Features are counts of hashed word 1- and 2-grams, and of 1- to 3-grams of
word shapes (which kinds of character a word has), each document's scaled to
sum to a constant.  A score is then a sparse dot product: one gather of
weights and one sum per document, over numpy arrays.

Training (FTRL-proximal, one document at a time) runs in one task over a
bounded sample of labelled documents (`sample`, chosen by a seeded hash of
doc_id); what returns to the driver is the weights that are not zero, at most
2 ** BITS of them.  Rows whose crc32(doc_id) is 0 modulo 5 are never learned.

Edge cases: null and empty texts, and texts without words, score as the
intercept alone; without any label the score is 0.5 for all, with labels of
one kind that kind's smoothed share; repeated rows are scored each; labels
that are null are not learned; an empty table gives an empty result; extra
columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._text import Hasher, chunks, crc_mod, documents, labelled_sample, map_text, mix, splitmix, words

BITS = 18
SAMPLE = 8000
SAMPLE_BYTES = 256 << 20
SCALE = 20.0
THRESHOLD = 0.3
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.02, 0.02, 3

#: Kinds of character, as bits of a word's shape.
_KIND = np.zeros(256, np.uint64)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("a") : ord("z") + 1] = 2
_KIND[128:] = 2
_KIND[ord("0") : ord("9") + 1] = 4
for _i, _c in enumerate("#*$%&|<>!?.,;:-_@/\\=+'\"()[]{}~^`"):
    _KIND[ord(_c)] = 8 << _i


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot) of every n-gram occurrence."""
    s, e, doc = words(buf, off)
    if not len(s):
        return doc, np.zeros(0, np.int64)
    h = Hasher(buf)(s, e)
    # Bytes between words have kind 0, so a run up to the next word is the word's own.
    shape = mix(np.bitwise_or.reduceat(_KIND[buf], s) + np.uint64(11))
    docs, slots = [doc], [h]
    same = doc[1:] == doc[:-1]
    a = np.uint64(0x9E3779B97F4A7C15)
    pair = mix(h[:-1] * a + h[1:])
    pair[h[1:] == h[:-1]] = 7  # a word said twice in a row
    docs.append(doc[1:][same])
    slots.append(pair[same])
    docs.append(doc)
    slots.append(shape)
    two = mix(shape[:-1] * a + shape[1:] + np.uint64(1))
    docs.append(doc[1:][same])
    slots.append(two[same])
    if len(s) > 2:
        run = same[1:] & same[:-1]
        docs.append(doc[2:][run])
        slots.append(mix(two[:-1] * a + shape[2:])[run])
    return np.concatenate(docs), (mix(np.concatenate(slots)) >> np.uint64(64 - BITS)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> tuple[float, np.ndarray]:
    """Intercept and weights from (slots, values, label) rows, taken in order, `epochs` times."""
    y = np.array([r[2] for r in rows], float)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    bias = float(np.log(share / (1 - share)))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = 0.0

    def weight(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    if 0 < y.sum() < len(y):
        b0 = bias
        for _ in range(epochs):
            for slots, values, label in rows:
                w = weight(z[slots], n[slots])
                bias = b0 - zb / ((BETA + np.sqrt(nb)) / ALPHA + L2)
                p = 1 / (1 + np.exp(-np.clip(bias + w @ values, -35, 35)))
                g = (p - label) * values
                z[slots] += g - (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / ALPHA * w
                n[slots] += g * g
                gb = p - label
                zb += gb - (np.sqrt(nb + gb * gb) - np.sqrt(nb)) / ALPHA * (bias - b0)
                nb += gb * gb
        bias = b0 - zb / ((BETA + np.sqrt(nb)) / ALPHA + L2)
    return bias, weight(z, n).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> tuple[float, np.ndarray]:
    """Intercept and weights; learns rows of `labels` whose doc_id is in `docs`, but the held-out ones."""
    rows = labelled_sample(docs, labels, label, sample, SAMPLE_BYTES)

    def fit(batches):
        seen = []
        for b in batches:
            ids, y = b.column(0).to_pylist(), b.column(2).to_numpy()
            for lo, hi, buf, off in chunks(b.column(1)):
                doc, slot = features(buf, off)
                order = np.lexsort((slot, doc))
                doc, slot = doc[order], slot[order]
                ends = np.searchsorted(doc, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    own, count = np.unique(slot[ends[i] : ends[i + 1]], return_counts=True)
                    seen.append((ids[lo + i], own.astype(np.int32), (count * (SCALE / max(1, count.sum()))).astype(np.float32), int(y[lo + i] > 0)))
        if not seen:
            return
        seen.sort(key=lambda r: (hash_id(r[0]), str(r[0])))
        bias, w = ftrl([r[1:] for r in seen])
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias).astype(np.float64))], ["slot", "w"])

    got = map_text(rows.repartition(1), fit, "slot long, w double", "doc_id", "text", "_y").toArrow()
    w, bias = np.zeros(1 << BITS, np.float32), 0.0
    if got.num_rows:
        slot, value = got.column(0).to_numpy(), got.column(1).to_numpy()
        w[slot[slot >= 0]] = value[slot >= 0]
        bias = float(value[slot < 0][0])
    return bias, w


def hash_id(x) -> int:
    """A seeded order of training rows that does not depend on how they were dealt out."""
    return splitmix(x & ((1 << 64) - 1)) if isinstance(x, int) else 0


def score_bytes(buf: np.ndarray, off: np.ndarray, bias: float, w: np.ndarray) -> np.ndarray:
    doc, slot = features(buf, off)
    n = len(off) - 1
    total = np.bincount(doc, weights=w[slot], minlength=n)
    dot = total * (SCALE / np.maximum(1, np.bincount(doc, minlength=n)))
    return 1 / (1 + np.exp(-np.clip(bias + dot, -35, 35)))


def score(docs: DataFrame, model: tuple[float, np.ndarray]) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    bias = model[0]
    w = docs.sparkSession.sparkContext.broadcast(model[1])

    def run(batches):
        for b in batches:
            out = np.empty(len(b))
            for lo, hi, buf, off in chunks(b.column(1)):
                out[lo:hi] = score_bytes(buf, off, bias, w.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], ["doc_id", "score"])

    return map_text(docs, run, T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def keep(docs: DataFrame, model: tuple[float, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that score at or above the threshold."""
    bias = model[0]
    w = docs.sparkSession.sparkContext.broadcast(model[1])
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            ok = np.empty(len(b), bool)
            for lo, hi, buf, off in chunks(b.column(at)):
                ok[lo:hi] = score_bytes(buf, off, bias, w.value) >= threshold
            yield b.filter(pa.array(ok))

    # By place, as mapInArrow does not take every name.
    names = [f"c{i}" for i in range(len(docs.columns))]
    schema = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, docs.schema, strict=True)])
    return map_text(docs.toDF(*names), run, schema, *names).toDF(*docs.columns)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
