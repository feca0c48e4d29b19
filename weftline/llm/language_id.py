"""Language ID: language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the n-grams of all languages: slot i is a
word of bits, one per language, and the AND of an n-gram's slots names every
language that may contain it.  A document's n-grams are counted per language
(popcounts of each bit), the counts are corrected for each language's false
positive rate, and the largest corrected share decides.

N-grams are runs of N bytes of the lower-cased text, in which all that is not
a letter is one space.  A language's n-grams are those found in at least
`LEAST` of its sampled documents, and not far more often elsewhere.  The sample
is bounded (`sample` documents of each language, chosen by a seeded hash of
doc_id) and never holds a row whose crc32(doc_id) is 2 modulo 4, so a rare
language is learned from as many documents as it has.  Up to 64 languages share a filter; more use further filters.

Edge cases: a null text, or one without a letter (of any script), is `und`
with score 0; letters that no filter knows, and ties, give the first language
in the order of sampled documents, then of names; without any learnable row
all are `und`; repeated rows are predicted each; an empty table gives an empty
result; extra columns are never read, nor are lang, source and doc_id of what
is predicted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._text import LOWER, chunks, crc_mod, documents, map_text, mix, seeded_hash, written

#: Documents of each language.
SAMPLE = 2000
N = 4
LEAST = 0.01
#: An n-gram belongs to a language only if it is this often there as in its commonest language.
FAIR = 0.15
HASHES = 3
SLOTS = 1 << 18

_LETTER = ((np.arange(256) >= ord("a")) & (np.arange(256) <= ord("z"))) | (np.arange(256) >= 128)
_CODE = np.where(_LETTER, np.arange(256), 32).astype(np.uint8)[LOWER]


def grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, code) of every n-gram: N bytes of one document, with a letter and no two spaces side by side."""
    if len(buf) < N:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint32)
    c = _CODE[buf]
    ok = np.ones(len(c) - N + 1, bool)
    code = np.zeros(len(ok), np.uint32)
    space = c == 32
    pair = space[1:] & space[:-1]
    for j in range(N):
        code |= c[j : len(c) - N + 1 + j].astype(np.uint32) << np.uint32(8 * j)
        if j < N - 1:
            ok &= ~pair[j : j + len(ok)]
    for j in range(1, N):  # starts from which a gram would run into the next document
        at = off[1:] - j
        at = at[(at >= 0) & (at < len(ok))]
        ok[at] = False
    ok = np.flatnonzero(ok)
    return np.searchsorted(off, ok, "right") - 1, code[ok]


def _slots(code: np.ndarray) -> list[np.ndarray]:
    h = mix(code.astype(np.uint64) + np.uint64(1))
    bits = np.uint64(SLOTS.bit_length() - 1)
    return [((h >> (bits * np.uint64(i))) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass
class Filters:
    """`planes`: for each 64 languages, the bit-sliced filter; `rate`: false positives of each language."""

    languages: list[str]
    planes: list[np.ndarray]
    rate: np.ndarray

    def counts(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each document, and of these the ones each language may contain."""
        doc, code = grams(buf, off)
        n = len(off) - 1
        hits = np.zeros((n, len(self.languages)))
        if len(code):
            slots = _slots(code)
            for p, plane in enumerate(self.planes):
                mask = plane[slots[0]]
                for s in slots[1:]:
                    mask &= plane[s]
                for j in range(min(64, len(self.languages) - 64 * p)):
                    hits[:, 64 * p + j] = np.bincount(doc, weights=(mask >> np.uint64(j)) & np.uint64(1), minlength=n)
        return np.bincount(doc, minlength=n), hits

    def predict(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, hits = self.counts(buf, off)
        share = np.clip((hits / np.maximum(1, total)[:, None] - self.rate) / (1 - self.rate), 0, 1)
        best = share.argmax(1)
        whole = share.sum(1)
        top = share[np.arange(len(best)), best]
        return best, np.where(whole > 0, top / np.where(whole > 0, whole, 1), 1 / len(self.languages))


def build(languages: list[str], owned: dict[str, np.ndarray]) -> Filters:
    planes, rate = [], np.zeros(len(languages))
    for p in range(0, len(languages), 64):
        plane = np.zeros(SLOTS, np.uint64)
        for j, name in enumerate(languages[p : p + 64]):
            for s in _slots(owned[name]):
                np.bitwise_or.at(plane, s, np.uint64(1) << np.uint64(j))
        for j in range(len(languages[p : p + 64])):
            rate[p + j] = min(0.99, float(((plane >> np.uint64(j)) & np.uint64(1)).mean()) ** HASHES)
        planes.append(plane)
    return Filters(languages, planes, rate)


def owned_grams(docs: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """The n-grams of each language, the languages in the order of learnable documents, then of names."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 4) != 2)).select("doc_id", "lang", "text")
    known = written(usable.groupBy("lang").agg(F.count("*").alias("docs")), "languages")
    cut = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("docs")) * float(1 << 62)
    rows = usable.join(known, "lang").filter(seeded_hash("doc_id", 17) <= cut.cast("long"))

    def count(batches):
        seen: dict[tuple[str, int], int] = {}
        for b in batches:
            lang = b.column(1).to_pylist()
            for lo, hi, buf, off in chunks(b.column(0)):
                doc, code = grams(buf, off)
                pairs = np.unique(doc.astype(np.uint64) << np.uint64(32) | code)
                doc, code = (pairs >> np.uint64(32)).astype(np.int64), pairs & np.uint64(0xFFFFFFFF)
                for name in set(lang[lo:hi]):
                    own = np.array([x == name for x in lang[lo:hi]])
                    got, times = np.unique(code[own[doc]], return_counts=True)
                    seen[name, -1] = seen.get((name, -1), 0) + int(own.sum())
                    for g, t in zip(got.tolist(), times.tolist(), strict=True):
                        seen[name, g] = seen.get((name, g), 0) + t
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())], ["lang", "gram", "n"])

    sums = written(map_text(rows, count, "lang string, gram long, n long", "text", "lang").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram_counts")
    sizes = {r["lang"]: r["docs"] for r in known.collect()}
    most = sums.filter("gram = -1").select("lang", F.col("n").alias("docs"))
    rated = sums.filter("gram >= 0").join(most, "lang").withColumn("rate", F.col("n") / F.col("docs"))
    rated = rated.withColumn("top", F.max("rate").over(W.partitionBy("gram")))
    got = rated.filter((F.col("rate") >= LEAST) & (F.col("rate") >= FAIR * F.col("top")) & ((F.col("n") > 1) | (F.col("docs") < 10))).select("lang", "gram").toArrow()
    lang, gram = np.array(got.column("lang").to_pylist(), object), got.column("gram").to_numpy()
    return {k: gram[lang == k].astype(np.uint64) for k in sorted(sizes, key=lambda k: (-sizes[k], k))}


def train(docs: DataFrame, sample: int = SAMPLE) -> Filters:
    owned = owned_grams(docs, sample)
    return build(list(owned), owned)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    model = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for b in batches:
            texts = b.column(1)
            for lo, hi, buf, off in chunks(texts):
                names, score = ["und"] * (hi - lo), np.zeros(hi - lo)
                if model.value.languages:
                    best, score = model.value.predict(buf, off)
                    sure = np.zeros(len(buf) + 1, np.int64)
                    np.cumsum(_LETTER[LOWER[buf]] & (buf < 128), out=sure[1:])
                    ascii_letter = sure[off[1:]] > sure[off[:-1]]
                    for i in range(hi - lo):
                        if ascii_letter[i] or any(ch.isalpha() for ch in texts[lo + i].as_py() or ""):
                            names[i] = model.value.languages[best[i]]
                        else:
                            score[i] = 0.0
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_text(docs, run, T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs, train(docs))
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
