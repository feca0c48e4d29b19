"""Importance resampling towards a target distribution.

1. Every run of one to three words (as in `_words`) is a feature and falls into
   the bucket of its CRC-32.  Buckets are counted over all documents and over
   the target texts, in the tasks first, so a task sends one number a bucket.
2. A bucket's gain is the logarithm of how much likelier the target makes it.
   The gains are one array of BUCKETS numbers; a second pass sums them over
   each document's features and adds a seeded Gumbel number, so the highest
   scores are a sample without replacement in proportion to exp(weight).
3. The k-th highest key is found by radix selection: the key (score, doc_id and
   what else tells rows apart) is looked through 16 bits at a time from the top;
   each round counts the digit's values among the rows that share the digits
   found so far, so the driver sees 65536 numbers at most.
4. Only the rows above the cut are sorted by ranges and ranked; the others are
   not shuffled.

CRCs of all words of a block are computed side by side, and those of longer
runs from them, as a CRC of a joined text is linear in those of its parts.

Edge cases: null and empty texts have no features, weight 0 and are never
drawn, as all texts with fewer than MIN_WORDS words; a null doc_id is empty in
the seeded text and comes after all others in ties; rows that tie in score and
doc_id are drawn by their number of features, then in any order, each counted;
without a target the gains are those of an empty one; empty tables give no row;
extra columns, of any name, are never read.  Ids are whole numbers.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._text import chunks, documents, map_text, written
from weftline.llm._words import Words

BUCKETS, LONGEST = 10_000, 3
#: Texts with fewer words are not drawn.
MIN_WORDS = 20
PERCENT, SEED = 5, 42
DIGIT = 16

_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1)).astype(np.uint32)
    return t


class Crc:
    """CRC-32 registers of many texts side by side."""

    #: Texts of at most so many bytes are handled side by side.
    SHORT = 64

    def __init__(self):
        self.byte = _crc_table()
        one = np.arange(256, dtype=np.uint32)
        zero = [np.stack([one << np.uint32(8 * j) for j in range(4)])]
        for _ in range(self.SHORT + 1):
            zero.append(self._next(zero[-1]))
        #: What so many zero bytes make of each byte of a register.
        self.zeros = np.stack(zero)
        self.doubled = [self.zeros[self.SHORT]]

    def _next(self, r: np.ndarray) -> np.ndarray:
        return (r >> np.uint32(8)) ^ self.byte[r & np.uint32(255)]

    @staticmethod
    def _through(table, r: np.ndarray, *at) -> np.ndarray:
        parts = [(r >> np.uint32(8 * j)) & np.uint32(255) for j in range(4)]
        return reduce(np.bitwise_xor, [table[(*at, j, p)] for j, p in enumerate(parts)])

    def shifted(self, r: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Registers after n zero bytes."""
        out = self._through(self.zeros, r, n % self.SHORT)
        more = n // self.SHORT
        k = 0
        while (more >> k).any():
            if len(self.doubled) == k:
                self.doubled.append(self._through(self.doubled[-1], self.doubled[-1]))
            odd = np.flatnonzero((more >> k) & 1)
            out[odd] = self._through(self.doubled[k], out[odd])
            k += 1
        return out

    def bare(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Registers that began at 0, of spans of the buffer."""
        out = np.zeros(len(start), np.uint32)
        order = np.argsort(-size, kind="stable")
        long = int((size > self.SHORT).sum())
        for i in order[:long].tolist():
            out[i] = zlib.crc32(buf[start[i] : start[i] + size[i]].tobytes(), 0xFFFFFFFF) ^ 0xFFFFFFFF
        order = order[long:]
        live, begin, most = size[order], start[order], out[order]
        for j in range(int(live[0]) if len(live) else 0):
            n = int(np.searchsorted(-live, -j, "left"))  # those longer than j come first
            most[:n] = (most[:n] >> np.uint32(8)) ^ self.byte[(most[:n] ^ buf[begin[:n] + j]) & np.uint32(255)]
        out[order] = most
        return out


_crc: list[Crc] = []


def features(buf: np.ndarray, off: np.ndarray, buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(words a document, for each length of runs their (documents, buckets))."""
    if not _crc:
        _crc.append(Crc())
    crc, words = _crc[0], Words(buf, off)
    size, left = words.end - words.start, words.left()
    bare = crc.bare(words.low, words.start, size)
    spaced = crc.shifted(np.full(len(size), crc.byte[0x20]), size) ^ bare
    register = crc.shifted(np.full(len(size), _ONES), size) ^ bare
    out = []
    for n in range(1, longest + 1):
        first = np.flatnonzero(left >= n)
        if n > 1:
            register = crc.shifted(register[: len(first)], size[first + n - 1] + 1) ^ spaced[first + n - 1]
        out.append((words.doc[first], ((register ^ _ONES) % np.uint32(buckets)).astype(np.int64)))
        following = np.flatnonzero(left[first] > n)
        register = register[following]
    return words.count, out


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of the column `text` fall into each bucket; a task sends one number a bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, buf, off in chunks(b.column(0)):
                for _, at in features(buf, off, buckets, longest)[1]:
                    total += np.bincount(at, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in map_text(texts, run, T.StructType([T.StructField("bucket", T.LongType()), T.StructField("n", T.LongType())]), "text").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of how much likelier the target makes each bucket, rounded down; a count of one is added to each."""
    n = len(source)
    all_source, all_target = float(source.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1) * all_source / ((s + 1) * all_target))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """_row, doc_id, n_words, n_features and weight of every row; `_row` holds once the table is written."""
    schema = T.StructType([T.StructField("_row", T.LongType()), docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for lo, hi, buf, off in chunks(b.column(1)):
                count, found = features(buf, off, len(gain), longest)
                n, weight = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                for doc, at in found:
                    n += np.bincount(doc, minlength=hi - lo)
                    weight += np.bincount(doc, gain[at], hi - lo).astype(np.int64)  # whole numbers below 2 ** 53
                yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(hi - lo)), b.column(0)[lo:hi], *map(pa.array, (count, n, weight))], schema.names)
                row += hi - lo

    return map_text(docs, run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A thousand times a Gumbel number seeded by the id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def radix_cut(rows: DataFrame, key: list[Column], k: int) -> Column:
    """Whether a row's key is among the k least (all rows of one key that is cut through, are).

    `key` holds numbers, the most significant first; 16 bits of one of them are
    counted a round, from the highest bit in which its values differ.
    """
    if k <= 0:
        return F.lit(False)
    ends = rows.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(key) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    digits = []
    for i, c in enumerate(key):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None or hi == lo:
            continue
        # Distances from the least value; of longs too far apart for one, the halves one after the other.
        halves = [(c, lo, hi)] if hi - lo < 1 << 63 else [(F.shiftright(c, 32), lo >> 32, hi >> 32), (c.bitwiseAND(F.lit((1 << 32) - 1)), 0, (1 << 32) - 1)]
        for part, least, most in halves:
            top = (most - least).bit_length() - 1
            digits += [F.shiftright(part - F.lit(least), shift).bitwiseAND(F.lit((1 << DIGIT) - 1)) for shift in range(top - top % DIGIT, -1, -DIGIT)]
    same, found = F.lit(True), []
    for d in digits:
        counts = sorted((r["d"], r["count"]) for r in rows.filter(same).groupBy(d.alias("d")).count().collect())
        for value, n in counts:
            if k <= n:
                break
            k -= n
        found.append((d, value))
        same = same & (d == F.lit(value))
        if k == n:  # the digits found so far part the rows exactly
            break
    out = F.lit(True)
    for d, value in reversed(found):
        out = (d < value) | ((d == value) & out)
    return out


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """`rows` with their rank 1, 2, 3... by `order`: sorted by ranges, numbered within a range, after the rows of earlier ranges."""
    dealt = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "drawn")
    parts = dealt.groupBy("_part").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first")).orderBy("first").collect()  # one row a partition
    spark, before = rows.sparkSession, np.cumsum([0, *[p["n"] for p in parts]]).tolist()
    offsets = spark.createDataFrame([(p["_part"], b) for p, b in zip(parts, before, strict=False)], "_part int, _before long")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.join(F.broadcast(offsets), "_part").withColumn(name, within + F.col("_before")).drop("_part", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, min_words: int = MIN_WORDS, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; `rank` is null where the row is not drawn."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    scored = weights(docs, gain, longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = written(scored, "scored")
    able = scored.filter(F.col("n_words") >= min_words)
    k = percent * able.count() // 100
    key = [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("n_features"), F.col("_row")]
    drawn = (F.col("n_words") >= min_words) & radix_cut(able, key, k)
    columns = ["doc_id", "n_features", "weight", "score"]
    first = ranked(scored.filter(drawn), key)
    return first.select(*columns, F.col("rank").cast("long").alias("rank")).unionByName(scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
