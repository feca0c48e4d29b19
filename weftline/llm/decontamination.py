"""Benchmark decontamination by winnowing.

Words are as in `_words`.  Of every `SPAN - K + 1` consecutive K-grams of a text
the one with the least hash is a fingerprint (of equal ones the last), so any
SPAN words that two texts share hold a fingerprint of both, at the same place.
Items of fewer than SPAN words are one fingerprint, and documents are looked
through for all runs of those lengths.

1. Items give fingerprints with the words around them, as many on each side as
   a span that holds the fingerprint reaches (SPAN - K).  A bitmap of their
   hashes (32 MB at most) goes to the tasks.
2. One pass over the documents winnows whole texts and writes the fingerprints
   that the bitmap marks, with the words around them; everything else of a text
   is left behind there.  Past its capacity the bitmap marks more of them,
   which costs a shuffle and loses nothing.
3. Fingerprints of documents are reduced to distinct surroundings before they
   are joined with those of items, so a passage in a third of all documents is
   compared once.  A hit is extended to the spans that hold it, and those that
   are spans of items count.
4. Hits go back to their documents; those of a passage that very many share
   are broadcast to where the documents are (`join_groups`).  Documents with the
   same matches share one list of items.

Grams are compared as texts and spans by SHA-256, so equal 64-bit hashes do no harm.

Edge cases: null and empty texts, and texts without a word, have no words and
are not contaminated; an item without words, or without an item_id, occurs
nowhere; items that agree in item_id are one; repeated rows, and rows without a
doc_id, are each judged; empty tables give no row, or no hit; extra columns, of
any name, are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._bitmaps import BUCKET_BITS, MOST, bitmaps, filter_bits, join_groups, slot
from weftline.llm._text import Hasher, chunks, documents, id_type, map_text, mix, written
from weftline.llm._words import Words

#: Words of the spans that are found, and of the grams that are hashed.
SPAN, K = 10, 8

#: Slots of the bitmap for each fingerprint of an item, while there is room.
SLOTS = 1 << 12

_WORDS = T.ArrayType(T.StringType())
#: Columns of a fingerprint: words of the gram, words that a span holds besides, hash, words on the left, the gram, words on the right.
_FOUND = [T.StructField("n", T.IntegerType()), T.StructField("reach", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("left", _WORDS), T.StructField("gram", T.StringType()), T.StructField("right", _WORDS)]
_ARROW = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.list_(pa.string())]


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k hashed words that begin at each word; the last k - 1 are of no use."""
    x = np.full(max(0, len(h) - k + 1), k, np.uint64)
    for j in range(k):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j])
    return x


def winnowed(x: np.ndarray, left: np.ndarray, span: int, k: int) -> np.ndarray:
    """First words of the fingerprints, given hashes of k-grams and how many words of the text are left at each word."""
    w = span - k + 1
    first = np.flatnonzero(left >= span)
    if not len(first):
        return first
    best, at = x[first], first.copy()
    for j in range(1, w):
        other = x[first + j]
        last = other <= best
        best, at = np.where(last, other, best), np.where(last, first + j, at)
    return np.unique(at)


def _fingerprints(words: Words, span: int, k: int, short: list[int]):
    """(first words, hashes, words of the gram, whether it is a whole short text) of the fingerprints, and of all runs of the sizes `short`."""
    h, left = Hasher(words.low)(words.start, words.end), words.left()
    x = grams(h, k)
    at = winnowed(x, left, span, k)
    yield at, x[at], k, False
    for n in short:
        at = np.flatnonzero(left >= n)
        yield at, grams(h, n)[at], n, True


def _rows(words: Words, at: np.ndarray, h: np.ndarray, size: int, reach: int) -> list[pa.Array]:
    """The columns of the fingerprints at these words; words on the left and right are nearest first."""
    texts = words.texts()
    begin = np.cumsum(words.count) - words.count
    lo = np.maximum(begin[words.doc[at]], at - reach)
    hi = np.minimum(begin[words.doc[at]] + words.count[words.doc[at]], at + size + reach)

    def lists(first: np.ndarray, step: int, n: np.ndarray) -> pa.Array:
        off = np.zeros(len(n) + 1, np.int32)
        np.cumsum(n, out=off[1:])
        inner = np.repeat(first - step * off[:-1], n) + step * np.arange(off[-1])
        return pa.ListArray.from_arrays(pa.array(off), texts.take(pa.array(inner)).cast(pa.string()))

    gram = lists(at, 1, np.full(len(at), size))
    numbers = [pa.array(np.full(len(at), n, np.int32)) for n in (size, reach)]
    return [*numbers, pa.array(h.view(np.int64)), lists(at - 1, -1, at - lo), pc.binary_join(gram, " "), lists(at + size, 1, hi - at - size)]


def item_fingerprints(items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """item_id, n (words of the gram), reach (words that a span holds besides), h, left, gram and right."""
    schema = T.StructType([T.StructField("item_id", id_type(items, "item_id")), *_FOUND])

    def run(batches):
        for b in batches:
            for lo, _, buf, off in chunks(b.column(1)):
                words = Words(buf, off)
                short = sorted({int(n) for n in words.count if 0 < n < span})
                for at, x, n, whole in _fingerprints(words, span, k, short):
                    if whole:
                        own = words.count[words.doc[at]] == n
                        at, x = at[own], x[own]
                    if len(at):
                        ids = b.column(0).take(pa.array(lo + words.doc[at]))
                        yield pa.RecordBatch.from_arrays([ids, *_rows(words, at, x, n, 0 if whole else span - n)], schema.names)

    return map_text(items.filter("item_id IS NOT NULL"), run, schema, "item_id", "text")


def _marked(docs: DataFrame, bits: bytes, short: list[int], span: int, k: int) -> DataFrame:
    """For every document a row with _row, doc_id and n_words, and for every fingerprint that the bitmap marks one with _row, pos and the columns of the fingerprint.

    `_row` numbers the documents of this table, which has to be written before it is used.
    """
    schema = T.StructType([T.StructField("_row", T.LongType()), docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("pos", T.LongType()), *_FOUND])
    shipped = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        table = np.frombuffer(shipped.value, np.uint8)
        mask = np.uint64(len(table) * 8 - 1)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for lo, hi, buf, off in chunks(b.column(1)):
                words = Words(buf, off)
                begin = np.cumsum(words.count) - words.count
                none = [pa.nulls(hi - lo, t) for t in (pa.int64(), *_ARROW)]
                yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(hi - lo)), b.column(0)[lo:hi], pa.array(words.count), *none], schema.names)
                for at, x, n, whole in _fingerprints(words, span, k, short):
                    place = x & mask
                    hit = (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    at, x = at[hit], x[hit]
                    if len(at):
                        doc = words.doc[at]
                        own = [pa.array(row + doc), pa.nulls(len(at), b.column(0).type), pa.nulls(len(at), pa.int64()), pa.array(at - begin[doc])]
                        yield pa.RecordBatch.from_arrays([*own, *_rows(words, at, x, n, 0 if whole else span - n)], schema.names)
                row += hi - lo

    return map_text(docs, run, schema)


def _windows() -> Column:
    """The spans around a fingerprint that hold it, each with the words it has on the left and on the right."""
    reach = F.col("reach")

    def one(i: Column) -> Column:
        there = (F.size("left") >= i) & (F.size("right") >= reach - i)
        words = F.concat_ws(" ", F.reverse(F.slice("left", F.lit(1), i)), F.col("gram"), F.slice("right", F.lit(1), reach - i))
        return F.struct(i.alias("l"), (reach - i).alias("r"), F.when(there, F.sha2(words.cast("binary"), 256)).alias("window"))

    return F.filter(F.transform(F.sequence(F.lit(0), reach), one), lambda w: w["window"].isNotNull())


def _bytes(keys: DataFrame, bits: int) -> bytes:
    """The bitmap of column `h`, 32 MB at most, on the driver."""
    table = np.zeros(bits // 8, np.uint8)
    size = 1 << (BUCKET_BITS - 3)
    for r in bitmaps(keys.select(slot(F.col("h"), bits).alias("_slot"))).collect():
        table[r["_bucket"] * size : (r["_bucket"] + 1) * size] = np.frombuffer(r["_bits"], np.uint8)
    return table.tobytes()


def occurrences(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, hits, windows) of the spans of items that occur in documents.

    Documents: _row, doc_id and n_words of every row.  Hits: _row, the words
    [begin, end) of it that lie in such spans around one fingerprint, and the
    sorted `windows` that they are.  Windows: window and item_id.
    """
    own = written(item_fingerprints(items, span, k), "item_fingerprints")
    bits = filter_bits(own.count(), SLOTS, MOST)
    short = [r["n"] for r in own.filter("reach = 0").select("n").distinct().collect()]  # fewer than SPAN numbers
    flat = written(_marked(docs, _bytes(own, bits), short, span, k), "marked")
    found = flat.filter("pos IS NOT NULL").withColumn("_at", F.sha2(F.to_json(F.struct("reach", "left", "gram", "right")), 256))
    # Each surrounding once, then the fingerprints that items have too, then their spans.
    places = found.groupBy("_at").agg(F.count("*").alias("_size"), *[F.first(f.name).alias(f.name) for f in _FOUND])
    places = places.join(own.select("h", "gram").distinct(), ["h", "gram"], "left_semi")
    windows = own.select("item_id", F.explode(_windows()).alias("w")).select("w.window", "item_id").distinct()
    windows = written(windows, "windows")
    met = places.select("_at", "_size", F.explode(_windows()).alias("w")).select("_at", "_size", "w.*").join(windows.select("window").distinct(), "window")
    met = written(met.groupBy("_at").agg(F.first("_size").alias("_size"), F.max("l").alias("l"), F.max("r").alias("r"), F.array_sort(F.collect_set("window")).alias("windows")), "met")
    hits = join_groups(found.select("_row", "pos", "n", "_at"), met, ["_at"], found.count())
    return flat.filter("pos IS NULL").select("_row", "doc_id", "n_words"), hits.select("_row", (F.col("pos") - F.col("l")).alias("begin"), (F.col("pos") + F.col("n") + F.col("r")).alias("end"), "windows"), windows


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row; see the module for edge cases."""
    rows, hits, windows = occurrences(docs, items, span, k)
    before = Window.partitionBy("_row").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.groupBy("_row", "begin").agg(F.max("end").alias("end"))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.col("begin"))))
    n_hit = spans.select("_row", fresh.alias("fresh")).groupBy("_row").agg(F.sum("fresh").alias("n_hit"))
    # Documents that hold the same windows share one list of items.
    sets = hits.groupBy("_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("windows")))).alias("windows"))
    sets = written(sets.withColumn("_set", F.sha2(F.array_join("windows", ","), 256)).join(n_hit, "_row"), "window_sets")
    kinds = sets.groupBy("_set").agg(F.count("*").alias("_size"), F.first("windows").alias("windows"))
    ids = kinds.select("_set", "_size", F.explode("windows").alias("window")).join(windows, "window")
    ids = ids.groupBy("_set").agg(F.first("_size").alias("_size"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    lists = written(ids.select("_set", "_size", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")), "item_lists")
    hit = join_groups(sets.select("_row", "n_hit", "_set"), lists, ["_set"], sets.count()).select("_row", "n_hit", "n_items", "items_sha256")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return rows.join(hit, "_row", "left").select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH lowered AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sizes AS (SELECT DISTINCT least(10, len(words)) AS n FROM items WHERE len(words) > 0),
wanted AS (SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS span
           FROM (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM items WHERE len(words) > 0)),
spans AS (SELECT row_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS span
          FROM (SELECT row_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM lowered, sizes WHERE len(words) >= n)),
met AS (SELECT row_id, i, n, item_id FROM spans JOIN wanted USING (n, span)),
hit AS (SELECT row_id, count(DISTINCT w) AS n_hit FROM (SELECT DISTINCT row_id, unnest(range(i, i + n)) AS w FROM met) GROUP BY row_id),
listed AS (SELECT row_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
           FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY row_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hit USING (row_id) LEFT JOIN listed USING (row_id)
"""
