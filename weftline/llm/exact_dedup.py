"""Exact dedup: two-pass Bloom filtering, in DataFrame functions alone.

Pass 1 hashes every text once.  A row's hash is one slot of a Bloom filter of
at least `bits_per_row` bits a row; a task's filter travels sparsely, as the
slots it sets and how often, eight bytes each before compression, and merged
it gives a second filter: the bitmap of the slots that two rows or more set.
Pass 2 tests each row against that bitmap.  Only rows whose slot is in it can
repeat (of the others about one in twenty is by chance); only they are
shuffled, and all others pass straight through.

The bitmap takes two bytes a row.  It is tested in pieces of 32 MB, each
broadcast to the digests of its range of slots, which is one piece for 16
million rows.  Past ROUNDS pieces, half a billion rows, the filter would cost
more than it saves and all digests (not their documents) are shuffled.
Texts are never shuffled to find out whether they repeat: `dedup` marks them by
a second, bounded bitmap of the hashes that do.

Groups are aggregated before the shuffle, and the rows of groups with more
than a thousandth of all rows are joined with them where they are.

Edge cases: a null text counts as empty, and empty texts are equal to each
other; of rows that agree in text and doc_id one stays, in `dedup` the one
with the least hash of all its columns; a null doc_id sorts after every other;
an empty table gives an empty result; extra columns, of any name, are kept by
`dedup` and never read by the filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm._bitmaps import BUCKET_BITS, MOST, bitmaps, filter_bits, join_groups, sifted, slot, tested
from weftline.llm._text import documents, whole_row, written

#: The white space of the contract, as a Java and RE2 character class.
SPACE = r"[\x20\x09-\x0D]+"
BITS_PER_ROW = 16
#: Pieces in which the bitmap is tested.
ROUNDS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def possibly_repeated(digests: DataFrame, n: int, bits_per_row: int = BITS_PER_ROW, most: int = MOST) -> DataFrame:
    """The `n` rows of `digests` with `_maybe`: whether two rows or more set the Bloom slot of a row's `_h`.

    A row whose digest repeats always has `_maybe`.  At most `most` slots are broadcast at once.
    """
    bits = filter_bits(n, bits_per_row)
    pieces = max(1, bits // most)
    if pieces > ROUNDS:
        return digests.withColumn("_maybe", F.lit(True))
    at = slot(F.col("_h"), bits)
    twice = digests.groupBy(at.alias("_slot")).count().filter("count > 1")
    filled = written(bitmaps(twice), "slots_set_twice")
    if pieces == 1:
        return tested(digests, "_h", bits, F.broadcast(filled))
    wide = most.bit_length() - 1
    ranges = [tested(digests.filter(F.shiftright(at, wide) == r), "_h", bits, F.broadcast(filled.filter(F.shiftright("_bucket", wide - BUCKET_BITS) == r))) for r in range(pieces)]
    return reduce(DataFrame.unionByName, ranges)


def classes(docs: DataFrame, bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; see the module for edge cases."""
    sha = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    digests = docs.select("doc_id", sha.alias("text_sha256")).withColumn("_h", F.xxhash64("text_sha256"))
    digests = written(digests, "digests")
    n = digests.count()
    marked = possibly_repeated(digests, n, bits_per_row)
    single = marked.filter(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    # Rows that agree in doc_id too are counted together, so that one of them stays.
    maybe = written(marked.filter("_maybe").groupBy("text_sha256", "doc_id").agg(F.count("*").alias("_n")), "possibly_repeated")
    groups = written(maybe.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("_n").alias("_size")), "groups")
    rows = join_groups(maybe, groups, ["text_sha256"], n).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    return single.unionByName(rows.select("doc_id", "keep_id", F.col("_size").alias("group_size"), kept.alias("kept"), "text_sha256"))


def dedup(docs: DataFrame, bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows that cannot repeat are not shuffled.  The others are reduced to one
    row for each digest and task before they are, so a hot group never meets in
    one task.
    """
    text = normalised(F.col("text"))
    hashes = [F.xxhash64(F.lit(1), text).alias("_h"), F.xxhash64(F.lit(2), text).alias("_h2")]
    digests = written(docs.select(*hashes), "digests")
    maybe = possibly_repeated(digests, digests.count(), bits_per_row).filter("_maybe")
    again = written(maybe.groupBy("_h", "_h2").count().filter("count > 1").select("_h"), "repeated")
    keyed = docs.select(whole_row(docs), hashes[0])
    marked = sifted(keyed, "_h", again, again.count())
    order = F.struct(F.col("_row.doc_id").isNull(), F.col("_row.doc_id"), F.xxhash64(F.to_json("_row")))
    sha = F.sha2(normalised(F.col("_row.text")).cast("binary"), 256)
    firsts = marked.filter("_maybe").groupBy(sha.alias("_sha")).agg(F.min_by("_row", order).alias("_row")).select("_row")
    return marked.filter(~F.col("_maybe")).select("_row").unionByName(firsts).select("_row.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size,
             row_number() OVER (PARTITION BY text_sha256, doc_id) AS copy
      FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size,
       (doc_id IS NOT DISTINCT FROM keep_id AND copy = 1) AS kept, text_sha256
FROM g
"""
