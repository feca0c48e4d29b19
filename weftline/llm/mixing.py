"""Mixing sources to target weights: Sainte-Lague apportionment, in DataFrame functions alone.

1. Sizes: words of every text, once, into a written table (doc_id, source, size).
2. Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and
   share `share` of all words; a target stops at `laps` times its source's
   size and the excess is reshared by weight.  That is water filling, so one
   pass over the sources in the order of their cap per weight finds the level.
3. Quotas: blocks of `block` words go to sources by the highest quotients
   target / (2 k + 1), then, within a source, to its shards by the quotients of
   the shards' sizes.  All quotients above a level that certainly wins are
   counted in closed form; only the few near the cut are ranked, so the work
   grows with the number of parties, not of blocks.
4. Selection: a shard's documents stand in the order of a seeded hash; its
   quota of blocks is taken from the start of that line, at most `laps` times
   round.  A document's `taken` is what the blocks cover of it.

Shards hold about `shard` words, or a part in `SHARDS` of all words if that is
more, so a source with a third of all rows is many shards, each a window of
small rows, and no more than `SHARDS` shards and sources are ranked at once.
Tables of sources and shards are aggregates; Spark broadcasts them where their
size is under its threshold and otherwise merges with skew splitting.

`mix` needs no join of documents with documents: what a shard takes is a stretch
of its line, so the shard's cut alone, one small row, tells of each document
whether it comes and how often.  Texts are shuffled only if the table of cuts
is too large to broadcast.

Edge cases: a null text has size 0; a null source is a source of its own, the
last; documents of size 0 take 0; a corpus without words has targets of 0;
rows that agree in doc_id and size share one place on the line, in an order
that does not change any value; in `mix`, rows that agree in doc_id and text
come alike; extra columns, of any name, are kept by `mix`; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.llm._text import documents, whole_row, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LAPS = 2
BLOCK = 16
SHARD = 1 << 18
SHARDS = 1 << 16
SEED = "mix-1"


def _targets(sources: DataFrame, share: float, laps: int) -> DataFrame:
    """source, source_size, target; one row a source comes in and goes out."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int"))
    s = sources.withColumn("_w", weight).withColumn("_cap", F.lit(float(laps)) * F.col("source_size"))
    by = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    upto = by.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    # The level if this source and all after it are below their caps.
    s = s.withColumns({"_total": F.sum("source_size").over(whole), "_filled": F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)), "_open": F.sum("_w").over(by.rowsBetween(0, W.unboundedFollowing))})
    s = s.withColumn("_level", (F.lit(share) * F.col("_total") - F.col("_filled")) / F.col("_open"))
    s = s.withColumn("_cut", F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))).over(whole))
    return s.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_cut") * F.col("_w"), F.col("_cap"))).alias("target"))


def sainte_lague(parties: DataFrame, key: list[str], weight: str, seats: str, within: list[str]) -> DataFrame:
    """Adds `quota`: the seats each party gets by the highest quotients weight / (2 k + 1).

    `seats` is the number to share among the parties that agree in `within`.
    A party gets round(weight / d) for a divisor d; with n parties, d lies
    between W / (seats + n / 2) and W / (seats - n / 2).  Quotients above that
    span win for certain, and only those inside are ranked (ties: by `key`).
    """
    group = W.partitionBy(*within)
    p = parties.withColumns({"_W": F.sum(weight).over(group).cast("double"), "_n": F.count(F.lit(1)).over(group).cast("double")})
    per = F.col(weight) / F.col("_W")
    low = F.when((F.col("_W") > 0) & (F.col(seats) > F.col("_n") / 2), F.floor(per * (F.col(seats) - F.col("_n") / 2) + 0.5) - 1).otherwise(F.lit(0))
    high = F.when(F.col("_W") > 0, F.ceil(per * (F.col(seats) + F.col("_n") / 2) + 0.5) + 1).otherwise(F.lit(0))
    p = p.withColumns({"_low": F.greatest(low, F.lit(0)).cast("long"), "_high": high.cast("long")})
    p = p.withColumn("_left", F.col(seats) - F.sum("_low").over(group))
    near = p.filter(F.col("_high") > F.col("_low")).withColumn("_k", F.explode(F.sequence("_low", F.col("_high") - 1)))
    near = near.withColumn("_q", F.col(weight) / (2 * F.col("_k") + 1))
    order = W.partitionBy(*within).orderBy(F.col("_q").desc(), *[F.col(k).asc_nulls_last() for k in key], "_k")
    won = near.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= F.col("_left")).groupBy(*key).agg(F.count("*").alias("_won"))
    won = won.select(*[F.col(k).alias(f"_{k}") for k in key], "_won")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    on = same[0]
    for c in same[1:]:
        on = on & c
    out = p.join(won, on, "left").withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0)))
    return out.select(*parties.columns, "quota")


def sizes(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source and size, the words of its text, of every row."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *more)


def _place(seed: str, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def _shard_of(place: str, shards: str) -> Column:
    return F.pmod(F.conv(F.substring(place, 17, 12), 16, 10).cast("long"), F.col(shards))


def _plan(sized: DataFrame, share: float, laps: int, block: int, shard: int, seed: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized with _place, _source, _shard and its source's columns; quotas by _source; by _s and _i: _shard_size and _words to take)."""
    targets = _targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, laps)
    whole = W.partitionBy()
    seats = targets.withColumns({"_seats": F.round(F.sum("target").over(whole) / block).cast("long"), "_span": F.greatest(F.lit(shard), F.ceil(F.sum("source_size").over(whole) / SHARDS)), "_all": F.lit(0)})
    quotas = sainte_lague(seats, ["source"], "target", "_seats", ["_all"])
    quotas = quotas.select(F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("_blocks"), F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.col("_span"))).cast("long").alias("_shards"))
    quotas = written(quotas, "quotas")
    rows = sized.withColumn("_place", _place(seed, F.col("doc_id"))).join(quotas, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_shard", _shard_of("_place", "_shards"))
    shards = rows.groupBy("_source", "_shard").agg(F.sum("size").alias("_shard_size"), F.first("_blocks").alias("_blocks"))
    shards = sainte_lague(shards, ["_source", "_shard"], "_shard_size", "_blocks", ["_source"])
    shards = shards.select(F.col("_source").alias("_s"), F.col("_shard").alias("_i"), "_shard_size", F.least(F.col("quota") * block, F.col("_shard_size") * laps).alias("_words"))
    return rows, quotas, shards


def _lined(rows: DataFrame, shards: DataFrame, *order: str) -> DataFrame:
    """`rows` with their shard's columns and `_start`, the words before them on its line."""
    rows = rows.join(shards, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_i")))
    line = W.partitionBy("_source", "_shard").orderBy("_place", *order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("_start", F.coalesce(F.sum("size").over(line), F.lit(0)))


def mix_sizes(sized: DataFrame, share: float = SHARE, laps: int = LAPS, block: int = BLOCK, shard: int = SHARD, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and taken for every row of (doc_id, source, size)."""
    rows, _, shards = _plan(written(sized.select("doc_id", "source", "size"), "sizes"), share, laps, block, shard, seed)
    rows = _lined(rows, shards, "doc_id", "size")
    zero = F.lit(0).cast("long")
    laps_taken = [F.greatest(zero, F.least(F.col("size"), F.col("_words") - i * F.col("_shard_size") - F.col("_start"))) for i in range(laps)]
    taken = laps_taken[0]
    for x in laps_taken[1:]:
        taken = taken + x
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix(docs: DataFrame, share: float = SHARE, laps: int = LAPS, block: int = BLOCK, shard: int = SHARD, seed: str = SEED) -> DataFrame:
    """The mixture as rows of `docs`: a document comes as often as its taken words, rounded, are whole laps of it.

    Documents of size 0 and those that take under half of their words go.  Each
    shard's words are so met up to half a document at its one cut.
    """
    sized = written(sizes(docs, F.xxhash64("text").alias("_text")), "sizes")
    rows, quotas, shards = _plan(sized, share, laps, block, shard, seed)
    rows = _lined(rows, shards, "_text").filter("size > 0")
    # The line once round `_laps` times, and `_rest` words more: up to the last document that these cover by half.
    most = F.floor(F.col("_words") / F.col("_shard_size"))
    rest = F.col("_words") - most * F.col("_shard_size")
    last = F.max(F.when(2 * F.col("_start") + F.col("size") <= 2 * rest, F.struct("_place", "_text")))
    cuts = written(rows.groupBy("_s", "_i").agg(F.first(most).alias("_laps"), last.alias("_last")), "cuts")
    keyed = docs.select(whole_row(docs))
    keyed = keyed.filter(F.col("_row.text").rlike(WORD)).withColumn("_place", _place(seed, F.col("_row.doc_id")))
    keyed = keyed.join(quotas.select("_source", "_shards"), F.col("_row.source").eqNullSafe(F.col("_source"))).withColumn("_shard", _shard_of("_place", "_shards"))
    keyed = keyed.join(cuts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_i")))
    before = (F.col("_place") < F.col("_last._place")) | ((F.col("_place") == F.col("_last._place")) & (F.xxhash64("_row.text") <= F.col("_last._text")))
    copies = F.col("_laps") + F.coalesce(before.cast("long"), F.lit(0))
    return keyed.withColumn("_copy", F.explode(F.sequence(F.lit(0), copies.cast("int")))).filter("_copy > 0").select("_row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(sizes(documents(spark, sf_dir))).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY source),
c AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM s),
f AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS filled,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM c),
l AS (SELECT *, (1.5::DOUBLE * total - filled) / open AS level FROM f),
m AS (SELECT *, max(CASE WHEN level * w <= cap THEN level END) OVER () AS cut FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(cut * w, cap)) AS target FROM m),
b AS (SELECT *, CAST(round(sum(target) OVER () / 16) AS BIGINT) AS seats,
             greatest(262144.0::DOUBLE, ceil(sum(source_size) OVER () / 65536.0::DOUBLE)) AS span FROM t),
q1 AS (SELECT source, target, seats, unnest(range(0, CAST(ceil(target / 16) AS BIGINT) + 8)) AS k FROM b),
r1 AS (SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS r, seats FROM q1),
n1 AS (SELECT source, count(*) AS blocks FROM r1 WHERE r <= seats GROUP BY source),
src AS (SELECT b.source, source_size, target, coalesce(blocks, 0) AS blocks, greatest(1, CAST(ceil(source_size / span) AS BIGINT)) AS shards
        FROM b LEFT JOIN n1 ON b.source IS NOT DISTINCT FROM n1.source),
e AS (SELECT d.*, source_size, target, blocks, CAST(('0x' || substr(place, 17, 12)) AS BIGINT) % shards AS shard
      FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source),
sh AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(blocks) AS blocks FROM e GROUP BY source, shard),
q2 AS (SELECT sh.*, unnest(range(0, blocks + 1)) AS k FROM sh WHERE shard_size > 0),
r2 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS r FROM q2),
n2 AS (SELECT source, shard, count(*) AS quota FROM r2 WHERE r <= blocks GROUP BY source, shard),
u AS (SELECT sh.source, sh.shard, shard_size, least(coalesce(quota, 0) * 16, shard_size * 2) AS words
      FROM sh LEFT JOIN n2 ON sh.source IS NOT DISTINCT FROM n2.source AND sh.shard = n2.shard),
p AS (SELECT e.doc_id, e.size, e.source_size, e.target, u.shard_size, u.words,
             coalesce(sum(e.size) OVER (PARTITION BY e.source, e.shard ORDER BY e.place, e.doc_id, e.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM e JOIN u ON e.source IS NOT DISTINCT FROM u.source AND e.shard = u.shard)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, words - start)) + greatest(0, least(size, words - shard_size - start)) AS BIGINT) AS taken
FROM p
"""
