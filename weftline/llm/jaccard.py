"""N-gram Jaccard join by a token-group matrix.

Exact, over sets of word shingles; no pair of sets at or above the threshold
is lost (up to collisions of 48-bit hashes within a pair of sets).

1. Classes: documents with the same set are one class; its least doc_id stands
   for it.  Copies are counted in the aggregation, never paired.
2. Tokens: by pigeonhole, two linked sets share COMMON of the first
   n - ceil(t n) + COMMON tokens of each, in any one order of all tokens.  The
   order is rare first, by a fixed-size count sketch over all documents, so
   that passages which many documents share come last.  Tokens are kept apart
   by size class, since linked sets are of like sizes.
3. Groups: a class joins the group named by its size, roughly, and the least
   token hash it shares with another class, or, if more classes than a group
   holds share one, that token.  Similar documents so meet in one group.  A
   name larger than `group` is dealt into blocks of about that many.  One larger
   than `SETTLED` groups is settled first: each block is opened once for its own
   members and a few of the whole name, and classes that this links become one
   settled group, never compared within.  So a class is compared with a bounded
   number of others of its name, however many there are.
4. Token-group matrix: one row for each (token, group) of those first tokens,
   never for (token, document), with the sizes in the group and the most
   tokens that a member has from this one on.  Groups that share COMMON tokens,
   at sizes and rests that allow the threshold, are candidates; the documents
   of the later one become queries of the earlier, in blocks again.
5. In a task, with one group and one block of queries: the group's whole token
   union is formed, each query's overlap with it is bounded (and its size), and
   only if some query still can reach the threshold is the group opened; then
   the overlaps are one matrix product over the tokens that two sets share.
   A task emits the links as stars, at most one a document.  Two settled groups
   of one component are not compared.
6. Components of the links, then one row per document.

Edge cases: a null or empty text, or one without words, has the empty set and
is linked with nothing, not even its like; fewer words than `k` form one
shingle; rows with the same doc_id are one node, linked through any of their
texts; a null doc_id is linked with nothing and its component_id is null;
long texts are whole; extra columns are never read; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._bitmaps import join_groups, sifted
from weftline.llm._text import LOWER, Hasher, chunks, distinct, documents, map_text, mix, shingles, whole_row, written
from weftline.llm.components import components

GROUP = 256
#: Tokens that a block holds at most, unless it is a single set; blocks of large sets have fewer of them.
TOKENS = 1 << 23
#: About how many classes of a name larger than a group are compared with all of it first; they save work only.
PIVOTS = 16
#: Names of more groups than this are settled first; within smaller ones each block is compared with each other.
SETTLED = 8
#: Tokens that two linked sets must share among their firsts; more of them keep chance pairs out.
COMMON = 4
#: Bytes of a token's hash that are compared in the end.
TOKEN_BYTES = 6
#: Ratio of the sizes that a size class spans.
CLASS = 1.5
SKETCH_BITS = 20


def _sets(col: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, document, hash): the distinct shingles of runs of rows."""
    for lo, hi, buf, off in chunks(col):
        low = LOWER[buf]
        yield lo, hi, *distinct(*shingles(low, off, k, Hasher(low)))


def count_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """log2 of the document counts of shingles, in 2 ** SKETCH_BITS slots of one byte.

    Every document is counted.  A task sends only the slots that stand out of
    its own, so the driver gets at most one row a slot.  The sketch only orders
    tokens: a slot that is too high or too low costs time, never a link.
    """
    size = 1 << SKETCH_BITS

    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for _, _, _, h in _sets(b.column(0), k):
                total += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
        mean = total.mean()
        high = np.flatnonzero(total > mean + 6 * np.sqrt(mean) + 3)
        yield pa.RecordBatch.from_arrays([pa.array(high.astype(np.int32)), pa.array(total[high])], ["slot", "n"])

    rows = map_text(docs, count, "slot int, n long", "text").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.uint8)
    if rows.num_rows:
        out[rows.column("slot").to_numpy()] = np.log2(rows.column("n").to_numpy() + 1).astype(np.uint8)
    return out


def signatures(docs: DataFrame, k: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """doc_id, n (shingles), s1, s2 (a 128-bit digest of the set), firsts (its rarest tokens, enough for the join)."""
    rank = docs.sparkSession.sparkContext.broadcast(sketch)

    def sign(batches):
        for b in batches:
            n = np.zeros(len(b), np.int64)
            sums = np.zeros((2, len(b)), np.uint64)
            firsts, ends = [], []
            for lo, hi, doc, h in _sets(b.column(1), k):
                count = np.bincount(doc, minlength=hi - lo)
                n[lo:hi] = count
                start = np.cumsum(count) - count
                full = count > 0
                for i in (0, 1):
                    if len(h):
                        sums[i, lo:hi][full] = np.add.reduceat(mix(h + np.uint64(i * 0x632BE59BD9B4E019 + 1)), start[full])
                keep = np.where(full, np.minimum(count, count - (-(-percent * count // 100)) + COMMON), 0)
                order = np.lexsort((h, rank.value[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], doc))
                at = np.arange(len(h)) - start[doc]
                firsts.append(h[order][at < keep[doc]])
                ends.append(keep)
            off = np.concatenate([[0], np.cumsum(np.concatenate(ends))]) if ends else np.zeros(1)
            tokens = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array((np.concatenate(firsts) if firsts else np.zeros(0, np.uint64)).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), tokens], ["doc_id", "n", "s1", "s2", "firsts"])

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()), T.StructField("firsts", T.ArrayType(T.LongType()))])
    return map_text(docs, sign, schema)


def _bloom(keys: DataFrame, most: int = 26) -> np.ndarray:
    """A Bloom filter of the long column `key`, of at most 2 ** most bits (8 MB), gathered as words that are not zero.

    Past its capacity it lets more pass, which costs time and changes nothing.
    """
    bits = min(most, max(16, math.ceil(math.log2(max(1, keys.count()) * 12))))

    def place(batches):
        for b in batches:
            at = np.unique(np.concatenate(_places(b.column(0).to_numpy(), bits)))
            word, first = np.unique(at >> 6, return_index=True)
            ones = np.uint64(1) << (at & 63).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.bitwise_or.reduceat(ones, first).view(np.int64) if len(at) else np.zeros(0, np.int64))], ["word", "w"])

    words = map_text(keys, place, "word long, w long", "key").groupBy("word").agg(F.bit_or("w").alias("w")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("w").to_numpy().view(np.uint64)
    return out


def _places(key: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(key.view(np.uint64) + np.uint64(1))
    low = np.uint64((1 << bits) - 1)
    return [((h >> np.uint64(s)) & low).astype(np.int64) for s in (0, 64 - bits)] + [(mix(h) & low).astype(np.int64)]


def _in_bloom(filled: np.ndarray, key: np.ndarray) -> np.ndarray:
    ok = np.ones(len(key), bool)
    for at in _places(np.ascontiguousarray(key), int(np.log2(len(filled))) + 6):
        ok &= ((filled[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    return ok


def _keys(sigs: DataFrame, percent: int, bloom: np.ndarray | None = None) -> DataFrame:
    """The firsts of every set, a row each: doc_id, token (with its size class), n, class, rest.

    A pair meets in the size class of its smaller set; a set that may be the
    larger one of a pair stands in that class too.  `rest` is how many tokens
    the set has from this one on.  Without a filter only the tokens come back.
    """
    span = math.log(max(CLASS, 100 / percent))
    shared = sigs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        for b in batches:
            n = b.column(1).to_numpy()
            lists = b.column(2)
            tokens = lists.flatten().to_numpy().view(np.uint64)
            count = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), count)
            at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            own = np.floor(np.log(n) / span).astype(np.int64)
            low = np.floor(np.log(-(-percent * n // 100)) / span).astype(np.int64)
            for classes, some in ((own, None), (low, low != own)):
                r, t, a = (row, tokens, at) if some is None else (x[some[row]] for x in (row, tokens, at))
                key = mix(t + classes[r].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                if shared.value is None:
                    yield pa.RecordBatch.from_arrays([pa.array(key)], ["token"])
                    continue
                ok = _in_bloom(shared.value, key)
                r, key, a = r[ok], key[ok], a[ok]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(r)), pa.array(key), pa.array(n[r]), pa.array(classes[r]), pa.array(n[r] - a)], ["doc_id", "token", "n", "class", "rest"])

    long = lambda name: T.StructField(name, T.LongType())
    schema = T.StructType([long("token")] if bloom is None else [sigs.schema["doc_id"], long("token"), long("n"), long("class"), long("rest")])
    return map_text(sigs, run, schema, "doc_id", "n", "firsts")


def _full_sets(docs: DataFrame, k: int, wanted: DataFrame) -> DataFrame:
    """doc_id, tokens: the whole sets, as the first TOKEN_BYTES bytes of the hashes in order, of the doc_ids in `wanted` and a few more.

    Documents are sifted where they are read, so the texts of the others are not shuffled.
    """
    key = F.xxhash64("doc_id").alias("key")
    keyed = docs.select("doc_id", "text", key)
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(wanted.select(key)))

    def form(batches):
        for b in batches:
            b = b.filter(pa.array(_in_bloom(shared.value, b.column(2).to_numpy())))
            out = []
            for lo, hi, doc, h in _sets(b.column(1), k):
                ends = np.searchsorted(doc, np.arange(hi - lo + 1))
                short = h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]
                out += [short[ends[i] : ends[i + 1]].tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "tokens"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("tokens", T.BinaryType())])
    return map_text(keyed, form, schema, *keyed.columns)


def _long(tokens) -> np.ndarray:
    raw = np.frombuffer(tokens, np.uint8).reshape(-1, TOKEN_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 8 - TOKEN_BYTES :] = raw
    return out.view(">u8")[:, 0].astype(np.uint64)


def open_group(members: list[np.ndarray], queries: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a, b) of linked sets: members with members (a < b), then members with queries (b counts on).

    Queries whose overlap with the members' token union cannot reach the
    threshold, and those too small or too large, are never compared.
    """
    if not members:  # a block that the hash leaves empty
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m, size = len(members), np.array([len(x) for x in (*members, *queries)], np.int64)
    live = list(range(m))
    if queries:
        union = np.unique(np.concatenate(members))
        small, large = size[:m].min(), size[:m].max()
        for j, q in enumerate(queries):
            at = np.searchsorted(union, q)
            at[at == len(union)] = 0
            over = int((union[at] == q).sum())
            if 100 * over >= percent * len(q) and 100 * small <= (10000 * len(q)) // percent + 100 and percent * len(q) <= 100 * large:
                live.append(m + j)
    sets = [members[i] if i < m else queries[i - m] for i in live]
    if len(sets) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[token] > 1
    number = np.cumsum(times > 1) - 1
    own, token = own[shared], number[token[shared]]
    over = np.zeros((m, len(sets)), np.float32)
    order = np.argsort(token, kind="stable")
    own, token = own[order], token[order]
    width = 4096
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        i, j = np.searchsorted(token, (lo, lo + width))
        a = np.zeros((len(sets), width), np.float32)
        a[own[i:j], token[i:j] - lo] = 1
        over += a[:m] @ a.T
    sz = size[live]
    inter = over.astype(np.int64)
    linked = 100 * inter >= percent * (sz[:m, None] + sz[None, :] - inter)
    linked[:, :m] &= np.triu(np.ones((m, m), bool), 1)
    a, b = np.nonzero(linked)
    return a, np.array(live)[b]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least reachable index of each of n nodes."""
    root = np.arange(n)
    while len(a):
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            break
        root = least
    return root


def _common(low: Column, low2: Column, high: Column, percent: int) -> Column:
    """How many of their firsts two linked sets share at least, of sizes from low and low2 up to high.

    Of the tokens they have in common, in order, the j-th stands at most the
    number of uncommon ones behind j.  Sets of sizes a <= b that share o tokens
    have a - o and b - o of these, so all but b - o of the longer set's firsts
    must be met; o is at least t / (1 + t) (a + b).
    """
    t = percent / 100
    spare = F.greatest(F.lit(0.0), t / (1 + t) * (F.least(low, low2) - t * high))
    return F.least(F.floor(spare) + COMMON - 1, F.floor(t / (1 + t) * (low + low2)))


def _opened(docs: DataFrame, k: int, percent: int, rows: DataFrame) -> DataFrame:
    """(src, dst): the links in each task's group, of `rows` (doc_id, g, part, member), as stars on the least id.

    Members of a group are compared with each other in part 0, and with the
    part's queries in each.  A document that is both gives a link to itself.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("src", kind), T.StructField("dst", kind)])

    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by([("member", "descending"), ("doc_id", "ascending")])
        sets = [_long(x.as_buffer()) for x in table.column("tokens")]
        m = pc.sum(table.column("member")).as_py()
        a, b = open_group(sets[:m], sets[m:], percent)
        if table.column("part")[0].as_py():  # the members were compared with each other in part 0
            a, b = a[b >= m], b[b >= m]
        root = _forest(len(sets), a, b)
        at = np.flatnonzero(root != np.arange(len(sets)))
        ids = table.column("doc_id")
        return pa.table({"src": ids.take(pa.array(root[at])), "dst": ids.take(pa.array(at))})

    places = written(rows, "places")
    placed = _full_sets(docs, k, places.select("doc_id").distinct()).join(places, "doc_id").select("doc_id", "tokens", "g", "part", "member")
    return placed.groupBy("g", "part").applyInArrow(find, schema)


def _fit(group: int, most: Column) -> Column:
    """How many sets of at most `most` tokens a block holds."""
    return F.greatest(F.lit(1), F.least(F.lit(group), F.floor(F.lit(TOKENS) / most))).cast("long")


def _rows_of() -> list[Column]:
    """Aggregates of the token rows of a group: sizes and rests, and how many documents have them."""
    return [F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("rest").alias("rest"), F.count("*").alias("docs")]


def _busy(matrix: DataFrame, percent: int) -> DataFrame:
    """The groups in which enough tokens are in two members for a link among them."""
    return matrix.filter("docs > 1").groupBy("g", "class").agg(F.count("*").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter(F.col("c") >= _common(F.col("lo"), F.col("lo"), F.col("hi"), percent)).select("g").distinct()


def _settled(docs: DataFrame, k: int, percent: int, tokens: DataFrame, large: DataFrame, group: int) -> tuple[DataFrame, DataFrame]:
    """Deals the classes of names of very many classes, by what is linked among them already.

    Each block of such a name is opened for its own members and for about
    PIVOTS of the whole name, so the work grows with the name, not with its
    square.  Classes of one name that are then of one component, if they are
    many, form one settled group, which needs no comparison within; the others
    are dealt into blocks anew.  Gives (doc_id, unit, root) with a root for settled
    groups alone, and the links found.
    """
    own = tokens.join(large, "name").select("doc_id", "name", "classes", "fit").distinct()
    own = written(own.withColumn("b", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("classes") / F.col("fit")))), "large_names")
    block = F.xxhash64("name", "b").alias("g")
    matrix = tokens.join(own.select("doc_id", block), "doc_id").groupBy("token", "class", "g").agg(*_rows_of())
    busy = written(_busy(matrix, percent), "busy_blocks")
    pivots = own.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.col("classes")) < PIVOTS)
    asked = pivots.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("classes") / F.col("fit")) - 1)))
    rows = own.select("doc_id", block, F.lit(True).alias("member")).unionByName(asked.select("doc_id", block, F.lit(False).alias("member")))
    found = written(_opened(docs, k, percent, rows.join(busy, "g", "left_semi").withColumn("part", F.lit(0))), "links_of_large_names")
    roots = components(found)
    own = own.join(roots, own["doc_id"] == roots["node"], "left").select("doc_id", "name", "fit", F.coalesce("root", "doc_id").alias("root"))
    own = written(own, "roots_of_large_names")
    many = own.groupBy("name", "root").agg(F.count("*").alias("c")).filter(F.col("c") >= group // 4).select("name", F.col("root").alias("r"), F.lit(True).alias("many"))
    own = own.withColumnRenamed("name", "m").join(many, (F.col("m") == F.col("name")) & (F.col("root") == F.col("r")), "left").select("doc_id", F.col("m").alias("name"), "fit", "root", F.coalesce("many", F.lit(False)).alias("many"))
    rest = own.filter(~F.col("many")).groupBy("name").agg(F.ceil(F.count("*") / F.min("fit")).alias("blocks"))
    alone = own.filter(~F.col("many")).join(rest, "name").select("doc_id", F.xxhash64("name", F.lit(1), F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.col("blocks"))).alias("unit"), F.lit(None).cast(docs.schema["doc_id"].dataType).alias("root"))
    return written(own.filter("many").select("doc_id", F.xxhash64("name", F.lit(2), "root").alias("unit"), "root").unionByName(alone), "settled"), found


def links(docs: DataFrame, sigs: DataFrame, k: int, percent: int, group: int = GROUP) -> DataFrame:
    """(src, dst) between class representatives: enough links that their components are those of all links."""
    kind = docs.schema["doc_id"].dataType
    named = sigs.filter("n > 0 AND doc_id IS NOT NULL")
    reps = named.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("doc_id"))
    named = named.join(reps, ["s1", "s2", "n", "doc_id"], "left_semi")
    # The rows are many, so those whose token a Bloom filter of the shared ones
    # lacks are left where they are.
    ratio = percent / 100
    shared = _keys(named, percent).groupBy("token").agg(F.count("*").alias("sets")).filter("sets > 1")
    shared = written(shared, "shared_tokens")
    tokens = _keys(named, percent, _bloom(shared.select(F.col("token").alias("key")))).join(shared, "token").repartition("doc_id")
    # Linked sets share COMMON of these tokens, or all if they are smaller than that.
    least = F.least(F.lit(COMMON), F.ceil(F.ceil(F.col("n") * ratio) * ratio))
    tokens = tokens.withColumn("c", F.count("*").over(W.partitionBy("doc_id", "class"))).filter(F.col("c") >= least).drop("c")
    hot = F.max(F.struct("sets", "token")).over(W.partitionBy("doc_id"))
    tokens = written(tokens.withColumn("name", F.xxhash64(F.when(hot["sets"] > group, hot["token"]).otherwise(F.min("token").over(W.partitionBy("doc_id"))), F.floor(F.log("n") / -math.log(min(ratio, 0.99))))), "candidate_tokens")

    tokens = tokens.drop("sets")
    large = tokens.groupBy("name", "doc_id").agg(F.max("n").alias("n")).groupBy("name").agg(F.count("*").alias("classes"), F.max("n").alias("most"))
    large = large.select("name", "classes", _fit(group, F.col("most")).alias("fit")).filter("classes > fit")
    large = written(large, "names_over_a_group")
    huge = large.filter(F.col("classes") > SETTLED * F.col("fit"))
    block = F.pmod(F.xxhash64("doc_id"), F.coalesce(F.ceil(F.col("classes") / F.col("fit")), F.lit(1).cast("long")))
    dealt = tokens.join(large, "name", "left").select(*tokens.columns, F.xxhash64("name", block).alias("unit"), F.lit(None).cast(kind).alias("root"))
    first = None
    if not huge.isEmpty():
        settled, first = _settled(docs, k, percent, tokens, huge, group)
        settled = settled.select(F.col("doc_id").alias("d"), F.col("unit").alias("unit1"), F.col("root").alias("r1"))
        dealt = dealt.join(settled, F.col("doc_id") == F.col("d"), "left").select(*tokens.columns, F.coalesce("unit1", "unit").alias("unit"), F.col("r1").alias("root"))
    tokens = dealt
    own = written(tokens.select("doc_id", "unit", "root", "n").distinct(), "groups")

    matrix = tokens.groupBy("token", "class", F.col("unit").alias("g")).agg(*_rows_of(), F.max("root").alias("root"))
    matrix = written(matrix, "token_groups")
    other = matrix.select("token", *[F.col(c).alias(f"{c}2") for c in ("g", "lo", "hi", "rest", "root")])
    can = (F.col("g") < F.col("g2")) & (F.col("hi2") * 100 >= F.col("lo") * percent) & (F.col("hi") * 100 >= F.col("lo2") * percent)
    can = can & ~F.coalesce(F.col("root") == F.col("root2"), F.lit(False))  # two settled groups of one component
    # Of a linked pair's common tokens, in order, the j-th has the rest for it in every row with least > j.  So at least
    # as many rows have the rest as the lowest `least` says, if that is taken over all rows: those without it, too.
    least = _common(F.col("lo"), F.col("lo2"), F.greatest("hi", "hi2"), percent)
    need = ratio / (1 + ratio) * (F.col("lo") + F.col("lo2")) - least
    enough = (F.col("rest") >= need) & (F.col("rest2") >= need)
    pairs = matrix.join(other, "token").filter(can).groupBy("g", "g2", "class").agg(F.count_if(enough).alias("c"), F.min(least).alias("least"))
    pairs = pairs.filter("c > 0 AND c >= least").select(F.col("g").alias("unit"), F.col("g2").alias("unit2")).distinct()
    # A settled group may be larger than a task holds, so it is opened in blocks.
    blocks = own.filter("root IS NOT NULL").groupBy("unit").agg(F.ceil(F.count("*") / _fit(group, F.max("n"))).alias("blocks"))
    blocks = written(blocks.filter("blocks > 1"), "blocks")
    member = own.join(blocks, "unit", "left").select("doc_id", "unit", "root", F.xxhash64("unit", F.pmod(F.xxhash64("doc_id"), F.coalesce("blocks", F.lit(1).cast("long")))).alias("g"))
    queries = pairs.join(own.select("doc_id", "n", F.col("unit").alias("unit2")), "unit2").join(blocks, "unit", "left")
    queries = queries.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1).cast("long")) - 1))).select(F.xxhash64("unit", "b").alias("g"), "doc_id", "n")
    queries = written(queries, "queries")
    chunked = queries.groupBy("g").agg(F.ceil(F.count("*") / _fit(group, F.max("n"))).alias("parts"))
    asked = queries.join(chunked, "g").select("doc_id", "g", F.pmod(F.xxhash64("doc_id", F.lit(3)), "parts").cast("int").alias("part"), F.lit(False).alias("member"))
    # A group is opened for its own members if enough tokens are in two of them and it is not settled, or if it has queries.
    busy = _busy(matrix.filter("root IS NULL"), percent).select(F.xxhash64("g", F.lit(0).cast("long")).alias("g"))
    opened = busy.unionByName(chunked.select("g")).distinct()
    parts = member.join(opened, "g", "left_semi").join(chunked, "g", "left").select("doc_id", "g", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)).cast("int"))).alias("part"), F.lit(True).alias("member"))
    found = _opened(docs, k, percent, parts.unionByName(asked))
    return found.unionByName(first) if first is not None else found


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; sets link when 100 * intersection >= percent * union."""
    docs = docs.select("doc_id", "text")
    sigs = written(signatures(docs, k, percent, count_sketch(docs, k)), "signatures")
    root = components(links(docs, sigs, k, percent, group))
    rows = sigs.select("doc_id", "n", "s1", "s2")
    named = rows.filter("n > 0 AND doc_id IS NOT NULL")
    reps = named.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_size"))
    reps = reps.join(root, reps["rep"] == root["node"], "left").select("s1", "s2", "n", "_size", F.coalesce("root", "rep").alias("component_id"))
    linked = join_groups(named, written(reps, "classes"), ["s1", "s2", "n"], named.count()).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def dedup(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of `docs`, with all their columns, but one document alone of each component: that with the smallest doc_id.

    Documents without a word are near to nothing and stay, as do those without
    a doc_id.  Only documents that a bitmap of the dropped ids marks are joined
    with them; the others are not shuffled.
    """
    found = near_duplicates(docs, k=k, percent=percent)
    drop = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_drop")).distinct().withColumn("_h", F.xxhash64("_drop"))
    drop = written(drop, "near_duplicates")
    keyed = docs.select(whole_row(docs)).withColumn("_h", F.xxhash64("_row.doc_id"))
    marked = sifted(keyed, "_h", drop, drop.count())
    stay = marked.filter("_maybe").join(drop.select("_drop"), F.col("_row.doc_id") == F.col("_drop"), "left_anti")
    return marked.filter(~F.col("_maybe")).unionByName(stay).select("_row.*")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=3, percent=90)
