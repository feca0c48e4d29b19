"""Packing: deficit round-robin over source queues.

1. Every text is tokenised once, into a written table of ids (two bytes each
   where the vocabulary allows).
2. Documents are dealt to packing partitions of about `part_tokens` tokens by a
   seeded hash of doc_id, so no source, however large, shapes a partition.
3. Within a partition documents queue by source, in hash order.  Each round,
   of `length` tokens, adds to each source's deficit its target share of them,
   and a source sends whole documents while its deficit covers the next one.
   At the end of a window, of `window` tokens, a source whose deficit is not
   used up sends as many tokens of its next document as it covers, and the rest
   of that document stays first in its queue.  So every window holds the target
   proportions to a token, as long as each source has documents waiting.  What
   a source could not send carries to the next window.  Between partitions
   deficits carry as prefix sums: by the end of a partition all its documents
   are sent, so the next one's opening deficit is known from token counts, and
   partitions run side by side.
4. The stream is cut every `length` ids.  The last, shorter stretch of a
   partition is cut into powers of two, so no sequence needs padding.

Targets are given by source, or are the sources' shares of all tokens.  Every
document is packed, so with given targets the sources that run out in a
partition leave its last windows to the others, and the deficits carried are
held within a window.  A task streams: it holds a look-ahead of documents,
never a partition.  There are at most `MAX_TASKS` tasks; with more partitions a
task runs several in turn.

The ids are those of the tokenizers file at `tokenizer`, as `Tokenizer.encode`
gives them with add_special_tokens=False.  Where its merges are in the order of
its ids, as in byte-level BPE files, they are computed by tiktoken from that
same file, which is several times faster; otherwise, and for texts in which an
added token's string occurs or which are longer than `LONG` characters, by the
tokenizers library itself.

Edge cases: a null text is empty and gives the closing id 0 alone; a null
source is a source; rows with the same doc_id are packed each, and rows without
one are dealt by their ids; texts are whole; an empty table gives an empty
result; extra columns are never read.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from collections import deque
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._text import documents, map_text, written

LENGTH = 1024
WINDOW = 64 * LENGTH
PART_TOKENS = 4 << 20
MAX_TASKS = 1 << 16
LOOKAHEAD = 1 << 20
CLOSING = 0
#: The pre-tokenisation expression of byte-level BPE with its default settings.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer texts than this go to tiktoken in no single call; its expression engine has limits.
LONG = 1 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bytes_of_letters() -> dict[str, int]:
    """The letters by which byte-level BPE files write the 256 bytes: printable ones as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def _kind(path: str) -> type:
    """The type of ids: two bytes where the vocabulary allows.  Read from the file, so the driver loads no tokenizer."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    known = {t for t, *_ in vocab} if isinstance(vocab, list) else set(vocab)
    return np.uint16 if len(known | {t["content"] for t in spec.get("added_tokens") or []}) <= 1 << 16 else np.uint32


@cache
def _encoder(path: str):
    """(encode, bytes an id): a function from a text to a numpy array of ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    kind = _kind(path)

    def plain(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, kind)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"].get("vocab"), spec["model"].get("merges")
    pre = spec.get("pre_tokenizer") or {}
    usual = spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
    if not usual or not merges:
        return plain, kind
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    made = [vocab.get(a + b, -1) for a, b in pairs]
    if any(x >= y for x, y in zip(made, made[1:], strict=False)):
        return plain, kind
    import tiktoken

    letters = _bytes_of_letters()
    special = [t["content"] for t in spec.get("added_tokens", [])]
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def quick(text: str) -> np.ndarray:
        if len(text) > LONG or any(t in text for t in special):
            return plain(text)
        return np.array(fast.encode_ordinary(text), kind)

    return quick, kind


def tokenised(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, n and ids (little-endian, with the closing id) of every row."""

    def run(batches):
        encode, kind = _encoder(tokenizer)
        for b in batches:
            ids, n = [], []
            for text in b.column(2):
                a = encode(text.as_py() or "")
                ids.append(np.append(a, kind(CLOSING)).tobytes())
                n.append(len(a) + 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "source", "n", "ids"])

    schema = T.StructType([docs.schema["doc_id"], docs.schema["source"], T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])
    return map_text(docs, run, schema, "doc_id", "source", "text")


class RoundRobin:
    """Queues by source with deficits; `take` gives pieces of documents in the order in which they are sent."""

    def __init__(self, window: int, length: int = LENGTH):
        self.rounds = max(1, window // length)  # rounds a window
        self.quantum = window / self.rounds
        self.round = 0
        self.share: dict[str | None, float] = {}
        self.deficit: dict[str | None, float] = {}
        self.queue: dict[str | None, deque] = {}
        self.waiting = 0

    def source(self, name: str | None, share: float, deficit: float) -> None:
        self.share[name], self.deficit[name], self.queue[name] = share, deficit, deque()

    def put(self, name: str | None, n: int, doc) -> None:
        self.queue[name].append([0, n, doc])
        self.waiting += n

    def _idle(self, name: str | None) -> int:
        """Rounds until the source covers its next document, or a token of it at a window's end."""
        start, n, _ = self.queue[name][0]
        a_round = self.share[name] * self.quantum
        whole = max(1, math.ceil((n - start - self.deficit[name]) / a_round))
        one = max(1, math.ceil((1 - self.deficit[name]) / a_round))
        return min(whole, one + -(self.round + one) % self.rounds)

    def take(self, least: int):
        """Sends (document, start, end) until no more than `least` tokens wait."""
        while self.waiting > least:
            full = [s for s, q in self.queue.items() if q]
            idle = min(map(self._idle, full))  # rounds in which nobody sends are passed over at once
            for s in self.share:
                self.deficit[s] += idle * self.share[s] * self.quantum
            self.round = (self.round + idle) % self.rounds
            for s in full:
                q = self.queue[s]
                while q:
                    start, n, doc = q[0]
                    size = n - start
                    if size > self.deficit[s]:
                        size = 0 if self.round else max(0, int(self.deficit[s]))
                    if not size:
                        break
                    q[0][0] += size
                    if q[0][0] == n:
                        q.popleft()
                    self.deficit[s] -= size
                    self.waiting -= size
                    yield doc, start, start + size


class Cutter:
    """Cuts the stream of documents into sequences; the last one of a partition into powers of two."""

    def __init__(self, first: int, length: int):
        self.sequence, self.length, self.used = first, length, 0
        self.open: list[list] = []  # pieces of the sequence being filled
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray, start: int, end: int) -> None:
        while start < end:
            size = min(end - start, self.length - self.used)
            last = self.open[-1] if self.open else None
            if last and last[4] is ids and last[1] + len(last[2]) == start:  # the same document goes on
                last[2] = ids[last[1] : start + size]
            else:
                self.open.append([doc_id, start, ids[start : start + size], len(ids), ids])
            self.used += size
            start += size
            if self.used == self.length:
                self._close([self.length])

    def _close(self, lengths: list[int]) -> None:
        pieces = deque(self.open)
        for length in lengths:
            offset = 0
            while offset < length:
                doc_id, start, ids, total, _ = pieces.popleft()
                size = min(len(ids), length - offset)
                if size < len(ids):
                    pieces.appendleft([doc_id, start + size, ids[size:], total, None])
                self.rows.append((doc_id, start, size, zlib.crc32(ids[:size].astype("<u4").tobytes()), total, self.sequence, offset))
                offset += size
            self.sequence += 1
        self.open, self.used = [], 0

    def finish(self) -> None:
        if self.used:
            self._close([1 << i for i in reversed(range(self.used.bit_length())) if self.used >> i & 1])


def _running(frame: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds `name`: the sum of `value` over the rows before, by `part`, that agree in `keys` (null is a value).

    In two levels, so that no window holds more than 1024 parts or a row for each 1024 parts.
    """
    block = F.shiftright("part", 10)
    inner = W.partitionBy(*keys, block).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy(*[f"_{k}" for k in keys]).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    tops = frame.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], block.alias("_b")).agg(F.sum(value).alias("_v"))
    tops = tops.withColumn("_v", F.coalesce(F.sum("_v").over(outer), F.lit(0)))
    on = block == F.col("_b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    rows = frame.withColumn(name, F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return rows.join(tops, on).withColumn(name, F.col(name) + F.col("_v")).drop("_b", "_v", *[f"_{k}" for k in keys])


def _shares(sums: DataFrame, total: int, targets: dict[str | None, float] | None) -> DataFrame:
    """_s and share of every source; sources without a target come when all others are empty."""
    found = sums.groupBy(F.col("source").alias("_s")).agg((F.sum("n") / F.lit(float(max(1, total)))).alias("share"))
    if targets is None:
        return found
    rows = [(k, float(v)) for k, v in targets.items()]
    given = sums.sparkSession.createDataFrame(rows, T.StructType([T.StructField("_t", T.StringType()), T.StructField("_w", T.DoubleType())]))
    found = found.join(given, F.col("_s").eqNullSafe(F.col("_t")), "left").withColumn("_w", F.greatest(F.lit(1e-6), F.coalesce("_w", F.lit(0.0))))
    return found.select("_s", (F.col("_w") / F.sum("_w").over(W.partitionBy())).alias("share"))


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, window: int = WINDOW, part_tokens: int = PART_TOKENS, seed: int = 29, targets: dict[str | None, float] | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    `targets` are the proportions of a window's tokens by source, in any unit.
    """
    tokenizer = tokenizer or default_tokenizer()
    rows = written(tokenised(docs, tokenizer), "tokens")
    kind = rows.schema["doc_id"].dataType
    total = rows.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(total / part_tokens))
    tasks = min(parts, MAX_TASKS)
    own = [F.col("doc_id"), F.col("n"), F.when(F.col("doc_id").isNull(), F.col("ids"))]
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), *own), F.lit(parts)))
    # Opening deficits: what a source should have sent before this partition, less what it has.
    sums = written(rows.groupBy("source", "part").agg(F.sum("n").alias("n")), "part_sums")
    whole = _running(sums.groupBy("part").agg(F.sum("n").alias("all")), [], "all", "all_before").select("part", "all_before")
    carried = _running(sums, ["source"], "n", "before").join(whole, "part")
    carried = carried.join(_shares(sums, total, targets), F.col("source").eqNullSafe(F.col("_s")))
    deficit = F.col("share") * F.col("all_before") - F.col("before")
    if targets is not None:
        deficit = F.greatest(F.lit(-float(window)), F.least(F.lit(float(window)), deficit))
    carried = carried.select("part", F.lit(0).alias("what"), F.lit(0).cast("long").alias("place"), F.lit(None).cast(kind).alias("doc_id"), "source", F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("ids"), "share", deficit.alias("deficit"))
    sent = rows.select("part", F.lit(1).alias("what"), F.xxhash64(F.lit(seed + 1), *own).alias("place"), "doc_id", "source", "n", "ids", F.lit(None).cast("double").alias("share"), F.lit(None).cast("double").alias("deficit"))
    both = carried.unionByName(sent).repartitionById(tasks, F.floor(F.col("part") * tasks / parts).cast("int")).sortWithinPartitions("part", "what", "place", "doc_id", "source", "n", "ids")
    wide = _kind(tokenizer)
    ahead = min(LOOKAHEAD, part_tokens)

    def run(batches):
        part, robin, cutter = None, None, None

        def flush(rows):
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow, strict=True)], schema.names)

        def drain(least):
            for (doc_id, ids), start, end in robin.take(least):
                cutter.add(doc_id, ids, start, end)

        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(9)), strict=True):
                if r[0] != part:
                    if robin:
                        drain(0)
                        cutter.finish()
                        yield flush(cutter.rows)
                    part, robin, cutter = r[0], RoundRobin(window, length), Cutter(r[0] << 32, length)
                if r[1] == 0:
                    robin.source(r[4], r[7], r[8])
                else:
                    robin.put(r[4], r[5], (r[3], np.frombuffer(r[6], wide)))
            if not robin:
                continue
            drain(ahead)
            if len(cutter.rows) > 20_000:
                yield flush(cutter.rows)
                cutter.rows = []
        if robin:
            drain(0)
            cutter.finish()
            yield flush(cutter.rows)

    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]])
    arrow = [to_arrow_type(f.dataType) for f in schema.fields]
    return both.mapInArrow(run, schema)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
