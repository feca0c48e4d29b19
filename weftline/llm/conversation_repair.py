"""Conversation structure repair by weighted finite-state composition.

A conversation is an acceptor of its rows.  Composed with the edit transducer
(keep, rerole, delete, insert) and the acceptor of role sequences
`(s?(ua)+)?`, it gives all repaired conversations; the least weight over pairs
of cost and label string, added and joined along a path, is the cheapest one,
ties by the labels.  The composition is lazy: only grammar states that a row
can reach are made.  It is walked row by row, its topological order; insertions
are layers before a row, at most two, as more lead round a cycle.

A conversation may hold any number of rows, so none is gathered:

1. Equal rows of a turn are one line with a count; of lines that say the same
   the first is found by an aggregate.  Texts stay behind under their hash.
2. Lines are sorted by ranges of (conversation, turn, ...), so a long
   conversation lies in several tasks.  Runs of at most SEGMENT lines become
   the least paths from each grammar state to each: a matrix over the weights.
3. The matrices of a conversation are multiplied from its start, and the path
   is handed back to its segments and lines, which fetch their texts.

Only the digest of the query reads a conversation from end to end, row after
row, as a SHA-256 has to.

Edge cases: a null role or text is one space, and so a role that is not kept
and a blank text; a null conv_id is a conversation of its own; null turns come
first; rows of one turn go by role, then by the text's SHA-256; repeated rows are
duplicates; empty tables give no row; extra columns, of any name, are never
read.  Turns are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._bitmaps import join_groups
from weftline.llm._text import small_batches, written

#: Lines of a segment.
SEGMENT = 1024

#: Costs of edits; what a truncated row costs that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

#: The grammar of roles: states are the last initial; arcs, and states in which a conversation may end.
START, ARCS, ENDS = "", {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}, ("", "a")

#: (cost, labels), least first; paths by the grammar state they end in.
Weight = tuple[int, str]
Paths = dict[str, Weight]


@cache
def insertions(state: str) -> tuple[tuple[Weight, str], ...]:
    """What may be inserted in a state: nothing, one or two rows, with the state it leads to."""
    layers = [[((0, ""), state)]]
    for _ in range(2):
        layers.append([((cost + INSERT, labels + "I"), ARCS[at, role]) for (cost, labels), at in layers[-1] for role in ROLES if (at, role) in ARCS])
    return tuple(x for layer in layers for x in layer)


def edits(initial: str, gone: bool, truncated: bool) -> Iterator[tuple[Weight, str | None]]:
    """The edits of a row, with the initial they give it, None if it is deleted."""
    yield (DELETE, "D"), None
    if not gone:
        extra = TRUNCATED if truncated else 0
        yield (extra, "K"), initial
        for role in ROLES:
            yield (REROLE + extra, "R"), role


def advance(paths: Paths, initial: str, gone: bool, truncated: bool, copies: int = 1) -> Paths:
    """The least paths after one more line; its further copies, all deleted, are one label `d`."""
    out: Paths = {}
    for state, (cost, labels) in paths.items():
        for (more, inserted), there in insertions(state):
            for (price, label), role in edits(initial, gone, truncated):
                to = there if role is None else ARCS.get((there, role))
                if to is not None:
                    new = (cost + more + price, labels + inserted + label)
                    if to not in out or new < out[to]:
                        out[to] = new
    if copies > 1:
        out = {to: (cost + DELETE * (copies - 1), labels + "d") for to, (cost, labels) in out.items()}
    return out


def ended(paths: Paths) -> tuple[Weight, str, str]:
    """The least path to an end of the grammar, the state before its last insertions, and these."""
    return min(((cost + more, labels + inserted), state, inserted) for state, (cost, labels) in paths.items() for (more, inserted), there in insertions(state) if there in ENDS)


def told(state: str, labels: str, initials: str) -> tuple[list[str], str]:
    """What becomes of each line, and the state after them: `u` and `a` are inserted rows, `k` the row itself, `U` and `A` the row in that role."""
    out, code, i = [], "", 0
    for label in labels:
        if label == "d":
            continue
        role = initials[i] if label == "K" else next(r for r in "ua" if (state, r) in ARCS) if label in "IR" else None
        state = state if role is None else ARCS[state, role]
        code += {"I": role, "R": (role or "").upper(), "K": "k", "D": ""}[label]
        if label != "I":
            out.append(code)
            code, i = "", i + 1
    return out, state


class Segment:
    """A run of lines of one conversation, as least paths and counts."""

    def __init__(self, conv: str):
        self.conv, self.size = conv, 0
        self.paths: dict[str, Paths] = {s: {s: (0, "")} for s in ("", "s", "u", "a")}
        self.initials, self.extras = "", []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.opens = self.closes = None

    def add(self, turn: int | None, role: str, copies: int, blank: bool, again: bool, truncated: bool) -> None:
        initial = role[:1]
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - 1 + again
            self.truncated += truncated and not again
        if self.size:
            self.illegal += self.closes + initial not in LEGAL
        else:
            self.opens = initial
        self.illegal += copies - 1
        self.closes = initial
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        gone = blank or again
        self.paths = {s: advance(p, initial, gone, truncated and not gone, copies) for s, p in self.paths.items()}
        self.initials += initial if initial in ("s", "u", "a") else "-"
        if copies > 1:
            self.extras.append(copies - 1)
        self.size += 1

    def row(self, number: int) -> dict:
        arcs = [{"source": s, "to": to, "cost": w[0], "labels": w[1]} for s, p in self.paths.items() for to, w in p.items()]
        return {"_c": self.conv, "seg": number, **{k: getattr(self, k) for k in ("blank", "duplicate", "truncated", "illegal", "turns", "first", "last", "opens", "closes", "initials", "extras")}, "arcs": arcs}


_SUMMARY = [(k, pa.int64()) for k in ("blank", "duplicate", "truncated", "illegal", "turns", "first", "last")] + [("opens", pa.string()), ("closes", pa.string()), ("initials", pa.string()), ("extras", pa.list_(pa.int64())), ("arcs", pa.list_(pa.struct([("source", pa.string()), ("to", pa.string()), ("cost", pa.int64()), ("labels", pa.string())])))]
_SUMMARY_SQL = "blank long, duplicate long, truncated long, illegal long, turns long, first long, last long, opens string, closes string, initials string, extras array<long>, arcs array<struct<source: string, to: string, cost: long, labels: string>>"


def _segments(lines: DataFrame) -> DataFrame:
    """Of lines sorted within their tasks: a row (_c, seg, idx, _k) for each, and one for each segment."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema([("_c", pa.string()), ("seg", pa.int64()), ("idx", pa.int32()), ("_k", pa.string()), *_SUMMARY])
        at: Segment | None = None
        for b in batches:
            out = []
            for conv, turn, role, k, copies, blank, again, truncated in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if at is None or at.conv != conv or at.size == SEGMENT:
                    if at is not None:
                        out.append(at.row(number))
                        number += 1
                    at = Segment(conv)
                out.append({"_c": conv, "seg": number, "idx": at.size, "_k": k})
                at.add(turn, role, copies, blank, again, truncated)
            yield pa.RecordBatch.from_pylist(out, schema)
        if at is not None:
            yield pa.RecordBatch.from_pylist([at.row(number)], schema)

    small_batches(lines.sparkSession)
    return lines.select("_c", "turn", "role", "_k", "n", "blank", "again", "truncated").mapInArrow(run, f"_c string, seg long, idx int, _k string, {_SUMMARY_SQL}")


def product(segments: list[dict]) -> dict:
    """The least path through a conversation's segments in order, and its counts."""
    paths: dict[str, tuple[int, tuple[str, ...]]] = {START: (0, ())}
    for s in segments:
        new: dict[str, tuple[int, tuple[str, ...]]] = {}
        for arc in s["arcs"]:
            if arc["source"] in paths:
                cost, parts = paths[arc["source"]]
                weight = (cost + arc["cost"], (*parts, arc["labels"]))
                # Parts hold as many rows each, so tuples compare as the joined labels do.
                if arc["to"] not in new or weight < new[arc["to"]]:
                    new[arc["to"]] = weight
        paths = new
    (cost, _), state, tail = min((((c + more, (*parts, inserted)), s, inserted) for s, (c, parts) in paths.items() for (more, inserted), there in insertions(s) if there in ENDS), key=lambda x: x[0])
    parts, state, audit, codes = paths[state][1], START, [], []
    turns, first, last, illegal, closes = 0, None, None, 0, None
    for s, labels in zip(segments, parts, strict=True):
        code, state = told(state, labels, s["initials"])
        codes.append({"seg": s["seg"], "codes": code})
        pieces = labels.split("d")
        audit.append(pieces[0] + "".join("D" * n + p for n, p in zip(s["extras"], pieces[1:], strict=True)))
        illegal += s["illegal"] + (closes is not None and closes + s["opens"] not in LEGAL)
        closes = s["closes"]
        if s["turns"]:
            turns += s["turns"] - (last == s["first"])
            first, last = s["first"] if first is None else first, s["last"]
    end, _ = told(state, tail + "D", "")
    counts = {k: sum(s[k] for s in segments) for k in ("blank", "duplicate", "truncated")}
    return {"gaps": last - first + 1 - turns if turns else 0, **counts, "illegal": illegal, "cost": cost, "audit": "".join(audit) + tail, "tail": end[0], "parts": codes}


_PRODUCT = "_c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, tail string, parts array<struct<seg: long, codes: array<string>>>"


def _products(segments: DataFrame) -> DataFrame:
    def run(batches):
        schema = pa.schema([("_c", pa.string()), *[(k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("tail", pa.string()), ("parts", pa.list_(pa.struct([("seg", pa.int64()), ("codes", pa.list_(pa.string()))])))])
        for b in batches:
            yield pa.RecordBatch.from_pylist([{"_c": c, **product(s)} for c, s in zip(*[x.to_pylist() for x in b.columns], strict=True)], schema)

    own = [c for c in segments.columns if c not in ("_c", "idx", "_k")]
    return segments.groupBy("_c").agg(F.array_sort(F.collect_list(F.struct(*own))).alias("segments")).mapInArrow(run, _PRODUCT)


def _key(*names: str) -> Column:
    return F.sha2(F.to_json(F.struct(*names)).cast("binary"), 256)


def _conv(column: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired rows) of conversations of conv_id, turn, role and text.

    Audits: `_c` (the conv_id as a key), gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation with a row.
    Repaired rows: `_c`, `place` (their order in the conversation), role and text.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    inked = F.rtrim("text", F.lit(SPACES))
    facts = [_conv().alias("_c"), _key("conv_id", "turn", "role", "text").alias("_k"), _key("conv_id", "role", "text").alias("_s"), F.sha2(F.col("text").cast("binary"), 256).alias("_t"), (inked == "").alias("blank"), (~F.substring(inked, -1, 1).isin(".", "!", "?")).alias("truncated")]
    rows = written(rows.select("turn", "role", "text", *facts), "rows")
    lines = rows.groupBy("_k").agg(*[F.first(c).alias(c) for c in ("_c", "turn", "role", "_s", "_t", "blank", "truncated")], F.count("*").alias("n"))
    lines = written(lines, "lines")
    said = lines.groupBy("_s").agg(F.min(F.struct("turn", "_k")).alias("first"), F.count("*").alias("_size"))
    lines = join_groups(lines, written(said, "said"), ["_s"], lines.count()).withColumn("again", F.col("_k") != F.col("first._k"))
    order = ["_c", "turn", "role", "_t"]
    flat = written(_segments(lines.repartitionByRange(*order).sortWithinPartitions(*order)), "segments")
    audits = written(_products(flat.filter("idx IS NULL")), "audits")
    codes = audits.select(F.explode("parts").alias("p")).select("p.*")
    told_lines = flat.filter("idx IS NOT NULL").select("_c", "seg", "idx", "_k").join(codes, "seg").withColumn("code", F.get("codes", F.col("idx")))
    # A key of a line is one row on both sides.
    texts = rows.groupBy("_k").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    whole = told_lines.filter("code <> ''").select("_c", F.struct("seg", "idx").alias("line"), "_k", "code").join(texts, "_k")
    last = audits.filter("tail <> ''").select("_c", F.struct(F.lit((1 << 63) - 1).alias("seg"), F.lit(0).alias("idx")).alias("line"), F.col("tail").alias("code"), F.lit("").alias("role"), F.lit("").alias("text"))
    single = whole.select("_c", "line", "code", "role", "text").unionByName(last).select("_c", "line", F.posexplode(F.regexp_extract_all("code", F.lit("(.)"))).alias("pos", "what"), "role", "text")
    role = F.when(F.lower("what") == "u", "user").when(F.lower("what") == "a", "assistant").otherwise(F.col("role"))
    repaired = single.select("_c", F.struct("line.seg", "line.idx", "pos").alias("place"), role.alias("role"), F.when(F.col("what").isin("u", "a"), "").otherwise(F.col("text")).alias("text"))
    return audits.drop("tail", "parts"), repaired


def digests(repaired: DataFrame) -> DataFrame:
    """_c and repaired_sha256 of conversations that have rows: read in order, a batch at a time."""

    def run(batches):
        conv, state = None, None
        for b in batches:
            done = []
            for c, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if c != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["_c", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], ["_c", "repaired_sha256"])

    lines = repaired.select("_c", "place", F.concat("role", F.lit(":"), "text").alias("line")).repartition("_c").sortWithinPartitions("_c", "place")
    return lines.select("_c", "line").mapInArrow(run, "_c string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with faults by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 removes `[.!?]`, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    which = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(which == 1, "").when(which == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    out = rows.select("conv_id", "turn", F.when(which == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.when(which == 0, 0).when(which == 3, 2).otherwise(1).alias("_times"))
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times", "_copy")


def repaired_conversations(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The audit of every conv_id of `conversations`, whose rows are `rows`, and the digest of its repaired rows."""
    audits, repaired = repair(rows)
    every = conversations.groupBy("conv_id").agg(F.lit(1).alias("_n")).select("conv_id", _conv().alias("_c"))
    found = every.join(audits, "_c", "left").join(written(digests(repaired), "digests"), "_c", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired_conversations(conversations, damaged(conversations))


ORACLE = r"""
WITH RECURSIVE
crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
picked AS (SELECT named.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS w FROM named, crc),
damaged AS (SELECT conv_id, turn, CASE w WHEN 4 THEN 'user' ELSE role END AS role, CASE w WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE w WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM picked),
placed AS (SELECT *, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS c, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
rows_ AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                         WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                 lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
counts AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
                  count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY c),
arcs(g, r, h) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
one AS (SELECT g, h, CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END AS line FROM arcs WHERE r <> 's'),
inserted AS (SELECT g, g AS h, 0 AS price, '' AS label, CAST([] AS VARCHAR[]) AS lines FROM (SELECT DISTINCT g FROM arcs)
             UNION ALL SELECT g, h, 5, 'I', [line] FROM one
             UNION ALL SELECT a.g, b.h, 10, 'II', [a.line, b.line] FROM one a JOIN one b ON a.h = b.g),
edits(label, price, r) AS (VALUES ('D', 2, NULL), ('K', 0, NULL), ('R', 1, 'u'), ('R', 1, 'a')),
best AS (
  SELECT c, 0 AS i, '' AS g, 0 AS cost, '' AS labels, CAST([] AS VARCHAR[]) AS lines FROM counts
  UNION ALL
  SELECT c, i, g, min(cost)::INTEGER, arg_min(labels, printf('%09d', cost) || labels), arg_min(lines, printf('%09d', cost) || labels)
  FROM (SELECT b.c, r.i::INTEGER AS i, CASE e.label WHEN 'D' THEN s.h ELSE a.h END AS g,
               b.cost + s.price + e.price + CASE WHEN r.fault = 'truncated' AND e.label <> 'D' THEN 5 ELSE 0 END AS cost, b.labels || s.label || e.label AS labels,
               list_concat(b.lines, s.lines, CASE e.label WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text] ELSE [CASE e.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text] END) AS lines
        FROM best b JOIN rows_ r ON r.c = b.c AND r.i = b.i + 1 JOIN inserted s ON s.g = b.g CROSS JOIN edits e
        LEFT JOIN arcs a ON a.g = s.h AND a.r = CASE e.label WHEN 'K' THEN r.initial ELSE e.r END
        WHERE e.label = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND a.h IS NOT NULL))
  GROUP BY c, i, g),
ended AS (SELECT c, min(cost) AS cost, arg_min(labels, printf('%09d', cost) || labels) AS audit, arg_min(lines, printf('%09d', cost) || labels) AS lines
          FROM (SELECT b.c, b.cost + s.price AS cost, b.labels || s.label AS labels, list_concat(b.lines, s.lines) AS lines
                FROM best b JOIN counts n ON n.c = b.c AND n.n = b.i JOIN inserted s ON s.g = b.g WHERE s.h IN ('', 'a')) GROUP BY c)
SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS c FROM conversations) q LEFT JOIN counts USING (c) LEFT JOIN ended USING (c)
"""
