"""A stream of changes of a table whose columns change, applied to a target that is altered with it.

Beside messages of rows the log holds messages of columns:

    {"op": "schema", "changes": [{"kind": "add", "name": "n", "type": "string"}], "source": {...}}

or with all `columns` [{"name", "type"}] as they are from there on.  The
versions of the schema are kept in a folder: each with the place in the log
from which it holds.  A row is read with the version of its place, and brought
forward to the newest one; the target is altered before rows that need it come,
once for each version, as it keeps the number of its own.

The rows of a batch are few versions' rows, so a batch is one job.  Rows of a
version come from one pass over the batch for each version in it.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans import evolution
from weftline.plans.evolution import Change
from weftline.sources import buckets, capture, changes, jdbc
from weftline.sources.capture import NOWHERE, Place

_SOURCE = T.StructType([T.StructField("file", T.StringType()), T.StructField("table", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("pos", "lsn", "scn")]])
_PAIR = T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "name", "to", "type")])
_MESSAGE = T.StructType([T.StructField("op", T.StringType()), T.StructField("changes", T.ArrayType(_PAIR)), T.StructField("columns", T.ArrayType(_PAIR)), T.StructField("source", _SOURCE)])


@dataclass(frozen=True)
class Version:
    """A schema, the place of the message that made it, and the changes from the one before."""

    place: Place
    schema: T.StructType
    changes: tuple[Change, ...] = ()


class Target(Protocol):
    """What is written to: `alter` does nothing if the version is not newer than the target's own, `write` nothing if the batch was written."""

    def alter(self, version: int, changes: list[Change]) -> None: ...

    def write(self, rows: DataFrame, batch: int) -> None: ...


def versions(spark: SparkSession, folder: str) -> list[Version]:
    """The schema log of a folder, oldest first."""
    if not changes.exists(spark, f"{folder}/schemas"):
        return []
    rows = sorted((r[0] for r in spark.read.text(f"{folder}/schemas").collect()), key=lambda x: json.loads(x)["version"])  # one line a version
    out = []
    for r in map(json.loads, rows):
        if r["version"] == len(out):  # a version that was written twice counts once
            out.append(Version(Place(**r["place"]), T.StructType.fromJson(r["schema"]), tuple(map(Change.of, r["changes"]))))
    return out


def _log(spark: SparkSession, folder: str, number: int, v: Version) -> None:
    line = json.dumps({"version": number, "place": asdict(v.place), "schema": v.schema.jsonValue(), "changes": [c.json() for c in v.changes]})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/schemas")


def learn(lines: DataFrame, folder: str, table: str | None = None) -> list[Version]:
    """Adds the schema messages of a batch that are newer than the log's last version; returns all versions."""
    spark = lines.sparkSession
    known = versions(spark, folder)
    m = F.from_json("value", _MESSAGE)
    told = lines.filter(F.col("value").contains('"schema"')).select(m.alias("m")).filter("m.op = 'schema'")
    if table is not None:
        told = told.filter(F.coalesce(F.col("m.source.table"), F.lit(table)).isin(table, table.split(".")[-1]))
    found = []
    for r in told.collect():  # messages of columns alone
        s = r.m.source
        found.append((Place(s.file or "", next(x for x in (s.pos, s.lsn, s.scn) if x is not None)), r.m))
    for place, message in sorted(found, key=lambda x: x[0]):
        if place <= known[-1].place:
            continue
        old = known[-1].schema
        if message.changes:
            made = [Change.of({k: v for k, v in c.asDict().items() if v is not None}) for c in message.changes]
        else:
            made = evolution.between(old, T.StructType([T.StructField(c["name"], evolution.data_type(c["type"])) for c in message["columns"]]))
        new = Version(place, evolution.schema_after(old, made), tuple(made))
        _log(spark, folder, len(known), new)
        known.append(new)
    return known


def rows_of(lines: DataFrame, known: list[Version], table: str | None = None, ignore: bool = False) -> DataFrame:
    """The changes of a batch, each read with the version of its place, as rows of the newest."""
    s = F.from_json("value", _MESSAGE)["source"]
    placed = lines.withColumn("_at", F.struct(F.coalesce(s["file"], F.lit("")).alias("file"), F.coalesce(s["pos"], s["lsn"], s["scn"]).alias("pos")))
    out = []
    for i, v in enumerate(known):
        here: Column = capture.after(v.place) if v.place != NOWHERE else F.lit(True)
        if i + 1 < len(known):
            here = here & ~capture.after(known[i + 1].place)
        # Lines of other versions may not even parse with this one; a filter might be tested after parsing.
        rows = capture.decoded(placed.select(F.when(here, F.col("value")).alias("value")), v.schema, table, ignore)
        out.append(evolution.forward(rows, [c for later in known[i + 1 :] for c in later.changes]).select(*known[-1].schema.names, "_table", "_at", "_row_kind"))
    return reduce(DataFrame.unionByName, out)


def apply(lines: DataFrame, batch: int, folder: str, target: Target, table: str | None = None, begin: Column | None = None) -> None:
    """One batch: learns versions, alters the target once for each, writes the rows."""
    kept = lines.persist()
    try:
        known = learn(kept, folder, table)
        for i, v in enumerate(known[1:], 1):
            target.alter(i, list(v.changes))
        rows = rows_of(kept, known, table)
        target.write(rows if begin is None else rows.filter(begin), batch)
    finally:
        kept.unpersist()


class BucketTarget:
    """A folder of files in buckets: a new version is a new manifest, and files of older ones are read as they are and brought forward."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], writer: str, n: int = buckets.BUCKETS):
        self.spark, self.path, self.keys, self.writer, self.n = spark, path, keys, writer, n
        self.version = 0

    def alter(self, version: int, made: list[Change]) -> None:
        self.version = version
        buckets.evolve(self.spark, self.path, made, version)

    def write(self, rows: DataFrame, batch: int) -> None:
        buckets.upsert(rows, self.path, self.keys, buckets=self.n, writer=self.writer, batch=batch, evolved=self.version)


class JdbcTarget:
    """A JDBC table: its version is in the ledger, and is written there with the statements that alter it."""

    def __init__(self, spark: SparkSession, options: dict, table: str, writer: str):
        self.spark, self.options, self.table, self.writer = spark, options, table, writer
        self.version, self.there = 0, jdbc.table_exists(spark, options, table)

    def alter(self, version: int, made: list[Change]) -> None:
        self.version = version
        if self.there:
            jdbc.alter(self.spark, self.options, self.table, made, version)

    def write(self, rows: DataFrame, batch: int) -> None:
        if not self.there:  # it is made as the newest version has it
            jdbc.prepare(rows, self.options, self.table)
            jdbc.alter(self.spark, self.options, self.table, [], self.version)
            self.there = True
        jdbc.write(rows, self.options, self.table, self.writer, batch)


def follow(spark: SparkSession, log: str, schema: T.StructType, folder: str, target: Target, checkpoint: str, table: str | None = None, begin: Place = NOWHERE, interval: str | None = None):
    """The streaming query that keeps `target` like the table; `schema` is the one at `begin`.

    Its batches are numbered from 1: 0 is for rows that were there before.
    """
    if not versions(spark, folder):
        _log(spark, folder, 0, Version(begin, schema))
    lines = spark.readStream.format("text").schema("value string").load(log)
    first = capture.after(begin) if begin != NOWHERE else None
    writer = lines.writeStream.foreachBatch(lambda b, i: apply(b, i + 1, folder, target, table, first)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
