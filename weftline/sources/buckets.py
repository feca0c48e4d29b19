"""Folders of files to which changes are applied without writing the whole of them anew.

Rows lie in buckets by the hash of their key.  Applying changes writes the
buckets that they touch into a folder of their own, and then a manifest that
says for every bucket which folder holds it.  A manifest is one small file with
the next number, which takes its name when it is whole, so readers see the
state before or after.  A number is given once: of two writers at once the
second fails, on file systems whose rename does not replace a file (HDFS).

A manifest has the schemas that the table had; a folder is read with its own
and brought forward, so new columns cost no rewriting.

The manifest also keeps for each writer the last batch that it applied, so a
batch that is given again is passed over.

    <path>/_manifests/00000007.json
    <path>/<folder>/_bucket=3/part-...

Tables of the lakehouse formats do more; this is for plain files.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.evolution import Change, forward, schema_after
from weftline.sources import changes

BUCKETS = 64
BUCKET = "_bucket"


class ConflictError(RuntimeError):
    """Another writer applied changes in between."""


def _manifests(spark: SparkSession, path: str) -> list[str]:
    fs, at = changes._fs(spark, f"{path.rstrip('/')}/_manifests")
    return sorted(p.getPath().getName() for p in fs.listStatus(at) if p.getPath().getName().endswith(".json")) if fs.exists(at) else []


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The newest manifest, or the one of a version; None where there is no table."""
    names = _manifests(spark, path)
    name = names[-1] if names and version is None else f"{version or 0:08d}.json"
    if name not in names:
        return None
    fs, at = changes._fs(spark, f"{path.rstrip('/')}/_manifests/{name}")
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, made: dict) -> None:
    """The file appears whole or, if another writer has made it, not at all."""
    folder = f"{path.rstrip('/')}/_manifests"
    fs, at = changes._fs(spark, f"{folder}/{made['version']:08d}.json")
    _, draft = changes._fs(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(made).encode()))
    stream.close()
    if fs.exists(at) or not fs.rename(draft, at):
        fs.delete(draft, False)
        raise ConflictError(f"{path} has a version {made['version']} already")


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")


def _rows(spark: SparkSession, path: str, at: dict, buckets: list[int] | None = None) -> DataFrame:
    by_schema: dict[int, list[str]] = {}
    for b, (folder, number) in at["folders"].items():
        if buckets is None or int(b) in buckets:
            by_schema.setdefault(number, []).append(f"{path.rstrip('/')}/{folder}/{BUCKET}={b}")
    schemas = [T.StructType.fromJson(s["schema"]) for s in at["schemas"]]
    made = [[Change.of(c) for c in s["changes"]] for s in at["schemas"]]
    frames = [spark.createDataFrame([], schemas[-1])] if not by_schema else []
    for number, folders in sorted(by_schema.items()):
        rows = spark.read.schema(schemas[number]).format(at["format"]).load(folders)
        frames.append(forward(rows, [c for later in made[number + 1 :] for c in later]).select(*schemas[-1].names))
    return reduce(DataFrame.unionByName, frames)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as the newest manifest, or that of a version, has it."""
    at = manifest(spark, path, version)
    if at is None:
        raise FileNotFoundError(f"no table at {path}")
    return _rows(spark, path, at)


def upsert(df: DataFrame, path: str, keys: list[str], order: list[str] | None = None, buckets: int = BUCKETS, format: str = "parquet", writer: str | None = None, batch: int | None = None, evolved: int = 0) -> list[int]:
    """Applies changes; returns the buckets that were written, none if the writer's batch was applied before.

    A table that is made now has the schema of the changes, which is version `evolved` of its source.
    """
    spark = df.sparkSession
    at = manifest(spark, path) or {"version": 0, "keys": keys, "buckets": buckets, "format": format, "folders": {}, "batches": {}, "schemas": [], "evolved": evolved}
    if at["keys"] != keys:
        raise changes.ChangelogError(f"{path} has the key {at['keys']}, not {keys}")
    if writer is not None and batch is not None and at["batches"].get(writer, -1) >= batch:
        return []
    made = changes.last_changes(df, keys, order).withColumn(BUCKET, _bucket(keys, at["buckets"]))
    made = made.persist()
    try:
        touched = sorted(r[0] for r in made.select(BUCKET).distinct().collect())  # no more than there are buckets
        plain = made.drop("_row_kind", BUCKET)
        schemas = at["schemas"] or [{"schema": plain.schema.jsonValue(), "changes": []}]
        folder = uuid.uuid4().hex
        if touched:
            old = _rows(spark, path, {**at, "schemas": schemas}, touched)
            state = changes.merged(old, made.select(*plain.columns, "_row_kind"), keys).withColumn(BUCKET, _bucket(keys, at["buckets"]))
            state.repartition(len(touched), BUCKET).write.partitionBy(BUCKET).format(at["format"]).save(f"{path.rstrip('/')}/{folder}")
    finally:
        made.unpersist()
    fs, _ = changes._fs(spark, path)
    there = {b for b in touched if changes.exists(spark, f"{path.rstrip('/')}/{folder}/{BUCKET}={b}")}  # the others are empty now
    folders = {b: f for b, f in at["folders"].items() if int(b) not in touched} | {str(b): [folder, len(schemas) - 1] for b in touched if b in there}
    batches = at["batches"] | ({writer: batch} if writer is not None and batch is not None else {})
    _put(spark, path, {**at, "version": at["version"] + 1, "schemas": schemas, "folders": folders, "batches": batches})
    return touched


def evolve(spark: SparkSession, path: str, made: list[Change], version: int) -> bool:
    """Changes the table's columns, once for each version: a new manifest, no file is written anew.  Key columns stay."""
    at = manifest(spark, path)
    if at is None or at["evolved"] >= version:
        return False
    if any(c.name in at["keys"] for c in made):
        raise changes.ChangelogError(f"{path}: the key decides the buckets and cannot change")
    schema = schema_after(T.StructType.fromJson(at["schemas"][-1]["schema"]), made)
    _put(spark, path, {**at, "version": at["version"] + 1, "evolved": version, "schemas": [*at["schemas"], {"schema": schema.jsonValue(), "changes": [c.json() for c in made]}]})
    return True


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes manifests but the newest, and folders that those do not name; returns how many folders went."""
    names = _manifests(spark, path)
    live = {f for n in names[-keep:] for f, _ in manifest(spark, path, int(n[:8]))["folders"].values()}
    fs, at = changes._fs(spark, path)
    gone = 0
    for n in names[:-keep]:
        fs.delete(changes._fs(spark, f"{path.rstrip('/')}/_manifests/{n}")[1], False)
    for p in fs.listStatus(at):
        if p.getPath().getName() not in live and not p.getPath().getName().startswith("_"):
            fs.delete(p.getPath(), True)
            gone += 1
    return gone
