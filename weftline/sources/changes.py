"""Writing changelogs: the last change of each key, applied to files, catalog tables and JDBC tables.

A frame with row kinds is reduced to one change a key before anything is
written, so a key may change any number of times in a batch.  Applying the
same changes again gives the same table, so a sink that is tried again does
no harm.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.plans.sql import HIDDEN

GONE = ("-D", "-U")


class ChangelogError(ValueError):
    """Changes for a target that has no key to apply them by."""


def is_changelog(df: DataFrame) -> bool:
    return "_row_kind" in df.columns


def plain_rows(df: DataFrame, target: str) -> DataFrame:
    """The rows to add, where there is no key: inserts alone are let through."""
    if not is_changelog(df):
        return df.drop(*HIDDEN)
    other = df.filter(F.coalesce("_row_kind", F.lit("+I")) != "+I")
    if not other.isEmpty():
        raise ChangelogError(f"{target}: rows that change or remove others need primary_keys")
    return df.drop(*HIDDEN)


#: Of changes that share their order columns, the later one is further right: the image after an update
#: comes after the one before it, and where a row is taken away and added at one time, it is there.
KINDS = ("-U", "-D", "+I", "+U")


def precedence(df: DataFrame, keys: list[str], order: list[str] | None) -> Column:
    """What the last change of a key is greatest in: the order columns, or the place `_at` in a log, then the kind, then the row itself.

    The row decides only between changes of one kind and one time, so that a
    shuffle does not.  Without either changes come in the order of rows,
    which holds for the keys whose changes lie in one partition, as in a topic
    dealt by key.
    """
    by = [F.col(f"`{c}`") for c in order or (["_at"] if "_at" in df.columns else [])]
    if not by:
        return F.monotonically_increasing_id()
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.coalesce("_row_kind", F.lit("+I"))) if is_changelog(df) else F.lit(0)
    rest = [F.col(f"`{f.name}`") for f in df.schema if f.name not in (*keys, *HIDDEN) and not re.search("map<|variant", f.dataType.simpleString())]
    return F.struct(*by, kind, F.xxhash64(*rest) if rest else F.lit(0))


def last_changes(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row a key, with its `_row_kind`: the last by `precedence`.

    max_by is aggregated before the shuffle, so a hot key is one row a task.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ChangelogError(f"no column {', '.join(missing)} for the key")
    if not is_changelog(df):
        df = df.withColumn("_row_kind", F.lit("+I"))
    df = df.withColumn("_row_kind", F.coalesce("_row_kind", F.lit("+I")))
    placed = df.withColumn("_order", precedence(df, keys, order))
    df = df.drop(*[h for h in HIDDEN if h != "_row_kind"])
    rest = [c for c in df.columns if c not in keys]
    last = placed.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col("_order")).alias("_last"))
    return last.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_last.`{c}`") for c in df.columns])


def _same(a: DataFrame, b: DataFrame, keys: list[str]):
    on = a[f"`{keys[0]}`"].eqNullSafe(b[f"`{keys[0]}`"])
    for k in keys[1:]:
        on = on & a[f"`{k}`"].eqNullSafe(b[f"`{k}`"])
    return on


def merged(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """`old` without the changed keys, and the rows that the changes leave."""
    rows = changes.filter(~F.col("_row_kind").isin(*GONE)).drop("_row_kind").select(*old.columns)
    return old.join(changes, _same(old, changes, keys), "left_anti").unionByName(rows)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def replace_folder(spark: SparkSession, path: str, new: str) -> None:
    """`new` takes the place of `path`; the old folder goes last, so that one of them is always whole."""
    fs, at = _fs(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(new), at):
        raise OSError(f"cannot move {new}")
    fs.delete(old, True)


def upsert_files(df: DataFrame, path: str, keys: list[str], format: str = "parquet", order: list[str] | None = None, **options) -> None:
    """Applies changes to a folder of files by writing a new folder and putting it in the old one's place."""
    spark = df.sparkSession
    changes = last_changes(df, keys, order)
    if exists(spark, path):
        schema = changes.drop("_row_kind").schema
        state = merged(spark.read.format(format).schema(schema).options(**options).load(path), changes, keys)
    else:
        state = changes.filter(~F.col("_row_kind").isin(*GONE)).drop("_row_kind")
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    state.write.format(format).options(**options).save(new)
    replace_folder(spark, path, new)


def upsert_table(df: DataFrame, table: str, keys: list[str], order: list[str] | None = None) -> None:
    """Applies changes to a catalog table, through a table beside it."""
    spark = df.sparkSession
    changes = last_changes(df, keys, order)
    if not spark.catalog.tableExists(table):
        changes.filter(~F.col("_row_kind").isin(*GONE)).drop("_row_kind").write.saveAsTable(table)
        return
    aside = f"{table}__{uuid.uuid4().hex}"
    merged(spark.table(table), changes, keys).write.saveAsTable(aside)
    try:
        spark.table(aside).write.mode("overwrite").insertInto(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
