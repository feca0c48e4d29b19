"""Change capture: a table as it is, and then the changes that a database's log tells of it.

The log is a folder of files whose lines are Debezium messages, as a Debezium
server or a message broker's file sink writes them; files are added, never
changed.  A place in it is a log file's name and a position.

Starting with `initial`, the table is read in splits while the log goes on:

1. low: the last place in the log before the first split is read;
2. the splits are read, each at its own time;
3. high: the last place after the last split.

A row that was read is right unless the log has a change of its key after low:
then the last change up to high replaces it, or takes it away, or adds it where
the table did not have it yet (`hand_over`).  So what comes out is the table as
of high, whatever happened meanwhile, and changes go on right after high.  The
high mark and those rows are kept in the checkpoint, so a job that starts again
goes on with the same ones.

A log that lags behind the database may give a row its latest value before the
change itself comes; applied by key that changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.sources import cdc, changes

STARTS = ("initial", "earliest", "latest", "specific", "timestamp")
STOPS = ("never", "latest", "specific", "timestamp")
PLACE = T.StructType([T.StructField("file", T.StringType()), T.StructField("pos", T.LongType()), T.StructField("ts_ms", T.LongType())])


class CaptureError(ValueError):
    """A start or stop that names no place."""


@dataclass(frozen=True, order=True)
class Place:
    """A place in a log; `NOWHERE` is before the first."""

    file: str
    pos: int


NOWHERE = Place("", -1)


def after(place: Place, at: str = "_at") -> Column:
    """Whether a change comes after a place."""
    return (F.col(f"{at}.file") > place.file) | ((F.col(f"{at}.file") == place.file) & (F.col(f"{at}.pos") > place.pos))


def decoded(lines: DataFrame, schema: T.StructType, table: str | None = None, ignore_parse_errors: bool = False) -> DataFrame:
    """The changes of a table by its name, with or without its database's."""
    out = cdc.debezium(lines, schema, ignore_parse_errors, positions=True)
    if table is None:
        return out
    return out.filter(F.col("_table").isin(table, table.split(".")[-1]) | F.col("_table").endswith(f".{table}"))


def last_place(spark: SparkSession, log: str) -> Place:
    """The last place in the log, of any table; one aggregate over its lines."""
    if not changes.exists(spark, log):
        return NOWHERE
    source = T.StructType([T.StructField("file", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("pos", "lsn", "scn")]])
    inner = T.StructType([T.StructField("source", source)])
    m = F.from_json("value", T.StructType([*inner.fields, T.StructField("payload", inner)]))
    s = F.coalesce(m["payload"]["source"], m["source"])
    place = F.struct(F.coalesce(s["file"], F.lit("")).alias("file"), F.coalesce(s["pos"], s["lsn"], s["scn"]).alias("pos"))
    got = spark.read.text(log).select(place.alias("p")).filter("p.pos IS NOT NULL").agg(F.max("p")).first()[0]
    return Place(*got) if got else NOWHERE


def hand_over(snapshot: DataFrame, events: DataFrame, keys: list[str], low: Place, high: Place) -> DataFrame:
    """The table as of `high`, as inserts there: rows read between the marks, replaced by the last changes between them.

    Rows of the snapshot are one a key; changes are aggregated by key before
    they are shuffled.  Rows whose key has no change stay as they are.
    """
    between = events.filter(after(low) & ~after(high))
    last = changes.last_changes(between, keys)
    state = changes.merged(snapshot.select(*last.drop("_row_kind").columns), last, keys)
    mark = F.struct(F.lit(high.file).alias("file"), F.lit(high.pos).cast("long").alias("pos"), F.lit(None).cast("long").alias("ts_ms"))
    return state.withColumns({"_at": mark, "_row_kind": F.lit("+I")})


def start_of(spark: SparkSession, log: str, options: dict) -> Place | Column | None:
    """The place after which changes are taken, a condition for a time, None for `initial`."""
    mode = str(options.get("startup.mode", "initial")).lower()
    if mode == "initial":
        return None
    if mode == "earliest":
        return NOWHERE
    if mode == "latest":
        return last_place(spark, log)
    if mode == "specific":
        return _specific(options, "startup")
    if mode == "timestamp":
        return F.col("_at.ts_ms") >= int(options["startup.timestamp"])
    raise CaptureError(f"startup.mode is {mode}, not one of {', '.join(STARTS)}")


def _specific(options: dict, which: str) -> Place:
    """The place that options name; a start takes the change there, a stop too."""
    pos = options.get(f"{which}.specific-offset.pos")
    if pos is None:
        raise CaptureError(f"{which}.specific-offset.pos is missing")
    return Place(str(options.get(f"{which}.specific-offset.file", "")), int(pos) - (which == "startup"))


def until(spark: SparkSession, log: str, options: dict, bounded: bool) -> Column | None:
    """Which changes come before the stop; None where nothing stops them.  A batch job stops at the log's end."""
    mode = str(options.get("stop.mode", "never")).lower()
    if mode == "never":
        return None if not bounded else ~after(last_place(spark, log))
    if mode == "latest":
        return ~after(last_place(spark, log))
    if mode == "specific":
        return ~after(_specific(options, "stop"))
    if mode == "timestamp":
        return F.col("_at.ts_ms") <= int(options["stop.timestamp"])
    raise CaptureError(f"stop.mode is {mode}, not one of {', '.join(STOPS)}")


def _kept(spark: SparkSession, folder: str) -> dict | None:
    path = f"{folder}/marks"
    return json.loads(spark.read.text(path).first()[0]) if changes.exists(spark, f"{path}/_SUCCESS") else None


def _keep(spark: SparkSession, folder: str, marks: dict) -> None:
    spark.createDataFrame([(json.dumps(marks),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/marks")


def _begin(spark: SparkSession, log: str, schema: T.StructType, keys: list[str], options: dict, read: Callable[[], DataFrame] | None, folder: str, table: str | None) -> dict:
    """Where changes begin and end, found once for a folder; with `initial` the table's rows as of the beginning are in it."""
    found = start_of(spark, log, options)
    if found is not None:
        return {"begin": asdict(found) if isinstance(found, Place) else None, "initial": False}
    if read is None or not keys:
        raise CaptureError("startup.mode initial needs a table to read, with a key")
    low = last_place(spark, log)
    rows = read()
    rows.write.mode("overwrite").parquet(f"{folder}/read")  # read once, between the marks
    high = last_place(spark, log)
    events = decoded(spark.read.text(log), schema, table, bool(options.get("ignore_parse_errors", False))) if high != NOWHERE else None
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/read")
    if events is None:
        events = cdc.debezium(spark.createDataFrame([], "value string"), schema, positions=True)
    hand_over(rows, events, keys, low, high).withColumn("_table", F.lit(table).cast("string")).write.mode("overwrite").parquet(f"{folder}/rows")
    return {"begin": asdict(high), "low": asdict(low), "initial": True}


def begin_of(spark: SparkSession, log: str, schema: T.StructType, keys: list[str], options: dict, folder: str, read: Callable[[], DataFrame] | None, table: str | None, stream: bool) -> dict:
    """The marks of a folder, found now if it has none."""
    kept = _kept(spark, folder)
    if kept is None:
        kept = _begin(spark, log, schema, keys, options, read, folder, table)
        if stream and str(options.get("stop.mode", "never")).lower() == "latest":
            kept["stop"] = asdict(last_place(spark, log))
        _keep(spark, folder, kept)
    return kept


def capture(spark: SparkSession, log: str, schema: T.StructType, keys: list[str], options: dict, folder: str, read: Callable[[], DataFrame] | None = None, table: str | None = None, stream: bool = False) -> DataFrame:
    """Rows of the schema with `_row_kind`, `_table` and their place `_at`.

    `read` reads the table, in splits, for `initial`.  `folder`, which tasks and
    driver share, keeps the marks and the rows up to the hand-over; where it has
    them already they are used again.
    """
    kept = begin_of(spark, log, schema, keys, options, folder, read, table, stream)
    lines = (spark.readStream if stream else spark.read).format("text").schema("value string").load(log)
    begin = after(Place(**kept["begin"])) if kept["begin"] else F.col("_at.ts_ms") >= int(options["startup.timestamp"])
    events = decoded(lines, schema, table, bool(options.get("ignore_parse_errors", False))).filter(begin)
    stop = ~after(Place(**kept["stop"])) if kept.get("stop") else until(spark, log, options, not stream)
    if stop is not None:
        events = events.filter(stop)
    if table is not None:
        events = events.withColumn("_table", F.lit(table))
    if not kept["initial"]:
        return events
    shape = spark.read.parquet(f"{folder}/rows").schema
    state = (spark.readStream if stream else spark.read).schema(shape).parquet(f"{folder}/rows")
    return state.select(*events.columns).unionByName(events)
