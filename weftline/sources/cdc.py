"""Change-data capture: decoders of JSON changelogs to rows with a kind, and the collapse of a changelog.

Each decoder is one from_json and one explode over the text column `value`;
nothing is collected and no Python runs.  A line that does not parse fails
the job, unless `ignore_parse_errors` passes it over; null and blank lines, and
events that change no row, give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.sql import HIDDEN
from weftline.sources import changes


def _parsed(schema: T.StructType, ignore_parse_errors: bool, value: Column | str = "value") -> Column:
    return F.from_json(value, schema, {"mode": "PERMISSIVE" if ignore_parse_errors else "FAILFAST"})


def _event(kind: str, row: Column, when: Column | None = None) -> Column:
    e = F.struct(F.lit(kind).alias("_row_kind"), row.alias("row"))
    return e if when is None else F.when(when, e)


def _out(df: DataFrame, events: Column, table: Column, include: tuple[str | None, str | None], ids: tuple[Column, Column], *more: Column) -> DataFrame:
    for want, own in zip(include, ids, strict=True):
        if want:
            df = df.filter(own == want)
    made = df.select(table.alias("_table"), *more, F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e"))
    return made.select("e.row.*", *[c for c in made.columns if c != "e"], "e._row_kind")


def _strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _typed(row: Column, schema: T.StructType) -> Column:
    return F.struct(*[row[f.name].try_cast(f.dataType).alias(f.name) for f in schema])


def _overlaid(row: Column, old: Column, present: Column, schema: T.StructType) -> Column:
    """The image before: changed fields from `old` (even where null), the others from the row."""
    return F.struct(*[F.when(F.array_contains(present, f.name), old[f.name]).otherwise(row[f.name]).try_cast(f.dataType).alias(f.name) for f in schema])


def canal(df: DataFrame, schema: T.StructType, database_include: str | None = None, table_include: str | None = None, ignore_parse_errors: bool = False) -> DataFrame:
    text = _strings(schema)
    outer = T.StructType([T.StructField("type", T.StringType()), T.StructField("database", T.StringType()), T.StructField("table", T.StringType()), T.StructField("data", T.ArrayType(text)), T.StructField("old", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
    d = df.select(_parsed(outer, ignore_parse_errors).alias("m"))
    pairs = F.transform(F.col("m.data"), lambda x, i: F.struct(x.alias("new"), F.try_element_at(F.col("m.old"), i + 1).alias("old")))
    d = d.select("m.type", "m.database", "m.table", F.explode(pairs).alias("p"))
    old = F.struct(*[F.try_element_at(F.col("p.old"), F.lit(f.name)).alias(f.name) for f in schema])
    before = _overlaid(F.col("p.new"), old, F.coalesce(F.map_keys("p.old"), F.array().cast("array<string>")), schema)
    row = _typed(F.col("p.new"), schema)
    kind = F.col("type")
    events = F.array(_event("+I", row, kind == "INSERT"), _event("-U", before, kind == "UPDATE"), _event("+U", row, kind == "UPDATE"), _event("-D", row, kind == "DELETE"))
    return _out(d, events, F.concat_ws(".", "database", "table"), (database_include, table_include), (F.col("database"), F.col("table")))


def debezium(df: DataFrame, schema: T.StructType, ignore_parse_errors: bool = False, positions: bool = False) -> DataFrame:
    """With or without an envelope of schema and payload.

    With `positions`, `_at` says where in the database's log a change is: the
    log file, if there are several, the position, log sequence or change
    number in it, and the time in milliseconds.
    """
    place = [("file", T.StringType()), ("pos", T.LongType()), ("lsn", T.LongType()), ("scn", T.LongType()), ("ts_ms", T.LongType())] if positions else []
    source = T.StructType([T.StructField(n, t) for n, t in (("db", T.StringType()), ("table", T.StringType()), *place)])
    inner = T.StructType([T.StructField("op", T.StringType()), T.StructField("before", schema), T.StructField("after", schema), T.StructField("source", source)])
    m = _parsed(T.StructType([T.StructField("payload", inner), *inner.fields]), ignore_parse_errors)
    d = df.select(m.alias("m")).select(F.when(F.col("m.payload").isNotNull(), F.col("m.payload")).otherwise(F.struct("m.op", "m.before", "m.after", "m.source")).alias("p"))
    op = F.col("p.op")
    events = F.array(_event("+I", F.col("p.after"), op.isin("c", "r")), _event("-U", F.col("p.before"), (op == "u") & F.col("p.before").isNotNull()), _event("+U", F.col("p.after"), (op == "u") & F.col("p.after").isNotNull()), _event("-D", F.col("p.before"), op == "d"))
    at = [F.struct(F.coalesce("p.source.file", F.lit("")).alias("file"), F.coalesce("p.source.pos", "p.source.lsn", "p.source.scn").alias("pos"), F.col("p.source.ts_ms").alias("ts_ms")).alias("_at")] if positions else []
    return _out(d, events, F.concat_ws(".", "p.source.db", "p.source.table"), (None, None), (op, op), *at)


def maxwell(df: DataFrame, schema: T.StructType, database_include: str | None = None, table_include: str | None = None, ignore_parse_errors: bool = False) -> DataFrame:
    outer = T.StructType([T.StructField("type", T.StringType()), T.StructField("database", T.StringType()), T.StructField("table", T.StringType()), T.StructField("data", schema), T.StructField("old", schema)])
    d = df.select(_parsed(outer, ignore_parse_errors).alias("m"), F.json_object_keys(F.get_json_object("value", "$.old")).alias("keys"))
    kind = F.col("m.type")
    before = _overlaid(F.col("m.data"), F.col("m.old"), F.coalesce("keys", F.array().cast("array<string>")), schema)
    row = _typed(F.col("m.data"), schema)
    events = F.array(_event("+I", row, kind.isin("insert", "bootstrap-insert")), _event("-U", before, kind == "update"), _event("+U", row, kind == "update"), _event("-D", row, kind == "delete"))
    return _out(d, events, F.concat_ws(".", "m.database", "m.table"), (database_include, table_include), (F.col("m.database"), F.col("m.table")))


def ogg(df: DataFrame, schema: T.StructType, table_include: str | None = None, ignore_parse_errors: bool = False) -> DataFrame:
    outer = T.StructType([T.StructField("op_type", T.StringType()), T.StructField("table", T.StringType()), T.StructField("before", schema), T.StructField("after", schema)])
    d = df.select(_parsed(outer, ignore_parse_errors).alias("m"))
    op = F.col("m.op_type")
    events = F.array(_event("+I", F.col("m.after"), op == "I"), _event("-U", F.col("m.before"), op == "U"), _event("+U", F.col("m.after"), op == "U"), _event("-D", F.col("m.before"), op == "D"))
    return _out(d, events, F.col("m.table"), (table_include, None), (F.element_at(F.split(F.col("m.table"), r"\."), -1), op))


DECODERS = {"canal_json": canal, "debezium_json": debezium, "maxwell_json": maxwell, "ogg_json": ogg}


def collapse(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The state that a changelog leaves: the last event of each key (`changes.precedence`), unless it takes the row away."""
    last = changes.last_changes(df, keys, order).filter(~F.col("_row_kind").isin(*changes.GONE))
    return last.select(*keys, *[F.col(f"`{c}`") for c in last.columns if c not in ("_row_kind", *keys, *order)])


def _messages(df: DataFrame, key: str | None, fields) -> DataFrame:
    """A `value` column of JSON: fields(row, gone) of each row, its table and its kind; nulls are written.

    Each row is a message by itself: the image before an update takes a row
    away and the one after it adds one, so a decoder gives -D and +I for them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in HIDDEN and c != key])
    kind = F.coalesce(F.col("_row_kind"), F.lit("+I")) if "_row_kind" in df.columns else F.lit("+I")
    made = fields(row, kind.isin("-D", "-U"))
    value = F.to_json(F.struct(*[c.alias(n) for n, c in made.items()]), {"ignoreNullFields": "false"}).alias("value")
    return df.select(F.col(key).alias("key"), value) if key else df.select(value)


def to_debezium(df: DataFrame, key: str | None = None) -> DataFrame:
    return _messages(df, key, lambda row, gone: {"before": F.when(gone, row), "after": F.when(~gone, row), "op": F.when(gone, "d").otherwise("c")})


def to_canal(df: DataFrame, key: str | None = None) -> DataFrame:
    return _messages(df, key, lambda row, gone: {"data": F.array(row), "type": F.when(gone, "DELETE").otherwise("INSERT")})


def to_maxwell(df: DataFrame, key: str | None = None) -> DataFrame:
    return _messages(df, key, lambda row, gone: {"data": row, "type": F.when(gone, "delete").otherwise("insert")})


def to_ogg(df: DataFrame, key: str | None = None) -> DataFrame:
    return _messages(df, key, lambda row, gone: {"before": F.when(gone, row), "after": F.when(~gone, row), "op_type": F.when(gone, "D").otherwise("I")})


ENCODERS = {"canal_json": to_canal, "debezium_json": to_debezium, "maxwell_json": to_maxwell, "ogg_json": to_ogg}


def kafka_connect(df: DataFrame, schema: T.StructType, ignore_parse_errors: bool = False) -> DataFrame:
    """Rows of records with an envelope of schema and payload, or bare; tombstones give none."""
    m = _parsed(T.StructType([T.StructField("payload", schema)]), True)
    keys = F.json_object_keys("value")
    enveloped = F.array_contains(keys, "payload")
    if "payload" in schema.names:
        enveloped &= F.array_contains(keys, "schema")
    row = F.when(enveloped, m["payload"]).otherwise(_parsed(schema, True))
    parsed = keys.isNotNull()
    if not ignore_parse_errors:
        blank = F.trim(F.coalesce("value", F.lit(""))) == ""
        parsed = F.when(parsed | blank, parsed).otherwise(F.raise_error(F.concat(F.lit("malformed record: "), "value")).cast("boolean"))
    return df.filter(parsed).select(row.alias("r")).filter("r IS NOT NULL").select("r.*", F.lit("+I").alias("_row_kind"))


DECODERS["compatible_kafka_connect_json"] = kafka_connect
