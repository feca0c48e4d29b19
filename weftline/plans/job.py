"""Jobs: sources, transforms and sinks joined by named datasets.

A dataset is {table path: DataFrame}.  Nothing runs before a sink does, so
Catalyst sees the plan from the scan to the sink.  A table that several sinks
read is kept on the executors' disks from the first of them to the last, so its
source is read once.

In streaming jobs every sink but files and the console writes batch by batch,
each with the same code as in a batch job; offsets are in the checkpoint, and a
batch that is given again is applied again, which changes nothing where the
sink applies changes by key.
"""

from __future__ import annotations

import base64
import contextlib
import datetime as dt
import decimal
import re
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import models
from weftline.operators import transforms as tr
from weftline.plans import config, rules
from weftline.plans.keys import primary_key, with_key
from weftline.plans.sql import sql
from weftline.sources import buckets, capture, cdc, changes, connectors, formats, http, jdbc, packages, protobuf, readers, services, sinks, splits, stores
from weftline.streaming import evolving, increasing
from weftline.streaming import run as streaming

Tables = dict[str, DataFrame]


class JobError(ValueError):
    """A job that does not fit together."""


@dataclass
class Job:
    """What a job runs with: the session, its env, own plugins, and the datasets made so far."""

    spark: SparkSession
    env: dict
    plugins: dict[str, Callable] = field(default_factory=dict)
    clients: dict[str, Callable] = field(default_factory=dict)
    datasets: dict[str, Tables] = field(default_factory=dict)
    results: list = field(default_factory=list)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)
    prepared: set = field(default_factory=set)
    events: list[tuple[str, str]] = field(default_factory=list)
    evolving: dict[int, dict] = field(default_factory=dict)
    listener: Callable[[str, str], None] | None = None
    id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def say(self, event: str, about: str = "") -> None:
        """A lifecycle event: kept, and told to the listener."""
        self.events.append((event, about))
        if self.listener:
            self.listener(event, about)

    def checkpoint(self, name: str) -> str:
        folder = self.env.get("checkpoint.path") or self.spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise JobError("a streaming job needs env.checkpoint.path or spark.checkpoint.dir")
        return f"{folder.rstrip('/')}/{re.sub(r'[^A-Za-z0-9]+', '_', name)}"

    @property
    def interval(self) -> str | None:
        every = self.env.get("checkpoint.interval")
        return f"{every} milliseconds" if every else None

    @property
    def streaming(self) -> bool:
        return str(self.env.get("job.mode", "BATCH")).upper() == "STREAMING"


def option(options: dict, name: str, default=None):
    """An option by its dotted name, whether written as one key or nested."""
    if name in options:
        return options[name]
    head, _, rest = name.partition(".")
    return option(options[head], rest, default) if rest and isinstance(options.get(head), dict) else default


def _schema(options: dict) -> T.StructType | None:
    schema = options.get("schema") or {}
    if "columns" in schema:
        return T.StructType([T.StructField(c["name"], readers.schema_of({"x": c["type"]})[0].dataType, c.get("nullable", True), {k: c[k] for k in ("comment",) if k in c}) for c in schema["columns"]])
    return readers.schema_of(dict(schema["fields"])) if "fields" in schema else None


def _keyed(df: DataFrame, options: dict) -> DataFrame:
    """`df` with the keys that its schema option names."""
    schema = options.get("schema") or {}
    if not isinstance(schema, dict):
        return df
    if columns := option(schema, "primaryKey.columnNames"):
        df = with_key(df, list(columns))
    for key in schema.get("constraintKeys") or []:
        df = with_key(df, [c["columnName"] for c in key["constraintColumns"]], key.get("constraintName", key.get("constraintType", "key")))
    return df


def _python(value, to: T.DataType):
    """A value of a job file as Spark takes it; CURRENT_* are the time of the driver."""
    if value is None:
        return None
    now = dt.datetime.now()
    if isinstance(to, T.DateType):
        return now.date() if value == "CURRENT_DATE" else dt.date.fromisoformat(value)
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        return now if value == "CURRENT_TIMESTAMP" else dt.datetime.fromisoformat(value)
    if isinstance(to, T.DecimalType):
        return decimal.Decimal(str(value))
    if isinstance(to, (T.FloatType, T.DoubleType)):
        return float(value)
    if isinstance(to, T.StringType):
        return str(value)
    if isinstance(to, T.BinaryType):
        return str(value).encode()
    if isinstance(to, T.ArrayType):
        return [_python(v, to.elementType) for v in value]
    if isinstance(to, T.MapType):
        return {_python(k, to.keyType): _python(v, to.valueType) for k, v in value.items()}
    if isinstance(to, T.StructType):
        given = [value.get(f.name) for f in to] if isinstance(value, dict) else value
        return tuple(_python(v, f.dataType) for v, f in zip(given, to, strict=True))
    return value


def _flat(options: dict, before: str = "") -> dict:
    """Options by dotted names."""
    out = {}
    for k, v in options.items():
        out |= _flat(v, f"{before}{k}.") if isinstance(v, dict) and k != "schema" else {f"{before}{k}": v}
    return out


def _fake(job: Job, options: dict, name: str) -> Tables:
    out = {}
    for one in options.get("tables_configs") or [options]:
        schema = _schema(one)
        if schema is None:
            raise JobError("FakeSource needs a schema")
        rows = one.get("rows")
        if rows is not None:
            rows = [{"kind": r.get("kind", "INSERT"), "fields": [_python(v, f.dataType) for v, f in zip(r["fields"], schema, strict=True)]} for r in rows]
        parallelism = int(option(options, "parallelism") or job.env.get("parallelism", 1))
        out[option(one, "schema.table", name)] = _keyed(readers.fake(job.spark, schema, int(option(one, "row.num", 5)), parallelism, rows, options=_flat({**options, **one}), stream=job.streaming), one)
    return out


#: Options of a file source or sink that Spark's reader and writer know by another name.
_FILE_OPTIONS = {"field_delimiter": "sep", "xml_row_tag": "rowTag", "encoding": "encoding", "null_format": "nullValue", "date_format": "dateFormat", "datetime_format": "timestampFormat", "compress_codec": "compression", "recursive_file_lookup": "recursiveFileLookup"}


def _file_options(options: dict, kind: str, reading: bool) -> dict:
    out = {to: options[name] for name, to in _FILE_OPTIONS.items() if name in options}
    if kind == "text" and "sep" in out:
        out["field_delimiter"] = out.pop("sep")
    if reading:
        out.pop("compression", None)
    if kind == "csv":
        if int(options.get("skip_header_row_number", 0)) == 1 or options.get("enable_header_write") or options.get("csv_use_header_line"):
            out["header"] = "true"
        mode = str(options.get("csv_string_quote_mode", "MINIMAL")).upper()
        if mode == "ALL":
            out["quoteAll"] = "true"
        elif mode == "NONE":
            out["quote"] = ""
    if kind == "xml":
        if options.get("xml_root_tag"):
            out["rootTag"] = options["xml_root_tag"]
    return out


def _files(plugin: str) -> Callable[[Job, dict, str], Tables]:
    return lambda job, options, name: _read_files(job, plugin, options, name)


def _read_files(job: Job, plugin: str, options: dict, name: str) -> Tables:
    out = {}
    for one in options.get("tables_configs") or [options]:
        one = {**one, "path": stores.located(job.spark, plugin, one)}
        kind = one.get("file_format_type", "parquet").lower()
        table = option(one, "schema.table", name)
        skip = int(one.get("skip_header_row_number", 0))
        if job.streaming:
            df = streaming.stream_files(job.spark, one["path"], _schema(one), kind, one.get("max_files_per_trigger"))
        elif one.get("bucketed"):
            df = buckets.read(job.spark, one["path"])
        elif kind in formats.READERS:
            df = formats.READERS[kind](job.spark, one["path"], _schema(one), one)
        elif skip > 1 and kind in ("csv", "text"):
            df = formats.read_after(job.spark, one["path"], _schema(one), skip, str(one.get("field_delimiter", "," if kind == "csv" else "\x01")))
        elif kind == "xml" and one.get("xml_use_attr_format"):
            df = formats.read_attributes(job.spark, one["path"], _schema(one), one["xml_row_tag"])
        elif kind in cdc.DECODERS:
            lines = job.spark.read.text(one["path"])
            df = cdc.DECODERS[kind](lines, _schema(one), ignore_parse_errors=bool(one.get("ignore_parse_errors", False)))
        else:
            df = readers.read_files(job.spark, one["path"], kind, _schema(one), one.get("read_columns"), **_file_options(one, kind, True))
        out[table] = _keyed(df, one)
    return out


def _hive(job: Job, options: dict, name: str) -> Tables:
    return {options["table_name"]: job.spark.table(options["table_name"])}


def _jdbc(job: Job, options: dict, name: str) -> Tables:
    if job.streaming:
        flat, out = _flat(options), {}
        for one in options.get("table_list") or [options]:
            given, schema = {**flat, **_flat(one)}, _schema({**options, **one})
            given["dbapi.connect"] = option({**options, **one}, "dbapi.connect")
            lacking = [n for n in ("dbapi.module", "dbapi.connect", "table_path", "partition_column") if given.get(n) is None]
            if lacking or schema is None:
                raise JobError(f"a stream of a Jdbc table needs {', '.join([*lacking, *([] if schema else ['schema'])])}")
            out[given["table_path"]] = _keyed(increasing.stream(job.spark, given, schema), one)
        return out
    listed = list(options.get("table_list") or [])
    if options.get("table_pattern"):
        matched = jdbc.tables_like(job.spark, options, options["table_pattern"])
        if not matched:
            raise JobError(f"no table matches {options['table_pattern']}")
        listed += [{"table_path": t} for t in matched]
    return {one.get("table_path", name): _keyed(jdbc.read(job.spark, {**options, **one}), one) for one in listed or [options]}


#: Sources of changes, by the database whose log is read.
CAPTURED = ("MySQL-CDC", "PostgreSQL-CDC", "Oracle-CDC", "SqlServer-CDC", "TiDB-CDC", "Opengauss-CDC", "MongoDB-CDC")


def _captured(plugin: str) -> Callable[[Job, dict, str], Tables]:
    """Tables and then their changes, from a log kept as files (`log.path`); the tables are read over JDBC."""

    def make(job: Job, options: dict, name: str) -> Tables:
        flat = _flat(options)
        out = {}
        for one in options.get("table-names-config") or [{"table": t} for t in options.get("table-names") or [name]]:
            table = one["table"]
            database = {"url": flat.get("base-url"), "table_path": table, **{k: flat[k] for k in ("username", "password", "driver", "properties") if k in flat}}
            database |= {"split.size": flat.get("snapshot.split.size", splits.SIZE), "fetch_size": flat.get("snapshot.fetch.size", 1024)}
            database |= {f"split.{k}": flat[f"{theirs}{k}"] for theirs, k in (("chunk-key.", "even-distribution.factor.lower-bound"), ("chunk-key.", "even-distribution.factor.upper-bound"), ("", "sample-sharding.threshold")) if f"{theirs}{k}" in flat}
            if one.get("snapshotSplitColumn"):
                database["partition_column"] = one["snapshotSplitColumn"]
            schema = _schema({**options, **one})
            keys = list(one.get("primaryKeys") or option(options.get("schema") or {}, "primaryKey.columnNames") or [])
            if database["url"]:
                schema = schema or jdbc.read(job.spark, database).schema
                keys = keys or jdbc.table_key(job.spark, database, table)
            if schema is None:
                raise JobError(f"{plugin} needs a schema or a base-url")
            read = (lambda d=database, s=schema: jdbc.read(job.spark, d).toDF(*s.names).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in s])) if database["url"] else None
            folder = job.checkpoint(f"{plugin}_{table}" + ("" if job.streaming else f"_{job.id}"))
            if str(flat.get("schema-changes.enabled", False)).lower() == "true" and job.streaming:
                df = job.spark.readStream.format("text").schema("value string").load(flat["log.path"])
                job.evolving[id(df)] = {"frame": df, "log": flat["log.path"], "schema": schema, "keys": keys, "options": flat, "folder": f"{folder}_capture", "read": read, "table": table}
                out[table] = df
                continue
            df = capture.capture(job.spark, flat["log.path"], schema, keys, flat, f"{folder}_capture", read, table, job.streaming)
            out[table] = with_key(df, keys) if keys else df
        return out

    return make


def _kafka(job: Job, options: dict, name: str) -> Tables:
    reader = job.spark.readStream if job.streaming else job.spark.read
    df = reader.format("kafka").options(**connectors.kafka_read(options)).load()
    if options.get("format") == "protobuf":
        return {name: _keyed(protobuf.decode(df, _schema(options), options["protobuf_schema"], options["protobuf_message_name"], bool(options.get("ignore_parse_errors", False))), options)}
    ignored = options.get("ignore_parse_errors", options.get("format_error_handle_way", "fail") == "skip")
    return {name: _keyed(connectors.decoded(df, options.get("format", "json"), _schema(options), options.get("field_delimiter", ","), bool(ignored)), options)}


def _http(service: str) -> Callable[[Job, dict, str], Tables]:
    def make(job: Job, options: dict, name: str) -> Tables:
        return {name: _keyed(http.read(job.spark, options, _schema(options), service, job.streaming), options)}

    return make


_STORES = ("LocalFile", "HdfsFile", "S3File", "OssFile", "OssJindoFile", "CosFile", "ObsFile", "FtpFile", "SftpFile")
SOURCES: dict[str, Callable[[Job, dict, str], Tables]] = {"FakeSource": _fake, "Hive": _hive, "Jdbc": _jdbc, "Kafka": _kafka, **{c: _captured(c) for c in CAPTURED}, **{s: _http(s) for s in http.SERVICES}, **{n: _files(n) for n in _STORES}}


def _with_client(name: str):
    def run(df: DataFrame, job: Job, **options) -> DataFrame:
        client = job.clients.get(name)
        if client is None:
            if not options.get("model_provider"):
                raise JobError(f"{name} needs a client or a model_provider")
            client = models.client(name, options)
        known = ("prompt", "inference_columns", "output_column_name", "output_data_type") if name == "LLM" else ("vectorization_fields", "single_vectorized_input_number")
        return getattr(tr, name.lower())(df, client=client, **{k: options[k] for k in known if k in options})

    return run


TRANSFORMS: dict[str, Callable[..., DataFrame]] = {"Sql": sql, "FieldMapper": tr.field_mapper, "Filter": tr.filter_fields, "FilterRowKind": tr.filter_row_kind, "RowKindExtractor": tr.row_kind_extractor, "Replace": tr.replace, "Split": tr.split, "Copy": tr.copy, "JsonPath": tr.json_path, "FieldRename": tr.field_rename, "Metadata": tr.metadata}
TABLE_TRANSFORMS: dict[str, Callable[..., Tables]] = {"TableRename": tr.table_rename, "TableMerge": tr.table_merge}


def _compiled(df: DataFrame, job: Job, options: dict) -> DataFrame:
    """Code of a job file: Python that defines `columns`, types by name, and `values`, from a pandas frame to a frame of them.

    It runs only where `env.allow.inline.code` says so.
    """
    if str(option(job.env, "allow.inline.code", False)).lower() != "true":
        raise JobError("DynamicCompile needs env.allow.inline.code = true")
    if str(options.get("compile_language", "PYTHON")).upper() != "PYTHON":
        raise JobError(f"DynamicCompile runs PYTHON, not {options['compile_language']}")
    if options.get("absolute_path"):
        with open(options["absolute_path"], encoding="utf-8") as f:
            code = f.read()
    else:
        code = options["source_code"]
    names: dict = {}
    exec(compile(code, "source_code", "exec"), names)  # noqa: S102  the job's own code, allowed above
    return tr.dynamic_compile(df, names["columns"], names["values"])


def _transform(job: Job, plugin: str, tables: Tables, options: dict) -> Tables:
    key = plugin.lower()
    for name, change in TABLE_TRANSFORMS.items():
        if name.lower() == key:
            return change(tables, **options)
    found = next((f for n, f in TRANSFORMS.items() if n.lower() == key), None)
    if key in ("llm", "embedding"):
        call = _with_client({"llm": "LLM", "embedding": "Embedding"}[key])
        found = lambda df, **o: call(df, job, **o)
    if key == "dynamiccompile":
        found = lambda df, **o: _compiled(df, job, o)
    found = found or job.plugins.get(plugin)
    if found is None:
        raise JobError(f"no transform {plugin}")
    regex, own = options.pop("table_match_regex", ".*"), options.pop("table_transform", None)
    return tr.route(tables, found, options, regex, own)


def _console(job: Job, df: DataFrame, path: str, options: dict):
    if df.isStreaming:
        return df.writeStream.format("console").trigger(availableNow=True).start()
    df.show(int(options.get("limit", 20)), truncate=False)


def _assert(job: Job, df: DataFrame, path: str, options: dict):
    given = options.get("rules") or {}
    return sinks.assert_sink(df, given.get("row_rules"), given.get("field_rules"), given.get("catalog_table_rule"), given.get("table-names"), path)


def _values(job: Job, df: DataFrame, path: str) -> dict[str, str]:
    return sinks.table_values(path, df, tuple(primary_key(df)))


def _keys(df: DataFrame, options: dict) -> list[str]:
    return list(options.get("primary_keys") or primary_key(df))


def _to_files(plugin: str) -> Callable[[Job, DataFrame, str, dict], object]:
    return lambda job, df, path, options: _save_files(job, df, path, {**options, "path": stores.located(job.spark, plugin, options)})


def _save_files(job: Job, df: DataFrame, path: str, options: dict):
    kind = options.get("file_format_type", "parquet").lower()
    target = sinks.placeholders(options["path"], _values(job, df, path))
    if options.get("bucket_num"):
        keys = _keys(df, options)
        if not keys:
            raise JobError("bucket_num needs primary_keys")
        put = lambda rows, batch: buckets.upsert(rows, target, keys, options.get("order_by"), int(options["bucket_num"]), kind, target, batch)
        return streaming.write_batches(df, put, job.checkpoint(target), job.interval) if df.isStreaming else put(df, None)
    if df.isStreaming:
        return streaming.write_files(df.drop(*sinks.HIDDEN), target, job.checkpoint(target), job.interval, kind)
    if changes.is_changelog(df) and _keys(df, options):
        changes.upsert_files(df, target, _keys(df, options), kind, options.get("order_by"), **_file_options(options, kind, False))
        return None
    df = changes.plain_rows(df, target)
    modes = {"DROP_DATA": "overwrite", "ERROR_WHEN_DATA_EXISTS": "errorifexists"}
    mode = modes.get(options.get("data_save_mode"), "append")
    if kind == "xml" and options.get("xml_use_attr_format"):  # a column named with the prefix is written as an attribute
        df = df.toDF(*[f"_{c}" for c in df.columns])
    if kind in formats.WRITERS:
        formats.WRITERS[kind](df, target, mode, options)
    else:
        sinks.save_files(df, target, kind, options.get("partition_by"), options.get("sink_columns"), mode, bool(options.get("single_file_mode", False)), **_file_options(options, kind, False))
    if options.get("custom_filename"):
        sinks.name_files(job.spark, target, options.get("file_name_expression", "${transactionId}"), options.get("filename_time_format", "yyyy.MM.dd"), job.id)
    return None


def _save_table(job: Job, df: DataFrame, path: str, options: dict):
    name = sinks.placeholders(options["table_name"], _values(job, df, path))
    if changes.is_changelog(df) and _keys(df, options):
        changes.upsert_table(df, name, _keys(df, options), options.get("order_by"))
        return
    sinks.save_table(changes.plain_rows(df, name), name, options.get("schema_save_mode", "CREATE_SCHEMA_WHEN_NOT_EXIST"), options.get("data_save_mode", "APPEND_DATA"), options.get("custom_sql"))


def _save_jdbc(job: Job, df: DataFrame, path: str, options: dict):
    table = sinks.placeholders(options["table"], _values(job, df, path))
    if int(job.env.get("job.retry.times", 0)):  # a second try must not add rows twice
        options = {**options, "is_exactly_once": True}
    writer, epoch = options.pop("_batch", (None, None))
    if (path, table) not in job.prepared:
        if epoch is None or jdbc.epoch_of(job.spark, options, writer) is None:  # a job that goes on leaves its rows
            jdbc.prepare(df, options, table)
        job.prepared.add((path, table))
    jdbc.write(df, options, table, writer, epoch)


def _save_kafka(job: Job, df: DataFrame, path: str, options: dict):
    if options.get("format") == "protobuf":
        made = protobuf.encode(changes.plain_rows(df, options["topic"]), options["protobuf_schema"], options["protobuf_message_name"])
        made.write.format("kafka").options(**connectors.kafka_write(options)).save()
        return
    connectors.encoded(df, options.get("format", "json"), options.get("partition_key_fields"), options.get("field_delimiter", ",")).write.format("kafka").options(**connectors.kafka_write(options)).save()


def _save_http(job: Job, df: DataFrame, path: str, options: dict):
    http.write(changes.plain_rows(df, options["url"]), options)


def _service(name: str) -> Callable[[Job, DataFrame, str, dict], object]:
    def save(job: Job, df: DataFrame, path: str, options: dict):
        services.write(df, name, options, _values(job, df, path))

    return save


def _package(name: str) -> Callable[[Job, DataFrame, str, dict], object]:
    return lambda job, df, path, options: packages.write(df, name, options, _keys(df, options))


def _from_package(name: str) -> Callable[[Job, dict, str], Tables]:
    return lambda job, options, called: {called: _keyed(packages.read(job.spark, name, options, _schema(options), job.streaming), options)}


def _iceberg(job: Job, options: dict, name: str) -> Tables:
    tables = [t["table"] if isinstance(t, dict) else t for t in options.get("table_list") or [options["table"]]]
    return {f"{options['namespace']}.{t}": _keyed(packages.read_iceberg(job.spark, options, t), options) for t in tables}


def _save_iceberg(job: Job, df: DataFrame, path: str, options: dict):
    keys = options.get("iceberg.table.primary-keys")
    table = sinks.placeholders(options["table"], _values(job, df, path)) if options.get("table") else path.split(".")[-1]
    packages.write_iceberg(df, options, keys.split(",") if keys else _keys(df, options), table)


def _save_redshift(job: Job, df: DataFrame, path: str, options: dict):
    """Files in the store, then the statement that loads them; ${path} is where they are."""
    where = f"{stores.located(job.spark, 'S3File', options).rstrip('/')}/{job.id}"
    kind = options.get("file_format_type", "parquet").lower()
    sinks.save_files(changes.plain_rows(df, where), where, kind, options.get("partition_by"), options.get("sink_columns"), "overwrite", **_file_options(options, kind, False))
    database = {"url": options["jdbc_url"], "user": options["jdbc_user"], "password": options["jdbc_password"], "driver": options.get("jdbc_driver")}
    jdbc.execute(job.spark, database, options["execute_sql"].replace("${path}", where.replace("s3a://", "s3://")))


def _from_service(name: str) -> Callable[[Job, dict, str], Tables]:
    def load(job: Job, options: dict, called: str) -> Tables:
        if job.streaming:
            raise JobError(f"{name} is read in batch jobs only")
        return {called: _keyed(services.read(job.spark, name, options, _schema(options)), options)}

    return load


def _batches(job: Job, df: DataFrame, path: str, options: dict, write, plugin: str):
    """A sink of batch jobs on a stream: its code runs on each batch."""
    name = f"{plugin}_{path}_{options.get('table') or options.get('topic') or options.get('table_name') or options.get('url') or ''}"
    where = job.checkpoint(name)
    numbered = (lambda i: {"_batch": (where[-255:], i)}) if plugin.lower() == "jdbc" else (lambda i: {})
    return streaming.write_batches(df, lambda batch, i: write(job, batch, path, {**options, **numbered(i)}), where, job.interval)


def _evolve(job: Job, source: dict, path: str, options: dict, plugin: str):
    """A table whose columns change, kept in a JDBC table or in a bucketed folder."""
    keys = list(options.get("primary_keys") or source["keys"])
    name = sinks.placeholders(str(options.get("table") or options.get("path") or ""), sinks.table_values(path, source["frame"], tuple(keys)))
    where = job.checkpoint(f"{plugin}_{path}_{name}")
    if plugin.lower() == "jdbc":
        target: evolving.Target = evolving.JdbcTarget(job.spark, {**options, "primary_keys": keys}, name, where[-255:])
    elif options.get("bucket_num"):
        target = evolving.BucketTarget(job.spark, name, keys, where, int(options["bucket_num"]))
    else:
        raise JobError(f"{plugin} cannot follow changes of columns; Jdbc and files with bucket_num can")
    marks = capture.begin_of(job.spark, source["log"], source["schema"], keys, source["options"], source["folder"], source["read"], source["table"], True)
    begin = capture.Place(**marks["begin"]) if marks["begin"] else capture.NOWHERE
    if marks["initial"]:
        target.write(job.spark.read.parquet(f"{source['folder']}/rows"), 0)
    return evolving.follow(job.spark, source["log"], source["schema"], source["folder"], target, where, source["table"], begin, job.interval)


#: Sinks that take a stream as it is.
STREAMED = ("Console", *_STORES)
SOURCES |= {**{n: _from_package(n) for n in packages.READ}, **{n: _from_service(n) for n in services.READ}, "Iceberg": _iceberg}
SINKS: dict[str, Callable[[Job, DataFrame, str, dict], object]] = {"Console": _console, "Assert": _assert, "Hive": _save_table, "Jdbc": _save_jdbc, "Kafka": _save_kafka, "Http": _save_http, **{n: _service(n) for n in services.WRITTEN}, **{n: _package(n) for n in packages.WRITTEN if n not in services.WRITTEN}, "Iceberg": _save_iceberg, "S3-Redshift": _save_redshift, **{n: _to_files(n) for n in _STORES}}
rules.declare(_STORES, tuple(http.SERVICES), CAPTURED)


def _inputs(job: Job, options: dict, last: str | None) -> Tables:
    """The datasets that a step reads; several are put one after the other, table by table."""
    names = options.pop("plugin_input", None) or options.pop("source_table_name", None) or last
    names = [names] if isinstance(names, str) else list(names or [])
    if not names:
        raise JobError("a step has no input")
    for n in names:
        if n not in job.datasets:
            raise JobError(f"no dataset {n}; there are {sorted(job.datasets)}")
    if len(names) == 1:
        return dict(job.datasets[names[0]])
    if all(len(job.datasets[n]) == 1 for n in names):
        frames = [next(iter(job.datasets[n].values())) for n in names]
        return {next(iter(job.datasets[names[0]])): sinks.union(frames)}
    out: Tables = {}
    for n in names:
        for path, df in job.datasets[n].items():
            out[path] = out[path].unionByName(df) if path in out else df
    return out


def _put(job: Job, name: str, tables: Tables) -> None:
    """Steps with the same output name add their rows to it."""
    old = job.datasets.get(name)
    if old and len(old) == len(tables) == 1:
        (path, a), (b,) = next(iter(old.items())), tables.values()
        job.datasets[name] = {path: a.unionByName(b)}
        return
    merged = dict(old or {})
    for path, df in tables.items():
        merged[path] = merged[path].unionByName(df) if path in merged else df
    job.datasets[name] = merged


#: Options that `shade.identifier` covers.
SHADED = ("username", "user", "password", "auth", "token", "access_key", "secret_key")


def unshade(options: dict, identifier: str | None, names: tuple[str, ...] = SHADED) -> dict:
    """Options with their hidden values in clear; the one built-in identifier is base64."""
    if identifier in (None, "default"):
        return options
    if identifier != "base64":
        raise JobError(f"unknown shade.identifier {identifier}")
    return {k: base64.b64decode(v).decode() if k in names and isinstance(v, str) else v for k, v in options.items()}


def _retried(work: Callable[[], object], times: int, wait: float):
    for left in range(times, -1, -1):
        try:
            return work()
        except (JobError, sinks.AssertFailed, sinks.SaveModeError):
            raise
        except Exception:
            if not left:
                raise
            time.sleep(wait)


def _width(df: DataFrame):
    """Bytes of a row: fixed ones of numbers, times and flags, and the lengths of texts; of nested values those of their JSON."""
    fixed = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}
    total, parts = 0, []
    for f in df.schema:
        column = F.col("`" + f.name.replace("`", "``") + "`")
        if type(f.dataType) in fixed:
            total += fixed[type(f.dataType)]
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)))
    out = F.lit(total).cast("long")
    for p in parts:
        out = out + p
    return out


def _watched(job: Job, query, name: str):
    """A started query with its counters, and with a watchdog where `checkpoint.timeout` (milliseconds) says so."""
    if not hasattr(query, "isActive"):
        return query
    job.spark.streams.addListener(streaming.Counters(query, job.metrics, name))
    if timeout := job.env.get("checkpoint.timeout"):
        streaming.watch(query, float(timeout) / 1000, lambda why: job.say("JOB_FAILED", why))
    return query


def _counted(job: Job, df: DataFrame, group: str, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """A frame that counts its rows and bytes as a sink reads them, and what puts them and their rates into the job's metrics.

    Spark counts a task's rows once, however often it runs.  Bytes are those of
    numbers as they are held, and of texts in UTF-8.
    """
    seen, begin = Observation(f"{group}_{uuid.uuid4().hex[:8]}"), time.monotonic()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_width(df)).alias("bytes"))

    def put() -> None:
        got: list[dict] = []
        look = threading.Thread(target=lambda: got.append(seen.get), daemon=True)
        look.start()
        look.join(10)  # a sink that never read the frame leaves no count
        if got:
            took = max(time.monotonic() - begin, 1e-3)
            for what, n in (("Count", got[0]["rows"]), ("Bytes", got[0]["bytes"] or 0)):
                of = job.metrics.setdefault(group.replace("Count", what), {})
                of[name] = of.get(name, 0) + n
                job.metrics.setdefault(group.replace("Count", {"Count": "QPS", "Bytes": "BytesPerSeconds"}[what]), {})[name] = n / took

    return counted, put


def _limited(job: Job, tables: Tables) -> Tables:
    """Sources slowed down to `read_limit.rows_per_second` over all of a job's tasks."""
    limit = option(job.env, "read_limit.rows_per_second")
    return {p: streaming.throttled(df, int(limit)) for p, df in tables.items()} if limit else tables


def _find(job: Job, plugin: str, known: dict):
    return job.plugins.get(plugin) or known.get(plugin) or next((f for n, f in known.items() if n.lower() == plugin.lower()), None)


#: Options of `env` that may be written nested.
_ENV = ("job.mode", "job.name", "job.retry.times", "job.retry.interval.seconds", "checkpoint.interval", "checkpoint.timeout", "checkpoint.path", "shade.identifier", "restore.from")


def run_job(spark: SparkSession, job: dict | str, variables: dict[str, str] | None = None, plugins: dict[str, Callable] | None = None, clients: dict[str, Callable] | None = None, listener: Callable[[str, str], None] | None = None) -> Job:
    """Run a job: a dict, the text of a job file, or its path (.sql for SQL jobs).

    `plugins` are further transforms, sources (job, options, name) and sinks
    (job, frame, path, options) by plugin name.  All options are checked before
    anything is read.  A streaming job's queries are in `results`; a batch job
    has ended when this returns, and its `metrics` hold the rows that each sink
    read.  A sink is tried again as `job.retry.times` says; an Assert that fails
    is not.  Http, Kafka and the services get rows at least once.
    """
    if isinstance(job, str):
        one_line = "\n" not in job and "{" not in job
        job = config.load(job, variables) if one_line else (config.parse_sql_job if re.search(r"(?im)^\s*create\s+table\b", job) else config.parse)(job, variables)
    env = dict(job.get("env") or {})
    for name in _ENV:
        if (v := option(env, name)) is not None:
            env[name] = v
    now = Job(spark, env, plugins or {}, clients or {}, listener=listener)
    shade = env.get("shade.identifier")
    spark.sparkContext.setLocalProperty("weftline.job.id", now.id)
    if env.get("job.name"):
        spark.sparkContext.setJobDescription(str(env["job.name"]))
    steps = {kind: [(p, unshade(o, shade)) for p, o in config.steps(job.get(kind))] for kind in ("source", "transform", "sink")}
    for kind in ("source", "sink"):
        for plugin, options in steps[kind]:
            if plugin not in now.plugins:
                rules.RULES.check(kind, plugin, options)
    now.say("JOB_STARTED", now.id)
    kept: list[DataFrame] = []
    try:
        _run(now, steps, kept)
        services.settle()
    except Exception as e:
        now.say("JOB_FAILED", str(e)[:500])
        services.settle(safe=False)
        raise
    finally:
        for df in kept:
            df.unpersist()
        with contextlib.suppress(Exception):
            spark.sparkContext.setLocalProperty("weftline.job.id", None)
    now.say("JOB_RUNNING" if now.streaming else "JOB_FINISHED", now.id)
    return now


def _run(now: Job, steps: dict, kept: list[DataFrame]) -> None:
    last = None
    for i, (plugin, options) in enumerate(steps["source"]):
        make = _find(now, plugin, SOURCES)
        if make is None:
            raise JobError(f"no source {plugin}")
        last = options.pop("plugin_output", None) or options.pop("result_table_name", None) or f"source_{i}"
        mode = options.pop("parsing_mode", "SINGLENESS").upper()
        tables = _limited(now, make(now, options, last))
        if mode == "SHARDING" and len(tables) > 1:  # shards of one table, read by the first one's schema
            first = next(iter(tables))
            tables = {first: sinks.union([df.select(*tables[first].columns) for df in tables.values()])}
        _put(now, last, tables)
        now.say("SOURCE_OPENED", plugin)
    for i, (plugin, options) in enumerate(steps["transform"]):
        if now.evolving:
            raise JobError("transforms take no part where columns change")
        tables = _inputs(now, options, last)
        last = options.pop("plugin_output", None) or options.pop("result_table_name", None) or f"transform_{i}"
        _put(now, last, _transform(now, plugin, tables, options))
    work = []
    for plugin, options in steps["sink"]:
        write = _find(now, plugin, SINKS)
        if write is None:
            raise JobError(f"no sink {plugin}")
        work += [(plugin, options, write, path, df) for path, df in _inputs(now, options, last).items()]
    frames = [id(w[4]) for w in work]
    held: dict[int, DataFrame] = {}
    for plugin, options, write, path, df in work:
        if frames.count(id(df)) > 1 and not df.isStreaming:
            if id(df) not in held:
                held[id(df)] = df.persist(StorageLevel.DISK_ONLY)
                kept.append(held[id(df)])
            df = held[id(df)]
        if options.get("parallelism"):
            df = df.repartition(int(options["parallelism"]))
        if id(df) in now.evolving:
            put = None
            run = lambda df=df, path=path, options=options, plugin=plugin: _evolve(now, now.evolving[id(df)], path, dict(options), plugin)
        elif df.isStreaming and plugin not in STREAMED:
            run = lambda df=df, path=path, options=options, write=write, plugin=plugin: _batches(now, df, path, options, write, plugin)
            put = None
        else:
            put = None
            if not df.isStreaming and plugin not in now.plugins and plugin != "Console" and not changes.is_changelog(df):
                df, put = _counted(now, df, "SinkWriteCount", f"{plugin}.{path}")
            run = lambda df=df, path=path, options=options, write=write: write(now, df, path, dict(options))
        if df.isStreaming and now.env.get("restore.from"):
            streaming.restore(now.spark, str(now.env["restore.from"]), str(now.env.get("checkpoint.path") or now.spark.conf.get("spark.checkpoint.dir")))
            now.env.pop("restore.from")
        done = _retried(run, int(now.env.get("job.retry.times", 0)), float(now.env.get("job.retry.interval.seconds", 3)))
        now.results.append(_watched(now, done, f"{plugin}.{path}"))
        if put:
            put()
        now.say("SINK_CLOSED" if not df.isStreaming else "SINK_STARTED", plugin)


def savepoint(job: Job, path: str) -> None:
    """Stops a streaming job and copies what it has done, so that a job with `restore.from` goes on from there."""
    for q in job.results:
        if hasattr(q, "stop"):
            q.processAllAvailable()
            q.stop()
    source = str(job.env.get("checkpoint.path") or job.spark.conf.get("spark.checkpoint.dir"))
    streaming.copy_folder(job.spark, source, path)
    job.say("SAVEPOINT", path)
