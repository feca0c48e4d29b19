"""Options of external systems in Spark's terms, and the encoding of messages.

JDBC drivers and the Kafka package are not part of Spark; these functions are
what a session that has them needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.sql import HIDDEN
from weftline.sources import cdc


def _named(options: dict, names: dict[str, str]) -> dict[str, str]:
    return {to: str(options[name]) for name, to in names.items() if options.get(name) is not None}


_JDBC = {"url": "url", "driver": "driver", "user": "user", "username": "user", "password": "password", "connection_check_timeout_sec": "queryTimeout"}


def jdbc_read(options: dict) -> dict[str, str]:
    """A query or a table, with its filter; with a partition column and bounds, one range a task."""
    out = _named(options, {**_JDBC, "fetch_size": "fetchsize"})
    query = options.get("query")
    table = options.get("table_path")
    if not query and not table:
        raise ValueError("jdbc needs query or table_path")
    if not query and options.get("where_condition"):
        query = f"SELECT * FROM {table} {options['where_condition']}"
    out["dbtable"] = f"({query}) q" if query else table
    if options.get("partition_column"):
        missing = [n for n in ("partition_lower_bound", "partition_upper_bound") if options.get(n) is None]
        if missing:
            raise ValueError(f"partition_column needs {', '.join(missing)}")
        out |= {"partitionColumn": options["partition_column"], "lowerBound": str(options["partition_lower_bound"]), "upperBound": str(options["partition_upper_bound"]), "numPartitions": str(options.get("partition_num", 10))}
    return out | {k: str(v) for k, v in (options.get("properties") or {}).items()}


def jdbc_write(options: dict, table: str) -> dict[str, str]:
    return _named(options, {**_JDBC, "batch_size": "batchsize"}) | {"dbtable": table} | {k: str(v) for k, v in (options.get("properties") or {}).items()}


def kafka_read(options: dict) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": options["bootstrap.servers"], ("subscribePattern" if options.get("pattern") else "subscribe"): options["topic"]}
    mode = options.get("start_mode", "group_offsets")
    if mode in ("earliest", "latest"):
        out["startingOffsets"] = mode
    elif mode == "timestamp":
        out["startingTimestamp"] = str(options["start_mode.timestamp"])
    elif mode == "specific_offsets":
        found: dict[str, dict[str, int]] = {}
        for name, at in options["start_mode.offsets"].items():
            topic, _, partition = name.rpartition("-")
            found.setdefault(topic, {})[partition] = int(at)
        import json

        out["startingOffsets"] = json.dumps(found)
    elif mode == "group_offsets":
        # Spark keeps its own offsets in the checkpoint; without one, it starts where a group without offsets would.
        reset = (options.get("kafka.config") or {}).get("auto.offset.reset", "latest")
        out["startingOffsets"] = reset if reset in ("earliest", "latest") else "latest"
    if options.get("consumer.group"):
        out["kafka.group.id"] = options["consumer.group"]
    return out | {f"kafka.{k}": str(v) for k, v in (options.get("kafka.config") or {}).items()}


def kafka_write(options: dict) -> dict[str, str]:
    return {"kafka.bootstrap.servers": options["bootstrap.servers"], "topic": options["topic"]} | {f"kafka.{k}": str(v) for k, v in (options.get("kafka.config") or {}).items()}


#: What a Kafka message says beside its value, as row metadata.
_ABOUT = {"EventTime": "CAST(unix_millis(timestamp) AS string)", "Partition": "CAST(partition AS string)", "Offset": "CAST(offset AS string)", "Topic": "topic", "Key": "CAST(key AS string)"}


def _about(df: DataFrame):
    """The metadata of messages that have it, as `_options`."""
    if not {"timestamp", "partition"} & set(df.columns):
        return None
    columns = {"EventTime": "timestamp", "Partition": "partition", "Offset": "offset", "Topic": "topic", "Key": "key"}
    there = [n for n, c in columns.items() if c in df.columns]
    if "timestamp" in df.columns:
        there.append("Delay")
    sql = {**_ABOUT, "Delay": "CAST(unix_millis(current_timestamp()) - unix_millis(timestamp) AS string)"}
    return F.create_map(*[x for n in there for x in (F.lit(n), F.expr(sql[n]))])


def decoded(df: DataFrame, format: str, schema: T.StructType | None, field_delimiter: str = ",", ignore_parse_errors: bool = False) -> DataFrame:
    """Rows of a `value` column of messages; without a schema, its text as `content`.

    A message that does not parse fails the job, unless `ignore_parse_errors`
    passes it over.  A message's time, partition, offset, topic and key, where
    the frame has them, ride along as `_options`, but for changelogs.
    """
    about = _about(df)
    text = df.select(F.col("value").cast("string").alias("value"), *([about.alias("_options")] if about is not None else []))
    rest = ["_options"] if about is not None else []
    if schema is None:
        return text.withColumnRenamed("value", "content")
    if format.lower() in cdc.DECODERS:
        return cdc.DECODERS[format.lower()](text.select("value"), schema, ignore_parse_errors=ignore_parse_errors)
    if format == "json":
        bad = "_broken"
        if ignore_parse_errors:
            wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
            rows = text.select(F.from_json("value", wide, {"columnNameOfCorruptRecord": bad}).alias("r"), *rest)
            return rows.filter(f"r IS NOT NULL AND r.{bad} IS NULL").select(*[F.col(f"r.`{c}`") for c in schema.names], *rest)
        return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"), *rest).filter("r IS NOT NULL").select("r.*", *rest)
    if format == "text":
        return text.select(F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"sep": field_delimiter}).alias("r"), *rest).select("r.*", *rest)
    raise ValueError(f"unknown format {format}")


def encoded(df: DataFrame, format: str, key_fields: list[str] | None = None, field_delimiter: str = ",") -> DataFrame:
    """Messages with a key of the given fields, as JSON, delimited text or a changelog.

    Of compatible_debezium_json the rows are messages already: key and value pass as they are.
    """
    if format == "compatible_debezium_json":
        return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    names = [c for c in df.columns if c not in HIDDEN]
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    if format == "json":
        value = F.to_json(row, {"ignoreNullFields": "false"})
    elif format == "text":
        value = F.concat_ws(field_delimiter, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names])
    elif format.lower() in cdc.ENCODERS:
        keyed = df.withColumn("_key", F.to_json(F.struct(*[F.col(f"`{c}`") for c in key_fields])) if key_fields else F.lit(None).cast("string"))
        return cdc.ENCODERS[format.lower()](keyed, "_key")
    else:
        raise ValueError(f"unknown format {format}")
    key = F.to_json(F.struct(*[F.col(f"`{c}`") for c in key_fields])) if key_fields else F.lit(None).cast("string")
    return df.select(key.alias("key"), value.alias("value"))
