"""Systems reached by Spark packages: their plugins' options in the packages' terms.

The packages are not part of Spark; a session that has one on its class path,
or a catalog configured, reads and writes with what is built here.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.sources import changes
from weftline.sources.sinks import SaveModeError


def _host(text: str) -> tuple[str, str | None]:
    host, _, port = text.split(",")[0].partition(":")
    return host, port or None


def mongodb(options: dict) -> tuple[str, dict]:
    out = {"connection.uri": options["uri"], "database": options["database"], "collection": options["collection"]}
    steps = []
    if options.get("match.query"):
        steps.append({"$match": json.loads(options["match.query"])})
    if options.get("match.projection"):
        steps.append({"$project": json.loads(options["match.projection"])})
    if steps:
        out["aggregation.pipeline"] = json.dumps(steps)
    if options.get("primary-key") or options.get("primary_keys"):
        keys = options.get("primary-key") or options["primary_keys"]
        out |= {"idFieldList": keys if isinstance(keys, str) else ",".join(keys), "operationType": "replace" if options.get("upsert-enable", True) else "insert"}
    return "mongodb", out


def cassandra(options: dict) -> tuple[str, dict]:
    host, port = _host(options["host"])
    names = {"spark.cassandra.connection.host": host, "spark.cassandra.connection.port": port, "spark.cassandra.auth.username": options.get("username"), "spark.cassandra.auth.password": options.get("password"), "spark.cassandra.connection.localDC": options.get("datacenter"), "spark.cassandra.output.consistency.level": options.get("consistency_level"), "spark.cassandra.output.batch.size.rows": options.get("batch_size")}
    return "org.apache.spark.sql.cassandra", {"keyspace": options["keyspace"], "table": options.get("table") or "", **{k: str(v) for k, v in names.items() if v is not None}}


def kudu(options: dict) -> tuple[str, dict]:
    return "kudu", {"kudu.master": options["kudu_masters"], "kudu.table": options["table_name"], "kudu.operation": "upsert", **({"kudu.ignoreDuplicateRowErrors": "true"} if options.get("ignore_not_duplicate") else {})}


def hudi(options: dict) -> tuple[str, dict]:
    names = {"table_name": "hoodie.table.name", "table_type": "hoodie.datasource.write.table.type", "op_type": "hoodie.datasource.write.operation", "record_key_fields": "hoodie.datasource.write.recordkey.field", "partition_fields": "hoodie.datasource.write.partitionpath.field", "insert_shuffle_parallelism": "hoodie.insert.shuffle.parallelism", "upsert_shuffle_parallelism": "hoodie.upsert.shuffle.parallelism", "min_commits_to_keep": "hoodie.keep.min.commits", "max_commits_to_keep": "hoodie.keep.max.commits", "index_type": "hoodie.index.type", "cdc_enabled": "hoodie.table.cdc.enabled"}
    out = {to: str(options[n]).lower() if n in ("op_type", "cdc_enabled") else str(options[n]) for n, to in names.items() if options.get(n) is not None}
    return "hudi", {"path": f"{options['table_dfs_path'].rstrip('/')}/{options.get('database', 'default')}/{options['table_name']}", **out}


def paimon(options: dict) -> tuple[str, dict]:
    return "paimon", {"path": f"{options['warehouse'].rstrip('/')}/{options['database']}.db/{options['table']}"}


def hbase(options: dict) -> tuple[str, dict]:
    """The mapping is completed by the frame's columns when a frame is written."""
    key = options["rowkey_column"] if isinstance(options.get("rowkey_column"), list) else [options.get("rowkey_column", "rowkey")]
    return "org.apache.hadoop.hbase.spark", {"hbase.table": options["table"], "hbase.spark.use.hbasecontext": "false", "hbase.zookeeper.quorum": options["zookeeper_quorum"], "rowkey": ",".join(key), "family": json.dumps(options.get("family_name") or {"all_columns": "info"})}


def hbase_mapping(names: list[str], options: dict) -> str:
    """hbase.columns.mapping of a frame's columns: the key first, the others in their families."""
    key, families = options["rowkey"].split(",")[0], json.loads(options["family"])
    kind = lambda n: families.get(n, families.get("all_columns", "info"))
    return ", ".join(f"{n} STRING :key" if n == key else f"{n} STRING {kind(n)}:{n}" for n in names)


def pulsar(options: dict) -> tuple[str, dict]:
    mode = {"EARLIEST": "earliest", "LATEST": "latest"}.get(str(options.get("cursor.startup.mode", "LATEST")).upper())
    topic = {"topicsPattern": options["topic-pattern"]} if options.get("topic-pattern") else {"topic" if "," not in options["topic"] else "topics": options["topic"]}
    out = {"service.url": options["client.service-url"], "admin.url": options["admin.service-url"], "predefinedSubscription": options.get("subscription.name", ""), **topic}
    if mode:
        out["startingOffsets"] = mode
    elif options.get("cursor.startup.timestamp"):
        out["startingTime"] = str(options["cursor.startup.timestamp"])
    if options.get("auth.params"):
        out |= {"pulsar.client.authPluginClassName": options.get("auth.plugin-class", ""), "pulsar.client.authParams": options["auth.params"]}
    return "pulsar", out


def maxcompute(options: dict) -> tuple[str, dict]:
    return "org.apache.spark.sql.odps.datasource.DefaultSource", {"odpsUrl": options["endpoint"], "project": options["project"], "table": options["table_name"], "accessKeyId": options["accessId"], "accessKeySecret": options["accesskey"], **({"partitionSpec": options["partition_spec"]} if options.get("partition_spec") else {})}


def tablestore(options: dict) -> tuple[str, dict]:
    return "tablestore", {"endpoint": options["end_point"], "instance.name": options["instance_name"], "access.key.id": options["access_key_id"], "access.key.secret": options["access_key_secret"], "table.name": options["table"]}


def sls(options: dict) -> tuple[str, dict]:
    start = {"earliest": "earliest", "latest": "latest"}.get(str(options.get("start_mode", "latest")).lower(), "latest")
    return "loghub", {"sls.project": options["project"], "sls.store": options["logstore"], "endpoint": options["endpoint"], "access.key.id": options["access_key_id"], "access.key.secret": options["access_key_secret"], "startingoffsets": start}


def datahub(options: dict) -> tuple[str, dict]:
    return "datahub", {"endpoint": options["endpoint"], "project": options["project"], "topic": options["topic"], "access.key.id": options["accessId"], "access.key.secret": options["accessKey"]}


def rocketmq(options: dict) -> tuple[str, dict]:
    return "org.apache.spark.sql.rocketmq.RocketMQSourceProvider", {"nameServer": options["name.srv.addr"], "topic": options.get("topic") or options.get("topics", ""), **({"accessKey": options["access.key"], "secretKey": options["secret.key"]} if options.get("acl.enabled") else {}), **({"startingOffsets": {"CONSUME_FROM_FIRST_OFFSET": "earliest", "CONSUME_FROM_LAST_OFFSET": "latest"}[options["start.mode"]]} if options.get("start.mode") in ("CONSUME_FROM_FIRST_OFFSET", "CONSUME_FROM_LAST_OFFSET") else {})}


FORMATS: dict[str, Callable[[dict], tuple[str, dict]]] = {"MongoDB": mongodb, "Cassandra": cassandra, "Kudu": kudu, "Hudi": hudi, "Paimon": paimon, "Hbase": hbase, "Maxcompute": maxcompute, "Tablestore": tablestore}
READ = {**{k: v for k, v in FORMATS.items() if k != "Hudi"}, "Pulsar": pulsar, "Sls": sls, "RocketMQ": rocketmq}
WRITTEN = {**FORMATS, "Datahub": datahub, "RocketMQ": rocketmq, "Sls": sls}
#: Packages whose sink replaces the row of a key.
KEYED = ("MongoDB", "Kudu", "Hudi", "Cassandra", "Hbase", "Tablestore")


def read(spark: SparkSession, plugin: str, options: dict, schema=None, stream: bool = False) -> DataFrame:
    format, made = READ[plugin](options)
    reader = (spark.readStream if stream else spark.read).format(format).options(**made)
    return (reader.schema(schema) if schema is not None and plugin == "MongoDB" else reader).load()


def write(df: DataFrame, plugin: str, options: dict, keys: list[str]) -> None:
    """Appends; of changes by key, the last of each key, where none takes a row away."""
    format, made = WRITTEN[plugin](options)
    if changes.is_changelog(df) and keys and plugin in KEYED:
        last = changes.last_changes(df, keys, options.get("order_by"))
        if not last.filter(F.col("_row_kind").isin(*changes.GONE)).isEmpty():
            raise changes.ChangelogError(f"{plugin}: rows are taken away, which its package cannot do")
        df = last.drop("_row_kind")
    else:
        df = changes.plain_rows(df, plugin)
    if plugin == "Hbase":
        made["hbase.columns.mapping"] = hbase_mapping(df.columns, made)
        made = {k: v for k, v in made.items() if k not in ("rowkey", "family")}
    df.write.format(format).options(**made).mode("overwrite" if options.get("overwrite") and plugin == "Maxcompute" else "append").save()


def catalog_table(spark: SparkSession, options: dict, table: str | None = None) -> str:
    """A lakehouse table by its catalog, which is configured in the session if it is not yet there."""
    name = options["catalog_name"]
    key = f"spark.sql.catalog.{name}"
    if spark.conf.get(key, None) is None:
        config = options.get("iceberg.catalog.config") or {}
        spark.conf.set(key, "org.apache.iceberg.spark.SparkCatalog")
        for k, v in config.items():
            spark.conf.set(f"{key}.{k}", str(v))
    return f"{name}.{options['namespace']}.{table or options['table']}"


def read_iceberg(spark: SparkSession, options: dict, table: str | None = None) -> DataFrame:
    reader = spark.read
    for ours, theirs in (("use_snapshot_id", "snapshot-id"), ("use_snapshot_timestamp", "as-of-timestamp"), ("start_snapshot_id", "start-snapshot-id"), ("end_snapshot_id", "end-snapshot-id")):
        if options.get(ours) is not None:
            reader = reader.option(theirs, str(options[ours]))
    return reader.table(catalog_table(spark, options, table))


def merge_statement(table: str, source: str, columns: list[str], keys: list[str]) -> str:
    """Changes applied to a table by its key, in one statement."""
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    put = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
    names = ", ".join(f"`{c}`" for c in columns)
    gone = ", ".join(f"'{g}'" for g in changes.GONE)
    return f"MERGE INTO {table} t USING {source} s ON {on} WHEN MATCHED AND s._row_kind IN ({gone}) THEN DELETE WHEN MATCHED THEN UPDATE SET {put} WHEN NOT MATCHED AND s._row_kind NOT IN ({gone}) THEN INSERT ({names}) VALUES ({', '.join(f's.`{c}`' for c in columns)})"


def write_iceberg(df: DataFrame, options: dict, keys: list[str], table: str | None = None) -> None:
    """Appends, or merges changes by key; the save modes are those of catalog tables."""
    spark, name = df.sparkSession, catalog_table(df.sparkSession, options, table)
    there = spark.catalog.tableExists(name)
    schema, data = options.get("schema_save_mode", "CREATE_SCHEMA_WHEN_NOT_EXIST"), options.get("data_save_mode", "APPEND_DATA")
    if not there and schema in ("ERROR_WHEN_SCHEMA_NOT_EXIST", "IGNORE"):
        raise SaveModeError(f"{name} does not exist")
    if there and schema == "RECREATE_SCHEMA":
        spark.sql(f"DROP TABLE {name}")
        there = False
    rows = df.drop(*changes.HIDDEN)
    if not there:
        rows.limit(0).writeTo(name).create()
    elif data == "DROP_DATA":
        spark.sql(f"DELETE FROM {name}")
    elif data == "ERROR_WHEN_DATA_EXISTS" and not spark.table(name).isEmpty():
        raise SaveModeError(f"{name} has rows")
    elif data == "CUSTOM_PROCESSING" and options.get("custom_sql"):
        spark.sql(options["custom_sql"])
    if keys and (changes.is_changelog(df) or options.get("iceberg.table.upsert-mode-enabled")):
        changes.last_changes(df, keys, options.get("order_by")).createOrReplaceTempView("weftline_changes")
        spark.sql(merge_statement(name, "weftline_changes", rows.columns, keys))
    else:
        changes.plain_rows(df, name).writeTo(name).append()
