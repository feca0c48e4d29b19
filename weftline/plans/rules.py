"""Option rules of plugins, checked before a job reads anything."""

from __future__ import annotations

from dataclasses import dataclass, field


class OptionError(ValueError):
    """Options that a plugin cannot run with; the message names every fault."""


def given(options: dict, name: str) -> bool:
    """Whether an option is there, by its dotted name, as one key or nested, and is not empty."""
    if name in options:
        return options[name] not in (None, "", [], {})
    head, _, rest = name.partition(".")
    return bool(rest) and isinstance(options.get(head), dict) and given(options[head], rest)


def _value(options: dict, name: str):
    if name in options:
        return options[name]
    head, _, rest = name.partition(".")
    return _value(options[head], rest) if rest and isinstance(options.get(head), dict) else None


@dataclass(frozen=True)
class Required:
    names: tuple[str, ...]

    def faults(self, options: dict) -> list[str]:
        return [f"{n} is missing" for n in self.names if not given(options, n)]


@dataclass(frozen=True)
class OneOf:
    """Exactly one of the options; with `least`, one or more."""

    names: tuple[str, ...]
    least: bool = False

    def faults(self, options: dict) -> list[str]:
        there = [n for n in self.names if given(options, n)]
        if not there:
            return [f"one of {', '.join(self.names)} is needed"]
        return [f"{' and '.join(there)} exclude each other"] if len(there) > 1 and not self.least else []


@dataclass(frozen=True)
class Together:
    """All of the options or none."""

    names: tuple[str, ...]

    def faults(self, options: dict) -> list[str]:
        lacking = [n for n in self.names if not given(options, n)]
        return [f"{', '.join(lacking)} must come with {', '.join(n for n in self.names if n not in lacking)}"] if 0 < len(lacking) < len(self.names) else []


@dataclass(frozen=True)
class When:
    """Options that are needed where another has one of the values."""

    name: str
    values: tuple
    needed: tuple[str, ...]

    def faults(self, options: dict) -> list[str]:
        if _value(options, self.name) not in self.values:
            return []
        return [f"{n} is missing, as {self.name} is {_value(options, self.name)}" for n in self.needed if not given(options, n)]


@dataclass(frozen=True)
class Choice:
    name: str
    values: tuple[str, ...]

    def faults(self, options: dict) -> list[str]:
        v = _value(options, self.name)
        return [] if v is None or str(v).lower() in {x.lower() for x in self.values} else [f"{self.name} is {v}, not one of {', '.join(self.values)}"]


@dataclass(frozen=True)
class Each:
    """Rules for each entry of a list option, over the options around it; without the list, for the options themselves."""

    name: str
    rules: tuple

    def faults(self, options: dict) -> list[str]:
        entries = _value(options, self.name)
        if not entries:
            return [f for r in self.rules for f in r.faults(options)]
        return [f"{self.name}[{i}]: {f}" for i, e in enumerate(entries) for r in self.rules for f in r.faults({**options, **e})]


@dataclass
class Rules:
    of: dict[tuple[str, str], tuple] = field(default_factory=dict)

    def add(self, kind: str, plugin: str, *rules) -> None:
        self.of[kind, plugin.lower()] = rules

    def check(self, kind: str, plugin: str, options: dict) -> None:
        """Raises with all faults of a plugin's options; plugins without rules take anything."""
        faults = [f for r in self.of.get((kind, plugin.lower()), ()) for f in r.faults(options)]
        if faults:
            raise OptionError(f"{kind} {plugin}: " + "; ".join(faults))


SAVE_MODES = (
    Choice("schema_save_mode", ("RECREATE_SCHEMA", "CREATE_SCHEMA_WHEN_NOT_EXIST", "ERROR_WHEN_SCHEMA_NOT_EXIST", "IGNORE")),
    Choice("data_save_mode", ("DROP_DATA", "APPEND_DATA", "CUSTOM_PROCESSING", "ERROR_WHEN_DATA_EXISTS")),
    When("data_save_mode", ("CUSTOM_PROCESSING",), ("custom_sql",)),
)
FILE_FORMATS = Choice("file_format_type", ("text", "csv", "parquet", "orc", "json", "xml", "excel", "binary", "avro", "canal_json", "debezium_json", "maxwell_json", "ogg_json"))
RULES = Rules()
#: Options that services cannot do without: (as source, as sink).
_NEEDED: dict[str, tuple[tuple[str, ...] | None, tuple[str, ...] | None]] = {
    "Elasticsearch": (("hosts",), ("hosts", "index")),
    "Easysearch": (("hosts",), ("hosts", "index")),
    "Typesense": (("hosts", "collection"), ("hosts", "collection")),
    "Qdrant": (("collection_name",), ("collection_name",)),
    "Milvus": (("url", "collection"), ("url",)),
    "ChromaDB": (("url", "collection"), None),
    "Clickhouse": (("host", "database", "sql"), ("host", "database", "table")),
    "Doris": (("fenodes", "database", "table"), ("fenodes", "database", "table")),
    "StarRocks": (("database", "table"), ("nodeUrls", "database")),
    "SelectDB-Cloud": (None, ("load-url", "jdbc-url", "table.identifier")),
    "InfluxDB": (("url", "database", "sql"), ("url", "database", "measurement")),
    "Prometheus": (("url", "query"), ("url", "key_label", "key_value")),
    "TDengine": (("url", "database", "stable"), ("url", "database", "stable")),
    "IoTDB": (("node_urls", "sql"), ("node_urls", "key_device")),
    "Druid": (None, ("coordinatorUrl", "datasource")),
    "Neo4j": (("uri", "database", "query"), ("uri", "database", "query")),
    "OpenMldb": (("host", "port", "database", "sql"), None),
    "Slack": (None, ("webhooks_url", "oauth_token", "slack_channel")),
    "Feishu": (None, ("url",)),
    "DingTalk": (None, ("url", "secret")),
    "Enterprise-WeChat": (None, ("url",)),
    "Sentry": (None, ("dsn",)),
    "Email": (None, ("email_from_address", "email_to_address", "email_host", "email_message_headline", "email_message_content")),
    "Rabbitmq": (("host", "queue_name"), ("host", "queue_name")),
    "Pulsar": (("client.service-url", "admin.service-url"), ("admin.service-url", "topic")),
    "Redis": (("keys", "data_type"), ("key", "data_type")),
    "Socket": (("host", "port"), ("host", "port")),
    "Activemq": (None, ("queue_name",)),
    "AmazonDynamoDB": (("url", "region", "table"), ("url", "region", "table")),
    "AmazonSqs": (("url", "region"), ("url", "region")),
    "GoogleSheets": (("service_account_key", "sheet_id", "sheet_name", "range"), None),
    "GoogleFirestore": (None, ("project_id", "collection", "credentials")),
    "Web3j": (("url",), None),
    "MyHours": (("url", "email", "password"), None),
    "MongoDB": (("uri", "database", "collection"), ("uri", "database", "collection")),
    "Cassandra": (("host", "keyspace"), ("host", "keyspace")),
    "Kudu": (("kudu_masters", "table_name"), ("kudu_masters", "table_name")),
    "Hudi": (None, ("table_dfs_path", "table_name")),
    "Paimon": (("warehouse", "database", "table"), ("warehouse", "database", "table")),
    "Hbase": (("zookeeper_quorum", "table"), ("zookeeper_quorum", "table", "rowkey_column")),
    "Iceberg": (("catalog_name", "namespace"), ("catalog_name", "namespace")),
    "S3-Redshift": (None, ("jdbc_url", "jdbc_user", "jdbc_password", "execute_sql", "path", "bucket")),
}


def declare(stores: tuple[str, ...], services: tuple[str, ...], captured: tuple[str, ...]) -> None:
    """Rules of the built-in plugins."""
    for name in stores:
        RULES.add("source", name, Each("tables_configs", (Required(("path",)), FILE_FORMATS)))
        RULES.add("sink", name, Required(("path",)), FILE_FORMATS, *SAVE_MODES[:2])
    for name in captured:
        choices = Choice("startup.mode", ("initial", "earliest", "latest", "specific", "timestamp")), Choice("stop.mode", ("never", "latest", "specific", "timestamp"))
        needed = [When(f"{w}.mode", (m,), (f"{w}.{n}",)) for w in ("startup", "stop") for m, n in (("specific", "specific-offset.pos"), ("timestamp", "timestamp"))]
        RULES.add("source", name, Required(("log.path",)), *choices, *needed)
    for name in services:
        RULES.add("source", name, Required(("url",)), Choice("method", ("GET", "POST", "PUT", "PATCH", "DELETE", "HEAD")), Choice("format", ("json", "text")))
    for name, (reading, writing) in _NEEDED.items():
        modes = SAVE_MODES if name in ("Elasticsearch", "Easysearch", "Clickhouse", "Doris", "StarRocks", "Milvus", "Typesense", "Iceberg") else ()
        if reading:
            RULES.add("source", name, Required(reading))
        if writing:
            RULES.add("sink", name, Required(writing), *modes)
    RULES.add("source", "FakeSource", Each("tables_configs", (OneOf(("schema", "schema.fields", "schema.columns"), least=True),)))
    RULES.add("source", "Hive", Required(("table_name",)))
    RULES.add("source", "Jdbc", Required(("url",)), Each("table_list", (OneOf(("query", "table_path", "table_pattern"), least=True),)), Together(("partition_lower_bound", "partition_upper_bound")))
    RULES.add("source", "Kafka", Required(("topic", "bootstrap.servers")), Choice("start_mode", ("earliest", "group_offsets", "latest", "specific_offsets", "timestamp")), When("start_mode", ("timestamp",), ("start_mode.timestamp",)), When("start_mode", ("specific_offsets",), ("start_mode.offsets",)), When("format", ("protobuf",), ("protobuf_schema", "protobuf_message_name")))
    RULES.add("sink", "Hive", Required(("table_name",)), *SAVE_MODES)
    RULES.add("sink", "Jdbc", Required(("url",)), OneOf(("table", "query", "generate_sink_sql"), least=True), *SAVE_MODES)
    RULES.add("sink", "Kafka", Required(("topic", "bootstrap.servers")), When("format", ("protobuf",), ("protobuf_schema", "protobuf_message_name")))
    RULES.add("sink", "Http", Required(("url",)))
