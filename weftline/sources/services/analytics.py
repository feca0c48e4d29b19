"""Analytical and time-series databases, over their HTTP interfaces."""

from __future__ import annotations

import base64
import datetime as dt
import json
import struct
import time
import urllib.parse

import pyarrow as pa

from weftline.sources.services.core import ServiceError, Sink, Source, ask, basic, call, lines, lines_of, listed, sink, source, web


@sink("Clickhouse")
def clickhouse(options: dict, values: dict) -> Sink:
    """Rows as one JSON a line; rows taken away are deleted by key where `support_upsert` says so."""
    hosts = listed(options["host"])
    keys = listed(options.get("primary_keys") or options.get("primary_key") or [])
    settings = {k: str(v) for k, v in (options.get("clickhouse.config") or {}).items()}

    def run(host, query, body=None):
        return call("POST", web(host), body if body is not None else query, {"Content-Type": "text/plain", **basic(options)}, options, {"database": options["database"], **({"query": query} if body is not None else {}), **settings})

    def send(rows, number):
        host = hosts[hash(number) % len(hosts)]
        if options.get("support_upsert") and keys:
            for r in rows:
                test = " AND ".join(f"`{k}` = {_literal(r.fields[k])}" for k in keys)
                run(host, f"DELETE FROM `{options['table']}` WHERE {test}" if options.get("allow_experimental_lightweight_delete") else f"ALTER TABLE `{options['table']}` DELETE WHERE {test}")
        if kept := [r.fields for r in rows if not r.gone]:
            run(host, f"INSERT INTO `{options['table']}` FORMAT JSONEachRow", lines(kept))

    return Sink(int(options.get("bulk_size", 20_000)), send, keyed=bool(options.get("support_upsert")))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _shares(options: dict) -> tuple[str | None, int]:
    """`partition_column` and `partition_num`: rows are read in so many parts by the column's hash."""
    column = options.get("partition_column")
    return column, int(options.get("partition_num", 8)) if column else 1


def _where(*conditions: str | None) -> str:
    there = [f"({c})" for c in conditions if c]
    return f" WHERE {' AND '.join(there)}" if there else ""


@source("Clickhouse")
def from_clickhouse(options: dict, schema) -> Source:
    """The rows of a query, in parts by a column's hash where one is named; hosts take turns."""
    hosts = listed(options["host"])
    column, n = _shares(options)

    def fetch(part):
        sql = options["sql"].rstrip("; \n")
        if column:  # nulls hash to null, and are of the first part
            sql = f"SELECT * FROM ({sql}) AS q WHERE coalesce(cityHash64(toString(`{column}`)) % {n}, 0) = {part}"
        for line in lines_of("POST", web(hosts[part % len(hosts)]), sql + " FORMAT JSONEachRow", {"Content-Type": "text/plain", **basic(options)}, options, {"database": options["database"], "output_format_json_quote_64bit_integers": "0"}):
            yield json.loads(line)

    return Source(list(range(n)), fetch)


def _stream_load(options: dict, host: str, label: str, rows: list[dict], more: dict) -> None:
    """One labelled load; a label that was loaded before counts as done, so a task that runs again adds nothing."""
    headers = {"Content-Type": "text/plain", "Expect": "100-continue", "format": "json", "read_json_by_line": "true", "label": label, **more, **basic(options)}
    url = f"{web(host)}/api/{options['database']}/{options['table']}/_stream_load"
    said = ask("PUT", url, lines(rows), headers, options)
    if said.get("Status") not in ("Success", "Publish Timeout", "Label Already Exists", "OK"):
        raise ServiceError(f"load {label}: {said.get('Status')} {said.get('Message') or said.get('msg')} {said.get('ErrorURL', '')}")


def _labels(options: dict, name: str) -> str:
    return f"{options.get(name) or 'weftline'}_{int(time.time() * 1000)}"


@sink("Doris")
def doris(options: dict, values: dict) -> Sink:
    hosts, prefix = listed(options["fenodes"]), _labels(options, "sink.label-prefix")
    more = {k: str(v) for k, v in (options.get("doris.config") or {}).items()}
    deletes = bool(options.get("sink.enable-delete"))

    def send(rows, number):
        sign = "__DORIS_DELETE_SIGN__"
        _stream_load(options, hosts[0], f"{prefix}_{number}", [{**r.fields, **({sign: int(r.gone)} if deletes else {})} for r in rows], {**more, **({"hidden_columns": sign} if deletes else {})})

    return Sink(int(options.get("doris.batch.size", 1024)), send, keyed=deletes)


@sink("StarRocks")
def starrocks(options: dict, values: dict) -> Sink:
    hosts, prefix = listed(options["nodeUrls"]), _labels(options, "labelPrefix")
    options = {**options, "table": options.get("table") or values.get("table_name")}
    more = {k: str(v) for k, v in (options.get("starrocks.config") or {}).items()}
    deletes = bool(options.get("enable_upsert_delete"))

    def send(rows, number):
        names = list(rows[0].fields)
        _stream_load(options, hosts[0], f"{prefix}_{number}", [{**r.fields, **({"__op": int(r.gone)} if deletes else {})} for r in rows], {**more, **({"columns": ", ".join([*names, "__op"])} if deletes else {})})

    return Sink(int(options.get("batch_max_rows", 1024)), send, keyed=deletes)


@sink("SelectDB-Cloud")
def selectdb(options: dict, values: dict) -> Sink:
    """Files of rows put to the stage, then copied into the table."""
    table, prefix = options["table.identifier"], _labels(options, "sink.label-prefix")
    load, query = web(options["load-url"]), web(options["jdbc-url"].split("//")[-1]) if "http-url" not in options else web(options["http-url"])

    def send(rows, number):
        name = f"{prefix}_{number}.json"
        call("PUT", f"{load}/copy/upload", lines(r.fields for r in rows), {"Content-Type": "text/plain", "fileName": name, **basic(options)}, options)
        sql = f"copy into {table} from @~('{name}') properties ('file.type'='json', 'file.strip_outer_array'='false', 'copy.async'='false')"
        said = ask("POST", f"{query}/copy/query", {"sql": sql, "cluster": options.get("cluster-name", "")}, basic(options), options)
        if said.get("code") not in (0, None):
            raise ServiceError(f"copy of {name}: {said.get('msg')}")

    return Sink(int(options.get("sink.buffer-size", 10_000)), send)


@source("Doris")
def from_doris(options: dict, schema) -> Source:
    """The rows of a query by the frontends' SQL interface, in parts by a column's hash where one is named."""
    hosts = listed(options["fenodes"])
    columns = options.get("doris.read.field") or "*"
    column, n = _shares(options)

    def fetch(part):
        host = web(hosts[part % len(hosts)])
        share = f"COALESCE(MOD(ABS(MURMUR_HASH3_32(CAST(`{column}` AS STRING))), {n}), 0) = {part}" if column else None
        where = _where(options.get("doris.filter.query"), share)
        said = ask("POST", f"{host}/api/query/default_cluster/{options['database']}", {"stmt": f"SELECT {columns} FROM `{options['table']}`{where}"}, basic(options), options)
        if said.get("code") not in (0, None):
            raise ServiceError(str(said.get("msg")))
        names = [c["name"] for c in said["data"]["meta"]]
        yield from (dict(zip(names, r, strict=True)) for r in said["data"]["data"])

    return Source(list(range(n)), fetch)


@source("StarRocks")
def from_starrocks(options: dict, schema) -> Source:
    """The rows of a query by the frontends' SQL interface, one JSON a line, in parts by a column's hash where one is named."""
    hosts = listed(options.get("nodeUrls") or options["nodes"])
    column, n = _shares(options)
    columns = ", ".join(f"`{c}`" for c in schema.names) if schema is not None else "*"

    def fetch(part):
        share = f"COALESCE(MOD(ABS(MURMUR_HASH3_32(CAST(`{column}` AS STRING))), {n}), 0) = {part}" if column else None
        where = _where(options.get("scan_filter"), share)
        names: list[str] = []
        for x in lines_of("POST", f"{web(hosts[part % len(hosts)])}/api/v1/catalogs/default_catalog/databases/{options['database']}/sql", {"query": f"SELECT {columns} FROM `{options['table']}`{where};"}, basic(options), options):
            one = json.loads(x)
            if "meta" in one:
                names = [c["name"] for c in one["meta"]]
            elif "data" in one:
                yield dict(zip(names, one["data"], strict=True))

    return Source(list(range(n)), fetch)


def _line(measurement: str, tags: dict, fields: dict, at: int | None) -> str:
    """A point in line protocol."""
    esc = lambda v: str(v).replace("\\", "\\\\").replace(",", "\\,").replace(" ", "\\ ").replace("=", "\\=")

    def value(v):
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, int):
            return f"{v}i"
        if isinstance(v, float):
            return repr(v)
        return '"' + str(v).replace("\\", "\\\\").replace('"', '\\"') + '"'

    head = ",".join([esc(measurement).replace("\\=", "="), *(f"{esc(k)}={esc(v)}" for k, v in tags.items() if v not in (None, ""))])
    body = ",".join(f"{esc(k)}={value(v)}" for k, v in fields.items() if v is not None)
    return f"{head} {body}" + (f" {at}" if at is not None else "")


def _millis(value) -> int:
    if isinstance(value, (int, float)):
        return int(value)
    if str(value).lstrip("-").isdigit():
        return int(value)
    when = dt.datetime.fromisoformat(str(value))
    return int((when if when.tzinfo else when.replace(tzinfo=dt.UTC)).timestamp() * 1000)


def _influx_login(options: dict) -> dict:
    return {"u": options["username"], "p": options.get("password", "")} if options.get("username") else {}


@sink("InfluxDB")
def influx(options: dict, values: dict) -> Sink:
    tags, when = list(options.get("key_tags") or []), options.get("key_time")

    def send(rows, number):
        points = []
        for r in rows:
            fields = {k: v for k, v in r.fields.items() if k not in tags and k != when}
            points.append(_line(options["measurement"], {t: r.fields.get(t) for t in tags}, fields, _millis(r.fields[when]) if when else int(time.time() * 1000)))
        call("POST", f"{web(options['url'])}/write", "\n".join(points), {"Content-Type": "text/plain"}, options, {"db": options["database"], "precision": options.get("epoch", "ms"), **_influx_login(options)})

    return Sink(int(options.get("batch_size", 1024)), send)


@source("InfluxDB")
def from_influx(options: dict, schema) -> Source:
    """The rows of a query, or of one query for each range of `split_column`."""
    column, low, high, n = options.get("split_column"), options.get("lower_bound"), options.get("upper_bound"), int(options.get("partition_num") or 1)
    sql = options["sql"].rstrip("; ")
    parts = [sql]
    if column and low is not None and high is not None and n > 1:
        low, high = int(low), int(high)
        cuts = [low + (high - low) * i // n for i in range(n)] + [high + 1]
        glue = " AND " if " where " in sql.lower() else " WHERE "
        parts = [f"{sql}{glue}{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]

    def fetch(part):
        said = ask("GET", f"{web(options['url'])}/query", None, None, options, {"db": options["database"], "q": part, "epoch": options.get("epoch", "n") + ("s" if options.get("epoch", "n") == "n" else ""), **_influx_login(options)})
        for result in said["results"]:
            if "error" in result:
                raise ServiceError(result["error"])
            for series in result.get("series") or []:
                yield from ({**(series.get("tags") or {}), **dict(zip(series["columns"], v, strict=True))} for v in series["values"])

    return Source(parts, fetch)


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


@sink("Prometheus")
def prometheus(options: dict, values: dict) -> Sink:
    """Remote write: series of labels with one sample a row."""
    label, value, when = options["key_label"], options["key_value"], options.get("key_timestamp")

    def send(rows, number):
        body = b""
        for r in rows:
            pairs = r.fields[label]
            pairs = json.loads(pairs) if isinstance(pairs, str) else pairs
            at = _millis(r.fields[when]) if when else int(time.time() * 1000)
            sample = b"\x09" + struct.pack("<d", float(r.fields[value])) + b"\x10" + _varint(at)
            body += _block(1, b"".join(_block(1, _block(1, k.encode()) + _block(2, str(v).encode())) for k, v in sorted(pairs.items())) + _block(2, sample))
        call("POST", options["url"], pa.Codec("snappy").compress(body, asbytes=True), {"Content-Type": "application/x-protobuf", "Content-Encoding": "snappy", "X-Prometheus-Remote-Write-Version": "0.1.0", **(options.get("headers") or {})}, options)

    return Sink(int(options.get("batch_size", 1024)), send)


@source("Prometheus")
def from_prometheus(options: dict, schema) -> Source:
    """Samples of an instant or range query: metric, timestamp, value."""
    ranged = str(options.get("query_type", "Instant")).lower() == "range"

    def fetch(part):
        params = {"query": options["query"], **({k: options[k] for k in ("start", "end", "step") if k in options} if ranged else {k: options[k] for k in ("time", "timeout") if k in options}), **(options.get("params") or {})}
        said = ask("GET", f"{web(options['url'])}/api/v1/query{'_range' if ranged else ''}", None, options.get("headers"), options, params)
        if said.get("status") != "success":
            raise ServiceError(str(said.get("error")))
        for series in said["data"]["result"]:
            for at, value in series.get("values") or [series["value"]]:
                yield {"metric": series["metric"], "timestamp": float(at), "value": float(value)}

    return Source([0], fetch)


def _tdengine(options: dict, sql: str) -> dict:
    """A statement by the HTTP adapter of the host that the connection text names."""
    host = urllib.parse.urlsplit(options["url"].split(":", 1)[1] if options["url"].startswith("jdbc:") else options["url"])
    said = ask("POST", f"http://{host.hostname}:{host.port or 6041}/rest/sql/{options['database']}", sql, {"Content-Type": "text/plain", **basic(options)}, options)
    if said.get("code"):
        raise ServiceError(said.get("desc"))
    return said


@sink("TDengine")
def tdengine(options: dict, values: dict) -> Sink:
    """A row's first field is its sub-table, the last ones its tags if `tags` names them; the rest are its values."""
    tags = list(options.get("tags") or [])

    def send(rows, number):
        out = []
        for r in rows:
            (_, name), *rest = r.fields.items()
            own = [_literal(v) for k, v in rest if k not in tags]
            using = f" USING {options['stable']} TAGS ({', '.join(_literal(r.fields[t]) for t in tags)})" if tags else ""
            out.append(f"`{name}`{using} VALUES ({', '.join(own)})")
        _tdengine(options, "INSERT INTO " + " ".join(out))

    return Sink(int(options.get("batch_size", 500)), send)


@source("TDengine")
def from_tdengine(options: dict, schema) -> Source:
    low, high = options.get("lower_bound"), options.get("upper_bound")
    where = f" WHERE _c0 >= '{low}' AND _c0 < '{high}'" if low and high else ""

    def fetch(part):
        said = _tdengine(options, f"SELECT tbname, * FROM {options['stable']}{where}")
        names = [c[0] for c in said["column_meta"]]
        yield from (dict(zip(names, r, strict=True)) for r in said["data"])

    return Source([0], fetch)


def _iotdb(options: dict) -> str:
    host = listed(options["node_urls"])[0].rsplit(":", 1)[0]
    return f"http://{host}:{options.get('http_port', 18080)}/rest/v2"


@sink("IoTDB")
def iotdb(options: dict, values: dict) -> Sink:
    """Records of one device each, by the HTTP service."""
    device, when, group = options["key_device"], options.get("key_timestamp"), options.get("storage_group")
    fields = options.get("key_measurement_fields")
    kinds = {bool: "BOOLEAN", int: "INT64", float: "DOUBLE"}

    def send(rows, number):
        out = {"timestamps": [], "devices": [], "measurements_list": [], "data_types_list": [], "values_list": [], "is_aligned": False}
        for r in rows:
            names = [n for n in fields or r.fields if n not in (device, when) and r.fields.get(n) is not None]
            out["timestamps"].append(_millis(r.fields[when]) if when else int(time.time() * 1000))
            out["devices"].append(f"{group}.{r.fields[device]}" if group else r.fields[device])
            out["measurements_list"].append(names)
            out["data_types_list"].append([kinds.get(type(r.fields[n]), "TEXT") for n in names])
            out["values_list"].append([r.fields[n] for n in names])
        said = ask("POST", f"{_iotdb(options)}/insertRecords", out, basic(options), options)
        if said.get("code") != 200:
            raise ServiceError(said.get("message"))

    return Sink(int(options.get("batch_size", 1024)), send)


@source("IoTDB")
def from_iotdb(options: dict, schema) -> Source:
    def fetch(part):
        said = ask("POST", f"{_iotdb(options)}/query", {"sql": options["sql"]}, basic(options), options)
        if said.get("code") not in (None, 200):
            raise ServiceError(said.get("message"))
        names = schema.names if schema is not None else ["timestamp", *said["expressions"]]
        yield from (dict(zip(names, r, strict=True)) for r in zip(said["timestamps"], *said["values"], strict=True))

    return Source([0], fetch)


@sink("Druid")
def druid(options: dict, values: dict) -> Sink:
    """Batches as inline ingestion tasks."""

    def send(rows, number):
        dims = [{"name": k, "type": "double" if isinstance(v, float) else "long" if isinstance(v, int) and not isinstance(v, bool) else "string"} for k, v in rows[0].fields.items()]
        spec = {
            "dataSchema": {"dataSource": options["datasource"], "timestampSpec": {"column": options.get("timestamp_column", "timestamp"), "format": "auto", "missingValue": dt.datetime.now(dt.UTC).isoformat()}, "dimensionsSpec": {"dimensions": dims}, "granularitySpec": {"type": "uniform", "queryGranularity": "none", "rollup": False}},
            "ioConfig": {"type": "index_parallel", "inputSource": {"type": "inline", "data": lines(r.fields for r in rows)}, "inputFormat": {"type": "json"}, "appendToExisting": True},
            "tuningConfig": {"type": "index_parallel"},
        }
        said = ask("POST", f"{web(options['coordinatorUrl'])}/druid/indexer/v1/task", {"type": "index_parallel", "spec": spec}, basic(options), options)
        if "task" not in said:
            raise ServiceError(json.dumps(said)[:500])

    return Sink(int(options.get("batchSize", 10_000)), send)


@source("OpenMldb")
def from_openmldb(options: dict, schema) -> Source:
    """The rows of a query by the API server at `host` and `port`."""

    def fetch(part):
        said = ask("POST", f"http://{options['host']}:{options['port']}/dbs/{options['database']}", {"mode": "online", "sql": options["sql"]}, None, options)
        if said.get("code"):
            raise ServiceError(said.get("msg"))
        names = schema.names if schema is not None else [f"c{i}" for i in range(len((said["data"]["data"] or [[]])[0]))]
        yield from (dict(zip(names, r, strict=True)) for r in said["data"]["data"])

    return Source([0], fetch)


def _neo4j(options: dict, statements: list[dict]) -> list[dict]:
    """Statements in one transaction, by the HTTP interface of the host that `uri` names."""
    at = urllib.parse.urlsplit(options["uri"])
    url = options["uri"].rstrip("/") if at.scheme.startswith("http") else f"http://{at.hostname}:{options.get('http_port', 7474)}"
    headers = {"Authorization": f"Bearer {options['bearer_token']}"} if options.get("bearer_token") else basic(options)
    if options.get("kerberos_ticket"):
        headers = {"Authorization": "Basic " + base64.b64encode(f":{options['kerberos_ticket']}".encode()).decode()}
    said = ask("POST", f"{url}/db/{options['database']}/tx/commit", {"statements": statements}, headers, options)
    if said.get("errors"):
        raise ServiceError(json.dumps(said["errors"])[:500])
    return said["results"]


@sink("Neo4j")
def neo4j(options: dict, values: dict) -> Sink:
    """The query once a row, its parameters by position; in write_mode Batch once for all rows, as $batch."""
    places = options.get("queryParamPosition") or {}
    whole = str(options.get("write_mode", "OneByOne")).upper() == "BATCH"

    def send(rows, number):
        made = [{n: list(r.fields.values())[int(i)] for n, i in places.items()} if places else r.fields for r in rows]
        _neo4j(options, [{"statement": options["query"], "parameters": {"batch": made}}] if whole else [{"statement": options["query"], "parameters": p} for p in made])

    return Sink(int(options.get("max_batch_size") or 500), send)


@source("Neo4j")
def from_neo4j(options: dict, schema) -> Source:
    def fetch(part):
        for result in _neo4j(options, [{"statement": options["query"]}]):
            yield from (dict(zip(result["columns"], x["row"], strict=True)) for x in result["data"])

    return Source([0], fetch)
