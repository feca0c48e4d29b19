"""Services against servers of this process that keep what they are sent."""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import json
import socketserver
import struct
import threading
from collections import defaultdict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from weftline.functions import models
from weftline.plans import rules
from weftline.plans import job
from weftline.plans.job import SINKS, SOURCES, run_job
from weftline.sources import changes, services
from weftline.sources.services import aws, core, messages, search

class Headers(dict):
    """Headers under any case of their names."""

    def __init__(self, headers):
        super().__init__({k.lower(): v for k, v in headers.items()})

    def __getitem__(self, name):
        return super().__getitem__(name.lower())


ROWS = [(1, "a", 0.5), (2, "b\"é", None), (3, "c", -1.0)]
SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("v", T.DoubleType())])
DICTS = [dict(zip(SCHEMA.names, r, strict=True)) for r in ROWS]


@pytest.fixture(scope="module")
def server():
    asked: list = []
    answers: dict = {}
    state: dict = defaultdict(int)

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def answer(self):
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            at = urlparse(self.path)
            query = {k: v[0] for k, v in parse_qs(at.query).items()}
            asked.append((self.command, at.path, query, Headers(self.headers), body))
            make = answers.get((self.command, at.path), {})
            said = make(query, body, state) if callable(make) else make
            code = 200
            if isinstance(said, tuple):
                code, said = said
            data = said if isinstance(said, bytes) else json.dumps(said).encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = do_PUT = do_DELETE = answer

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    s.asked, s.answers, s.state = asked, answers, state
    s.host = f"127.0.0.1:{s.server_port}"
    yield s
    s.shutdown()


@pytest.fixture(autouse=True)
def fresh(server):
    server.asked.clear()
    server.answers.clear()
    server.state.clear()


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA).coalesce(1)


def bodies(server, path=None):
    return [json.loads(b) for _, p, _, _, b in server.asked if path in (None, p)]


def found(df):
    return sorted([r.asDict() for r in df.collect()], key=lambda r: r["id"])


def ndjson(data):
    return [json.loads(x) for x in data.decode().splitlines() if x]


def test_every_service_is_a_plugin():
    assert set(services.READ) <= set(SOURCES) and set(services.WRITTEN) <= set(SINKS)


def test_elasticsearch_bulk(spark, server, frame):
    server.answers["POST", "/_bulk"] = lambda q, b, s: (503, b"") if not s["n"] and not s.update(n=1) else {"errors": False, "items": []}
    options = {"hosts": [server.host], "index": "i-${name}", "primary_keys": ["id", "name"], "max_batch_size": 2, "username": "u", "password": "p", "retry_backoff_multiplier_ms": 1}
    services.write(frame, "Elasticsearch", options)
    sent = [x for m, p, _, h, b in server.asked[1:] for x in ndjson(b)]
    assert len(server.asked) == 3 and sent[0] == {"index": {"_index": "i-a", "_id": "1_a"}} and sent[1::2] == DICTS
    assert server.asked[0][3]["Authorization"] == "Basic " + base64.b64encode(b"u:p").decode()
    server.asked.clear()
    gone = spark.createDataFrame([(1, "a", "+I"), (1, "a", "-D"), (2, "b", "+U")], "id int, name string, _row_kind string").coalesce(1)
    services.write(gone, "Easysearch", {**options, "index": "i", "primary_keys": ["id"]})
    assert sorted(map(str, ndjson(server.asked[0][4]))) == sorted(map(str, [{"delete": {"_index": "i", "_id": "1"}}, {"index": {"_index": "i", "_id": "2"}}, {"id": 2, "name": "b"}]))
    server.answers["POST", "/_bulk"] = {"errors": True, "items": [{"index": {"status": 400, "error": "mapping"}}]}
    with pytest.raises(Exception, match="were refused"):
        services.write(frame, "Elasticsearch", options)
    with pytest.raises(changes.ChangelogError):
        services.write(gone, "Slack", {"webhooks_url": "x", "oauth_token": "t", "slack_channel": "c"})


def test_elasticsearch_scroll(spark, server):
    pages = {0: [DICTS[:1], DICTS[1:2]], 1: [DICTS[2:]]}

    def first(q, b, s):
        part = json.loads(b)["slice"]["id"]
        return {"_scroll_id": f"{part}-1", "hits": {"hits": [{"_id": "x", "_source": d} for d in pages[part][0]]}}

    def more(q, b, s):
        part, n = map(int, json.loads(b)["scroll_id"].split("-"))
        return {"_scroll_id": f"{part}-{n + 1}", "hits": {"hits": [{"_source": d} for d in (pages[part][n] if n < len(pages[part]) else [])]}}

    server.answers["POST", "/i/_search"] = first
    server.answers["POST", "/_search/scroll"] = more
    df = services.read(spark, "Elasticsearch", {"hosts": server.host, "index": "i", "slices": 2, "query": {"term": {"a": 1}}}, SCHEMA)
    assert found(df) == DICTS
    assert json.loads(server.asked[0][4])["_source"] == SCHEMA.names


def test_typesense(spark, server, frame):
    at = "/collections/c/documents"
    server.answers["POST", f"{at}/import"] = lambda q, b, s: b"\n".join(b'{"success": true}' for _ in ndjson(b))
    server.answers["GET", f"{at}/export"] = "\n".join(map(json.dumps, DICTS)).encode()
    options = {"hosts": [server.host], "collection": "c", "api_key": "k", "primary_keys": ["id"]}
    services.write(frame, "Typesense", options)
    assert server.asked[0][2] == {"action": "upsert"} and ndjson(server.asked[0][4])[0] == {"id": "1", "name": "a", "v": 0.5}
    assert found(services.read(spark, "Typesense", options, SCHEMA)) == DICTS


def test_qdrant(spark, server):
    points = [{"id": 1, "payload": {"t": "x"}, "vector": {"e": [0.5, 1.0]}}, {"id": 2, "payload": {"t": None}, "vector": {"e": [1.0, 2.0]}}]
    server.answers["POST", "/collections/c/points/scroll"] = lambda q, b, s: {"result": {"points": points[1:] if json.loads(b).get("offset") else points[:1], "next_page_offset": None if json.loads(b).get("offset") else 2}}
    options = {"host": "127.0.0.1", "http_port": server.server_port, "collection_name": "c", "api_key": "k"}
    schema = "id int, t string, e array<double>"
    services.write(spark.createDataFrame([(1, "x", [0.5, 1.0]), (2, None, [1.0, 2.0])], schema).coalesce(1), "Qdrant", options)
    assert server.asked[0][:2] == ("PUT", "/collections/c/points") and bodies(server)[0]["points"] == [{**p, "payload": p["payload"]} for p in points]
    got = services.read(spark, "Qdrant", options, T._parse_datatype_string(schema))
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, "x", [0.5, 1.0]), (2, None, [1.0, 2.0])]


def test_milvus(spark, server):
    server.answers["POST", "/v2/vectordb/collections/has"] = {"code": 0, "data": {"has": False}}
    for name in ("collections/create", "entities/upsert", "entities/delete"):
        server.answers["POST", f"/v2/vectordb/{name}"] = {"code": 0}
    server.answers["POST", "/v2/vectordb/entities/query"] = lambda q, b, s: {"code": 0, "data": DICTS[json.loads(b)["offset"] :][: json.loads(b)["limit"]]}
    options = {"url": server.host, "token": "t", "enable_upsert": True, "collection_rename": {"t": "c"}, "primary_keys": ["id"], "field_schema": [{"field_name": "key", "source_field_name": "id", "data_type": 5, "is_primary_key": True}, {"field_name": "e", "data_type": 101, "dimension": 2}]}
    rows = spark.createDataFrame([(1, [0.5, 1.0], "+I"), (2, [1.0, 2.0], "-D")], "id int, e array<double>, _row_kind string").coalesce(1)
    services.write(rows, "Milvus", options, {"table_name": "t"})
    made = bodies(server, "/v2/vectordb/collections/create")[0]
    assert made["collectionName"] == "c" and made["schema"]["fields"][0] == {"fieldName": "key", "dataType": "Int64", "isPrimary": True, "elementTypeParams": {}} and made["schema"]["fields"][1]["elementTypeParams"] == {"dim": 2}
    assert bodies(server, "/v2/vectordb/entities/upsert")[0]["data"] == [{"key": 1, "e": [0.5, 1.0]}]
    assert bodies(server, "/v2/vectordb/entities/delete")[0]["filter"] == "key in [2]"
    assert found(services.read(spark, "Milvus", {"url": server.host, "token": "t", "collection": "c", "batch_size": 2}, SCHEMA)) == DICTS
    assert search.milvus_fields({"field_schema": [{"field_name": "p", "data_type": 21, "max_length": 9}], "partition_key": "p"}) == [{"fieldName": "p", "dataType": "VarChar", "isPrimary": False, "elementTypeParams": {"max_length": 9}, "isPartitionKey": True}]


def test_chroma(spark, server):
    at = "/api/v2/tenants/default_tenant/databases/default_database/collections"
    server.answers["GET", f"{at}/c"] = {"id": "u"}
    server.answers["POST", f"{at}/u/get"] = lambda q, b, s: {"ids": ["1", "2", "3"][json.loads(b)["offset"] :][:2], "documents": ["x", "y", "z"][json.loads(b)["offset"] :][:2], "embeddings": None, "metadatas": [{"k": 1}, None, None][json.loads(b)["offset"] :][:2]}
    df = services.read(spark, "ChromaDB", {"url": server.host, "collection": "c", "batch_size": 2}, T._parse_datatype_string("id string, document string, k int"))
    assert [tuple(r) for r in df.collect()] == [("1", "x", 1), ("2", "y", None), ("3", "z", None)]


def test_clickhouse(spark, server, frame):
    server.answers["POST", ""] = server.answers["POST", "/"] = lambda q, b, s: "\n".join(map(json.dumps, DICTS)).encode() if b.startswith(b"SELECT") else b""
    options = {"host": server.host, "database": "d", "table": "t", "username": "u", "password": "p", "bulk_size": 2, "clickhouse.config": {"max_insert_threads": 2}}
    services.write(frame, "Clickhouse", options)
    assert [q["query"] for _, _, q, _, _ in server.asked] == ["INSERT INTO `t` FORMAT JSONEachRow"] * 2 and server.asked[0][2]["max_insert_threads"] == "2"
    assert [x for a in server.asked for x in ndjson(a[4])] == DICTS
    server.asked.clear()
    gone = spark.createDataFrame([(1, "it's", "-D")], "id int, name string, _row_kind string")
    services.write(gone, "Clickhouse", {**options, "support_upsert": True, "primary_keys": ["name"]})
    assert server.asked[0][4] == b"ALTER TABLE `t` DELETE WHERE `name` = 'it\\'s'" and len(server.asked) == 1
    assert found(services.read(spark, "Clickhouse", {**options, "sql": "SELECT * FROM t;"}, SCHEMA)) == DICTS


@pytest.mark.parametrize(("name", "hosts", "sign", "more"), [("Doris", "fenodes", "__DORIS_DELETE_SIGN__", {"sink.enable-delete": True, "doris.batch.size": 2}), ("StarRocks", "nodeUrls", "__op", {"enable_upsert_delete": True, "batch_max_rows": 2})])
def test_stream_loads(spark, server, name, hosts, sign, more):
    server.answers["PUT", "/api/d/t/_stream_load"] = lambda q, b, s: {"Status": ["Success", "Label Already Exists"][s["n"] % 2 if not s.update(n=s["n"] + 1) else 0]}
    rows = spark.createDataFrame([(1, "+I"), (2, "-D"), (3, "+U")], "id int, _row_kind string").coalesce(1)
    services.write(rows, name, {hosts: [server.host], "database": "d", "table": "t", "username": "u", "password": "p", "primary_keys": ["id"], **more})
    sent = [x for a in server.asked for x in ndjson(a[4])]
    assert {(x["id"], x[sign]) for x in sent} == {(1, 0), (2, 1), (3, 0)} and len({a[3]["label"] for a in server.asked}) == 2
    server.answers["PUT", "/api/d/t/_stream_load"] = {"Status": "Fail", "Message": "no"}
    with pytest.raises(Exception, match="Fail"):
        services.write(rows, name, {hosts: [server.host], "database": "d", "table": "t", "username": "u", "password": "p", "primary_keys": ["id"], **more})


def test_loaders_read(spark, server, frame):
    server.answers["POST", "/api/query/default_cluster/d"] = {"code": 0, "data": {"meta": [{"name": n} for n in SCHEMA.names], "data": [list(r) for r in ROWS]}}
    server.answers["POST", "/api/v1/catalogs/default_catalog/databases/d/sql"] = "\n".join([json.dumps({"meta": [{"name": n} for n in SCHEMA.names]}), *(json.dumps({"data": list(r)}) for r in ROWS)]).encode()
    options = {"fenodes": server.host, "nodes": server.host, "database": "d", "table": "t", "username": "u", "password": "p", "doris.filter.query": "id < 9", "scan_filter": "id < 9"}
    for name in ("Doris", "StarRocks"):
        assert found(services.read(spark, name, options, SCHEMA)) == DICTS
    assert "WHERE (id < 9)" in bodies(server)[0]["stmt"] and "`id`, `name`, `v`" in bodies(server)[1]["query"]
    server.asked.clear()
    server.answers["POST", "/copy/query"] = {"code": 0}
    services.write(frame, "SelectDB-Cloud", {"load-url": server.host, "jdbc-url": server.host, "cluster-name": "c", "table.identifier": "d.t", "username": "u", "password": "p"})
    assert ndjson(server.asked[0][4]) == DICTS and server.asked[0][3]["fileName"] in bodies(server, "/copy/query")[0]["sql"]


def test_influx(spark, server, frame):
    rows = spark.createDataFrame([("a b", 1, 1.5, True, "x\"y", 1700000000000), (None, 2, None, None, None, 5)], "h string, n long, f double, b boolean, s string, at long").coalesce(1)
    services.write(rows, "InfluxDB", {"url": server.host, "database": "d", "measurement": "m", "key_tags": ["h"], "key_time": "at", "username": "u", "password": "p"})
    assert server.asked[0][4].decode().split("\n") == ['m,h=a\\ b n=1i,f=1.5,b=true,s="x\\"y" 1700000000000', "m n=2i 5"]
    server.answers["GET", "/query"] = lambda q, b, s: {"results": [{"series": [{"columns": ["id", "name", "v"], "values": [list(r) for r in ROWS if ("id < 3" in q["q"]) == (r[0] < 3)]}]}]}
    options = {"url": server.host, "database": "d", "sql": "select * from m where x = 1", "split_column": "id", "lower_bound": 1, "upper_bound": 5, "partition_num": 2}
    assert found(services.read(spark, "InfluxDB", options, SCHEMA)) == DICTS
    assert sorted(a[2]["q"] for a in server.asked[1:]) == ["select * from m where x = 1 AND id >= 1 AND id < 3", "select * from m where x = 1 AND id >= 3 AND id < 6"]


def test_prometheus(spark, server):
    rows = spark.createDataFrame([({"__name__": "up", "job": "x"}, 2.5, 1000)], "labels map<string,string>, v double, at long")
    services.write(rows, "Prometheus", {"url": f"http://{server.host}/w", "key_label": "labels", "key_value": "v", "key_timestamp": "at"})
    raw = server.asked[0][4]
    body = pa.Codec("snappy").decompress(raw, raw[0], asbytes=True)
    label = lambda k, v: b"\n" + bytes([len(k) + len(v) + 4]) + b"\n" + bytes([len(k)]) + k + b"\x12" + bytes([len(v)]) + v
    series = label(b"__name__", b"up") + label(b"job", b"x") + b"\x12\x0c\x09" + struct.pack("<d", 2.5) + b"\x10\xe8\x07"
    assert body == b"\n" + bytes([len(series)]) + series
    server.answers["GET", "/api/v1/query_range"] = {"status": "success", "data": {"result": [{"metric": {"a": "b"}, "values": [[1.5, "2"], [2.5, "3"]]}]}}
    df = services.read(spark, "Prometheus", {"url": server.host, "query": "up", "query_type": "Range", "start": 1, "end": 2, "step": 1}, T._parse_datatype_string("metric map<string,string>, timestamp double, value double"))
    assert [tuple(r) for r in df.collect()] == [({"a": "b"}, 1.5, 2.0), ({"a": "b"}, 2.5, 3.0)]


def test_tables_of_time_series(spark, server):
    server.answers["POST", "/rest/sql/d"] = lambda q, b, s: {"code": 0, "column_meta": [["tbname"], ["id"]], "data": [["s1", 1]]} if b.startswith(b"SELECT") else {"code": 0}
    rows = spark.createDataFrame([("s1", "2024-01-01", 1.5, "o'x")], "t string, at string, v double, loc string")
    options = {"url": f"jdbc:TAOS-RS://{server.host}/", "username": "u", "password": "p", "database": "d", "stable": "m", "tags": ["loc"]}
    services.write(rows, "TDengine", options)
    assert server.asked[0][4].decode() == "INSERT INTO `s1` USING m TAGS ('o\\'x') VALUES ('2024-01-01', 1.5)"
    assert services.read(spark, "TDengine", options, T._parse_datatype_string("tbname string, id int")).first() == ("s1", 1)
    server.answers["POST", "/rest/v2/insertRecords"] = {"code": 200}
    server.answers["POST", "/rest/v2/query"] = {"expressions": ["root.s.v"], "timestamps": [1, 2], "values": [[1.5, None]]}
    options = {"node_urls": ["127.0.0.1:6667"], "http_port": server.server_port, "username": "u", "password": "p", "storage_group": "root.s", "key_device": "dev", "key_timestamp": "at", "sql": "select v from root.s"}
    services.write(spark.createDataFrame([("d1", 7, 1.5, None)], "dev string, at long, v double, w int"), "IoTDB", options)
    assert bodies(server, "/rest/v2/insertRecords")[0] == {"timestamps": [7], "devices": ["root.s.d1"], "measurements_list": [["v"]], "data_types_list": [["DOUBLE"]], "values_list": [[1.5]], "is_aligned": False}
    assert [tuple(r) for r in services.read(spark, "IoTDB", options, T._parse_datatype_string("at long, v double")).collect()] == [(1, 1.5), (2, None)]


def test_druid_neo4j_openmldb(spark, server, frame):
    server.answers["POST", "/druid/indexer/v1/task"] = {"task": "x"}
    services.write(frame, "Druid", {"coordinatorUrl": server.host, "datasource": "s"})
    spec = bodies(server)[0]["spec"]
    assert ndjson(spec["ioConfig"]["inputSource"]["data"].encode()) == DICTS and [d["type"] for d in spec["dataSchema"]["dimensionsSpec"]["dimensions"]] == ["long", "string", "double"]
    server.asked.clear()
    server.answers["POST", "/db/n/tx/commit"] = {"results": [{"columns": SCHEMA.names, "data": [{"row": list(r)} for r in ROWS]}], "errors": []}
    options = {"uri": f"http://{server.host}", "username": "u", "password": "p", "database": "n", "query": "CREATE (a {name: $n})", "queryParamPosition": {"n": 1}}
    services.write(frame, "Neo4j", options)
    services.write(frame, "Neo4j", {**options, "write_mode": "Batch"})
    one, batch = bodies(server)
    assert [s["parameters"] for s in one["statements"]] == [{"n": r[1]} for r in ROWS] and len(batch["statements"][0]["parameters"]["batch"]) == 3
    assert found(services.read(spark, "Neo4j", options, SCHEMA)) == DICTS
    server.answers["POST", "/dbs/d"] = {"code": 0, "data": {"data": [list(r) for r in ROWS]}}
    assert found(services.read(spark, "OpenMldb", {"host": "127.0.0.1", "port": server.server_port, "database": "d", "sql": "select 1"}, SCHEMA)) == DICTS


def test_chats(spark, server):
    one = spark.createDataFrame([(1, "a", 0.5)], SCHEMA)
    at = f"http://{server.host}/hook"
    server.answers["POST", "/hook"] = {"errcode": 0}
    services.write(one, "Slack", {"webhooks_url": at, "oauth_token": "t", "slack_channel": "c"})
    services.write(one, "Feishu", {"url": at, "headers": {"X": "y"}})
    services.write(one, "DingTalk", {"url": f"{at}?access_token=z", "secret": "s"})
    services.write(one, "Enterprise-WeChat", {"url": at, "mentioned_list": ["@all"]})
    slack, feishu, ding, chat = bodies(server)
    assert json.loads(slack["text"]) == DICTS[0] and feishu == DICTS[0] and json.loads(ding["text"]["content"]) == DICTS[0] and chat["text"]["mentioned_list"] == ["@all"]
    query = server.asked[2][2]
    assert query["access_token"] == "z" and query["sign"] == messages.dingtalk_signature("s", int(query["timestamp"]))
    services.write(one, "Sentry", {"dsn": f"http://key@{server.host}/5", "env": "e"})
    assert server.asked[-1][1] == "/api/5/store/" and "sentry_key=key" in server.asked[-1][3]["X-Sentry-Auth"] and bodies(server)[-1]["environment"] == "e"
    server.answers["POST", "/hook"] = {"errcode": 9, "errmsg": "bad"}
    with pytest.raises(Exception, match="bad"):
        services.write(one, "Enterprise-WeChat", {"url": at})


def test_queues(spark, server, frame):
    queue: list = []

    def publish(q, b, s):
        queue.append(json.loads(b)["payload"])
        return {"routed": True}

    server.answers["POST", "/api/exchanges/%2F/amq.default/publish"] = publish
    server.answers["POST", "/api/queues/%2F/q/get"] = lambda q, b, s: [{"payload": queue.pop(0), "payload_encoding": "string"} for _ in queue[:2]]
    options = {"host": "127.0.0.1", "management_port": server.server_port, "queue_name": "q", "username": "u", "password": "p"}
    services.write(frame, "Rabbitmq", options)
    assert found(services.read(spark, "Rabbitmq", options, SCHEMA)) == DICTS and not queue
    services.write(frame, "Pulsar", {"admin.service-url": server.host, "topic": "t", "partition_key_fields": ["id"]})
    sent = bodies(server, "/topics/persistent/public/default/t")[0]["messages"]
    assert [m["key"] for m in sent] == ["1", "2", "3"] and json.loads(sent[1]["payload"]) == DICTS[1]


def test_signature():
    """The published example of a signed request."""
    now = dt.datetime(2015, 8, 30, 12, 36, tzinfo=dt.UTC)
    made = aws.signed("service", "us-east-1", "AKIDEXAMPLE", "wJalrXUtnFEMI/K7MDENG+bPxRfiCYEXAMPLEKEY", "https://example.amazonaws.com/", {}, b"", now)
    assert made["Authorization"].endswith("SignedHeaders=host;x-amz-date, Signature=5da7c1a2acd57cee7505fc6676e4e544621c30862966e37dddb68e92efbe5d6b")


def test_cloud_tables_and_queues(spark, server, frame):
    table, queue = [], []

    def asked(q, b, s):
        target, body = server.asked[-1][3]["X-Amz-Target"].split(".")[1], json.loads(b)
        if target == "BatchWriteItem":
            some = body["RequestItems"]["t"]
            table.extend(x["PutRequest"]["Item"] for x in some[:2])
            return {"UnprocessedItems": {"t": some[2:]} if some[2:] else {}}
        if target == "Scan":
            own = table[body["Segment"] :: body["TotalSegments"]]
            at = body.get("ExclusiveStartKey", {}).get("n", 0)
            return {"Items": own[at : at + 1], **({"LastEvaluatedKey": {"n": at + 1}} if at + 1 < len(own) else {})}
        if target == "SendMessageBatch":
            queue.extend(x["MessageBody"] for x in body["Entries"])
            return {}
        if target == "ReceiveMessage":
            return {"Messages": [{"Body": queue.pop(0), "ReceiptHandle": "h"} for _ in queue[:2]]}
        return {}

    server.answers["POST", "/"] = asked
    options = {"url": f"http://{server.host}/", "region": "r", "access_key_id": "k", "secret_access_key": "s", "table": "t", "delete_message": True}
    services.write(frame, "AmazonDynamoDB", options)
    assert table[1] == {"id": {"N": "2"}, "name": {"S": "b\"é"}, "v": {"NULL": True}}
    assert found(services.read(spark, "AmazonDynamoDB", options, SCHEMA)) == DICTS
    options["url"] = f"http://{server.host}/1/q"
    services.write(frame, "AmazonSqs", options)
    assert found(services.read(spark, "AmazonSqs", options, SCHEMA)) == DICTS


def test_google(spark, server, frame):
    account = base64.b64encode(json.dumps({"client_email": "a@b", "private_key": "", "token_uri": f"http://{server.host}/token"}).encode()).decode()
    server.answers["GET", "/v4/spreadsheets/s/values/p%21A1%3AC9"] = {"values": [["id", "name", "v"], [1, "a", 0.5], [2, "b\"é"], [3, "c", -1.0]]}
    options = {"access_token": "T", "sheet_id": "s", "sheet_name": "p", "range": "A1:C9", "url": f"http://{server.host}"}
    df = services.read(spark, "GoogleSheets", options)
    assert [json.loads(r.content) for r in df.collect()][0] == DICTS[0] and df.count() == 3
    server.asked.clear()
    services.write(frame, "GoogleFirestore", {"project_id": "p", "collection": "c", "credentials": account, "access_token": "T", "primary_keys": ["id"], "url": f"http://{server.host}"})
    sent = bodies(server, "/v1/projects/p/databases/(default)/documents:commit")[0]["writes"]
    assert sent[0]["update"] == {"name": "projects/p/databases/(default)/documents/c/1", "fields": {"id": {"integerValue": "1"}, "name": {"stringValue": "a"}, "v": {"doubleValue": 0.5}}}
    assert server.asked[-1][3]["Authorization"] == "Bearer T"


def test_parts_by_hash(spark, server):
    """Each part asks for its share, and the hosts take turns."""
    asked = []

    def rows(part):
        return [r for i, r in enumerate(ROWS) if i % 2 == part]

    def doris(q, b, s):
        asked.append(json.loads(b)["stmt"])
        return {"code": 0, "data": {"meta": [{"name": n} for n in SCHEMA.names], "data": [list(r) for r in rows(int(asked[-1][-2]))]}}

    def starrocks(q, b, s):
        asked.append(json.loads(b)["query"])
        return "\n".join([json.dumps({"meta": [{"name": n} for n in SCHEMA.names]}), *(json.dumps({"data": list(r)}) for r in rows(int(asked[-1][-3])))]).encode()

    def clickhouse(q, b, s):
        asked.append(b.decode().removesuffix(" FORMAT JSONEachRow"))
        return "\n".join(json.dumps(dict(zip(SCHEMA.names, r, strict=True))) for r in rows(int(asked[-1][-1]))).encode()

    server.answers["POST", "/api/query/default_cluster/d"], server.answers["POST", "/api/v1/catalogs/default_catalog/databases/d/sql"], server.answers["POST", "/"] = doris, starrocks, clickhouse
    options = {"fenodes": server.host, "nodes": server.host, "host": server.host, "database": "d", "table": "t", "sql": "SELECT * FROM t;", "partition_column": "id", "partition_num": 2}
    for name, share in (("Doris", "MURMUR"), ("StarRocks", "MURMUR"), ("Clickhouse", "cityHash64")):
        asked.clear()
        df = services.read(spark, name, options, SCHEMA)
        assert found(df) == DICTS and len(asked) == 2 and all(share in a and "WHERE" in a for a in asked), name


def test_a_queue_is_settled_after_the_sinks(spark, server, tmp_path):
    """Messages are deleted when the sinks have ended, once each; a job that fails leaves them."""
    queue, hidden, deleted, sent = {}, set(), [], []

    def asked(q, b, s):
        target, body = server.asked[-1][3]["X-Amz-Target"].split(".")[1], json.loads(b)
        if target == "SendMessageBatch":
            sent.extend(x["MessageDeduplicationId"] for x in body["Entries"])
        if target == "ReceiveMessage":
            page = [k for k in queue if k not in hidden][:2]
            hidden.update(page)
            return {"Messages": [{"Body": queue[k], "ReceiptHandle": k} for k in page]}
        if target == "DeleteMessageBatch":
            deleted.extend(x["ReceiptHandle"] for x in body["Entries"])
        return {}

    server.answers["POST", "/"] = asked
    queue.update({f"h{i}": json.dumps({"id": i}) for i in range(25)})
    source = {"plugin_name": "AmazonSqs", "url": f"http://{server.host}/1/q", "region": "r", "access_key_id": "k", "secret_access_key": "s", "delete_message": True, "parallelism": 2, "schema": {"fields": {"id": "bigint"}}}
    sink = {"plugin_name": "LocalFile", "path": str(tmp_path / "out"), "file_format_type": "parquet"}
    with pytest.raises(ValueError):
        job.run_job(spark, {"source": [source], "sink": [{"plugin_name": "own"}]}, plugins={"own": lambda *a: int("no")})
    assert not deleted and len(hidden) == 25
    hidden.clear()  # their visibility timeout ends
    job.run_job(spark, {"source": [source], "sink": [sink, {**sink, "path": str(tmp_path / "two")}]})
    for name in ("out", "two"):
        assert sorted(r.id for r in spark.read.parquet(str(tmp_path / name)).collect()) == list(range(25))
    assert sorted(deleted) == sorted(queue)
    made = services.WRITTEN["AmazonSqs"]({**source, "message_group_id": "g"}, {})
    for _ in range(2):  # a task that runs again names its rows the same
        made.send([core.Row({"id": 1}), core.Row({"id": 1})], "0-0")
    assert len(sent) == 4 and len(set(sent)) == 2


def test_records_of_apis(spark, server):
    server.answers["POST", "/rpc"] = {"result": "0x1f"}
    assert services.read(spark, "Web3j", {"url": f"http://{server.host}/rpc"}, T._parse_datatype_string("blockNumber long, timestamp string")).first().blockNumber == 31
    server.answers["POST", "/login"] = {"accessToken": "T"}
    server.answers["GET", "/hours"] = {"data": DICTS}
    df = services.read(spark, "MyHours", {"url": f"http://{server.host}/hours", "login_url": f"http://{server.host}/login", "email": "e", "password": "p", "content_field": "$.data[*]"}, SCHEMA)
    assert found(df) == DICTS and server.asked[-1][3]["Authorization"] == "Bearer T"


@pytest.fixture
def tcp():
    """A server whose handler is given by the test."""
    made = []

    def start(handle):
        class Handler(socketserver.StreamRequestHandler):
            def handle(self):
                handle(self.rfile, self.wfile)

        class Server(socketserver.ThreadingTCPServer):
            allow_reuse_address, daemon_threads = True, True

        s = Server(("127.0.0.1", 0), Handler)
        threading.Thread(target=s.serve_forever, daemon=True).start()
        made.append(s)
        return s.server_address[1]

    yield start
    for s in made:
        s.shutdown()


def redis_server(store):
    def handle(r, w):
        while line := r.readline():
            parts = []
            for _ in range(int(line[1:])):
                size = int(r.readline()[1:])
                parts.append(r.read(size + 2)[:-2].decode())
            name, *a = parts
            bulk = lambda x: b"$-1\r\n" if x is None else b"$%d\r\n%s\r\n" % (len(x.encode()), x.encode())
            many = lambda xs: b"*%d\r\n" % len(xs) + b"".join(map(bulk, xs))
            if name == "SET":
                store[a[0]] = a[1]
            elif name == "HSET":
                store.setdefault(a[0], {}).update(zip(a[1::2], a[2::2], strict=True))
            elif name == "LPUSH":
                store.setdefault(a[0], []).insert(0, a[1])
            elif name == "DEL":
                store.pop(a[0], None)
            elif name == "EXPIRE":
                store["expired"] = a
            if name == "SCAN":
                head = a[2].rstrip("*")
                keys = sorted(k for k in store if k.startswith(head))
                w.write(b"*2\r\n" + (bulk("5") + many(keys[:2]) if a[0] == "0" else bulk("0") + many(keys[1:])))
            elif name == "GET":
                w.write(bulk(store.get(a[0])))
            elif name == "HGETALL":
                w.write(many([x for k, v in store[a[0]].items() for x in (k, v)]))
            elif name == "LRANGE":
                w.write(many(store[a[0]]))
            elif name == "AUTH" and a != ["u", "p"]:
                w.write(b"-ERR no\r\n")
            else:
                w.write(b"+OK\r\n" if name in ("SET", "AUTH", "SELECT") else b":1\r\n")

    return handle


def test_redis(spark, tcp, frame):
    store: dict = {}
    options = {"host": "127.0.0.1", "port": tcp(redis_server(store)), "auth": "p", "user": "u", "db_num": 2, "key": "k:{id}", "support_custom_key": True, "data_type": "key", "expire": 9, "keys": "k:*"}
    services.write(frame, "Redis", options)
    assert json.loads(store["k:2"]) == DICTS[1] and store.pop("expired")[1] == "9"
    assert found(services.read(spark, "Redis", options, SCHEMA)) == DICTS
    gone = spark.createDataFrame([(2, "-D")], "id int, _row_kind string")
    services.write(gone, "Redis", {**options, "primary_keys": ["id"]})
    assert sorted(store) == ["k:1", "k:3"]
    services.write(frame, "Redis", {**options, "key": "h:{id}", "data_type": "hash", "expire": -1})
    assert store["h:1"] == {"id": "1", "name": "a", "v": "0.5"}
    df = services.read(spark, "Redis", {**options, "keys": "h:*", "data_type": "hash"}, T._parse_datatype_string("id string, name string"))
    assert sorted(map(tuple, df.collect())) == [(str(i), n) for i, n, _ in ROWS]
    services.write(frame, "Redis", {**options, "key": "list", "support_custom_key": False, "data_type": "list", "value_field": "name", "expire": -1})
    assert store["list"] == ["c", "b\"é", "a"]
    with pytest.raises(Exception, match="ERR no"):
        services.write(frame, "Redis", {**options, "auth": "x"})


def test_sockets(spark, tcp, frame):
    lines: list = []
    services.write(frame, "Socket", {"host": "127.0.0.1", "port": tcp(lambda r, w: lines.extend(r.read().splitlines()))})
    assert [json.loads(x) for x in lines] == DICTS
    df = services.read(spark, "Socket", {"host": "127.0.0.1", "port": tcp(lambda r, w: w.write(b"a\r\nb c\n"))}, T._parse_datatype_string("line string"))
    assert [r.line for r in df.collect()] == ["a", "b c"]


def test_activemq(spark, tcp, frame):
    got: list = []

    def handle(r, w):
        text = b""
        while c := r.read(1):
            text += c
            if c == b"\x00":
                head, _, body = text[:-1].decode().lstrip("\n").partition("\n\n")
                command, *headers = head.split("\n")
                got.append((command, dict(h.split(":", 1) for h in headers), body))
                if command == "CONNECT":
                    w.write(b"CONNECTED\nversion:1.2\n\n\x00\n")
                elif "receipt" in got[-1][1]:
                    w.write(b"RECEIPT\nreceipt-id:last\n\n\x00")
                text = b""

    services.write(frame, "Activemq", {"uri": "tcp://127.0.0.1:61616", "stomp_port": tcp(handle), "queue_name": "q", "username": "u", "password": "p"})
    assert got[0][1]["login"] == "u" and [json.loads(b) for c, _, b in got if c == "SEND"] == DICTS and got[1][1]["destination"] == "/queue/q"


def test_email(spark, tcp, frame):
    got: list = []

    def handle(r, w):
        w.write(b"220 x\r\n")
        while line := r.readline():
            word = line.split()[0].upper()
            if word == b"DATA":
                w.write(b"354 go\r\n")
                while (line := r.readline()) != b".\r\n":
                    got.append(line.decode())
            w.write(b"221 bye\r\n" if word == b"QUIT" else b"250 ok\r\n")

    services.write(frame, "Email", {"email_from_address": "a@b.c", "email_to_address": "d@e.f", "email_host": "127.0.0.1", "email_smtp_port": tcp(handle), "email_smtp_auth": False, "email_message_headline": "Head", "email_message_content": "Body"})
    text = "".join(got)
    assert "Subject: Head" in text and "Body" in text and 'filename="0-0.csv"' in text


def test_models(spark, server):
    server.answers["POST", "/chat"] = lambda q, b, s: {"choices": [{"message": {"content": json.loads(b)["messages"][0]["content"].splitlines()[-1].upper()}}]}
    server.answers["POST", "/embed"] = lambda q, b, s: {"data": [{"index": i, "embedding": [len(t), 0.5]} for i, t in reversed(list(enumerate(json.loads(b)["input"])))]}
    server.answers["POST", "/own"] = lambda q, b, s: {"out": [{"v": [1.0, float(len(t))]} for t in json.loads(b)["t"]]}
    job = run_job(spark, f"""env {{ job.mode = BATCH }}
source {{ FakeSource {{ schema = {{ fields {{ id = int, name = string }} }}\n rows = [ {{ kind = INSERT, fields = [1, "ab"] }}, {{ kind = INSERT, fields = [2, "abc"] }} ] }} }}
transform {{ LLM {{ model_provider = OPENAI, model = m, api_key = k, api_path = "http://{server.host}/chat", prompt = "say", inference_columns = ["name"], output_column_name = answer }}
 Embedding {{ model_provider = OPENAI, model = m, api_key = k, api_path = "http://{server.host}/embed", vectorization_fields {{ e = name }} }}
 Embedding {{ model_provider = CUSTOM, model = m, api_path = "http://{server.host}/own", custom_config = {{ custom_response_parse = "$.out[*].v", custom_request_headers = {{ X = y }}, custom_request_body = {{ model = "${{model}}", t = "${{input}}" }} }}, vectorization_fields {{ c = name }} }} }}
sink {{ Assert {{ rules {{ row_rules = [ {{ rule_type = MIN_ROW, rule_value = 2 }} ] }} }} }}""")
    rows = next(iter(job.datasets["transform_2"].values())).orderBy("id").collect()
    assert [(r.answer, list(r.e), list(r.c)) for r in rows] == [('{"NAME":"AB"}', [2.0, 0.5], [1.0, 2.0]), ('{"NAME":"ABC"}', [3.0, 0.5], [1.0, 3.0])]
    with pytest.raises(ValueError, match="unknown model_provider"):
        models.client("LLM", {"model_provider": "NOBODY"})


def test_services_in_jobs(spark, server):
    server.answers["POST", "/"] = server.answers["POST", ""] = lambda q, b, s: "\n".join(map(json.dumps, DICTS)).encode()
    server.answers["POST", "/_bulk"] = {"errors": False}
    run_job(spark, f"""env {{ job.mode = BATCH }}
source {{ Clickhouse {{ host = "{server.host}", database = d, sql = "SELECT 1", username = u, password = p, schema = {{ fields {{ id = int, name = string, v = double }} }} }} }}
sink {{ Elasticsearch {{ hosts = ["{server.host}"], index = i, max_batch_size = 100 }} }}""")
    assert [x for x in ndjson(server.asked[-1][4]) if "index" not in x] == DICTS
    with pytest.raises(rules.OptionError, match="hosts is missing"):
        run_job(spark, "source { FakeSource { schema = { fields { id = int } } } }\nsink { Elasticsearch { index = i } }")
