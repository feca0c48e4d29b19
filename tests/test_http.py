"""The HTTP source and sink against a server of this process."""

from __future__ import annotations

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from weftline.plans.job import run_job
from weftline.sources import http, readers

ROWS = [{"id": i, "name": f"n{i}", "at": {"x": i / 2}} for i in range(7)]


@pytest.fixture(scope="module")
def server():
    got, tries = [], Counter()

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def send(self, value, code=200):
            body = json.dumps(value).encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            at = urlparse(self.path)
            q = parse_qs(at.query)
            tries[at.path] += 1
            if at.path == "/flaky" and tries[at.path] < 3:
                return self.send({}, 503)
            if at.path == "/missing":
                return self.send({}, 404)
            if at.path == "/token":
                return self.send([{"name": self.headers.get("PRIVATE-TOKEN")}])
            page = int(q.get("page", [0])[0])
            rows = ROWS[(page - 1) * 3 : page * 3] if page else ROWS
            self.send({"data": {"rows": rows}})

        def do_POST(self):
            got.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send({})

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", got, tries
    s.shutdown()


SCHEMA = readers.schema_of({"id": "int", "name": "string"})
WANT = [(i, f"n{i}") for i in range(7)]


@pytest.mark.parametrize("pages", [{}, {"page_field": "page", "batch_size": 3}, {"page_field": "page", "total_page_size": 3}])
def test_pages(spark, server, pages):
    df = http.read(spark, {"url": server[0] + "/rows", "format": "json", "content_field": "$.data.rows.*", **({"pageing": pages} if pages else {})}, SCHEMA)
    assert sorted(map(tuple, df.collect())) == WANT
    assert df.rdd.getNumPartitions() == (3 if "total_page_size" in pages else 1)


def test_json_field_and_text(spark, server):
    options = {"url": server[0] + "/rows", "format": "json", "json_field": {"id": "$.data.rows[*].id", "x": "$.data.rows[*].at.x"}}
    df = http.read(spark, options, readers.schema_of({"id": "int", "x": "double"}))
    assert sorted(map(tuple, df.collect())) == [(i, i / 2) for i in range(7)]
    assert json.loads(http.read(spark, {"url": server[0] + "/rows"}).first().content)["data"]["rows"] == ROWS


def test_retries(server):
    assert http.request({"url": server[0] + "/flaky", "retry": 2, "retry_backoff_multiplier_ms": 1})
    with pytest.raises(OSError):
        http.request({"url": server[0] + "/missing", "retry": 5})
    assert server[2]["/flaky"] == 3 and server[2]["/missing"] == 1


def test_placeholder_and_paths():
    assert http.at_path({"a": [{"b": 1}, {}, {"b": [2, 3]}]}, "$.a[*].b") == [1, [2, 3]]
    assert http.at_path({"a": [1, 2]}, "$.a[1]") == [2] and http.at_path({"a": [1]}, "$.a[4].x") == []
    with pytest.raises(ValueError):
        list(http.records('{"a": [1, 2], "b": [1]}', {"format": "json", "json_field": {"a": "$.a[*]", "b": "$.b[*]"}}))


def test_job_from_and_to_http(spark, server):
    source = {"url": server[0] + "/token", "access_token": "t1", "format": "json", "schema": {"fields": {"name": "string"}}}
    server[1].clear()
    run_job(spark, {"source": {"Gitlab": source}, "sink": {"Http": {"url": server[0] + "/in"}}})
    assert server[1] == [{"name": "t1"}]
    server[1].clear()
    http.write(spark.createDataFrame(WANT, "id int, name string"), {"url": server[0] + "/in"})
    assert sorted((r["id"], r["name"]) for r in server[1]) == WANT


def test_polls(spark, server, tmp_path):
    rows = {r["id"] for r in ROWS}
    job = run_job(spark, f"""env {{ job.mode = STREAMING, checkpoint.path = "{tmp_path}/c" }}
source {{ Http {{ url = "{server[0]}/rows", format = json, content_field = "$.data.rows.*", poll_interval_millis = 10, schema = {{ fields {{ id = int, name = string }} }} }} }}
sink {{ LocalFile {{ path = "{tmp_path}/out" }} }}""")
    job.results[0].awaitTermination(60)
    got = [r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert set(got) == rows and len(got) % len(rows) == 0
