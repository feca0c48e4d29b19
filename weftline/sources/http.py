"""HTTP endpoints as a source and a sink.

Requests are made by executors: with a known number of pages each page is a
task of its own, else one task turns the pages until one is short.  A task
holds one response at a time; records are handed on as JSON texts, and Spark
parses them to the schema.  A task that runs again makes its requests again,
so the sink delivers each row at least once.
"""

from __future__ import annotations

import base64
import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, SimpleDataSourceStreamReader, WriterCommitMessage

FORMAT = "weftline_http"


def _basic(text: str) -> str:
    return "Basic " + base64.b64encode(text.encode()).decode()


#: How services that are plain HTTP below want their credentials.
SERVICES = {
    "Http": lambda o: {},
    "Github": lambda o: {"Authorization": f"Bearer {o['access_token']}"} if o.get("access_token") else {},
    "Gitlab": lambda o: {"PRIVATE-TOKEN": o["access_token"]},
    "Jira": lambda o: {"Authorization": _basic(f"{o['email']}:{o['api_token']}")},
    "Klaviyo": lambda o: {"Authorization": f"Klaviyo-API-Key {o['private_key']}", "revision": str(o["revision"])},
    "Lemlist": lambda o: {"Authorization": _basic(f":{o['password']}")},
    "Notion": lambda o: {"Authorization": f"Bearer {o['password']}", "Notion-Version": str(o["version"])},
    "OneSignal": lambda o: {"Authorization": f"Basic {o['password']}"},
    "Persistiq": lambda o: {"x-api-key": o["password"]},
}


def at_path(value, path: str) -> list:
    """The values at a JSON path of names, [n], [*] and .*, in order; a step that leads nowhere gives none."""
    found = [value]
    for name, index in re.findall(r"\.([^.\[\]]+)|\[([^\]]*)\]", path):
        step = name or index.strip("'\"")
        if step == "*":
            found = [x for v in found for x in (v if isinstance(v, list) else v.values() if isinstance(v, dict) else ())]
        elif re.fullmatch(r"\d+", step) and not name:
            found = [v[int(step)] for v in found if isinstance(v, list) and int(step) < len(v)]
        else:
            found = [v[step] for v in found if isinstance(v, dict) and step in v]
    return found


def records(text: str, options: dict) -> Iterator[str]:
    """The records of a response as texts: all of it, its lines, or by format json the elements at content_field, or rows zipped from json_field."""
    if options.get("format", "text").lower() != "json":
        yield from text.splitlines() if options.get("enable_multi_lines") else [text]
        return
    for one in [x for x in text.splitlines() if x.strip()] if options.get("enable_multi_lines") else [text]:
        value = json.loads(one)
        if options.get("json_field"):
            columns = {name: at_path(value, path) for name, path in options["json_field"].items()}
            if len({len(c) for c in columns.values()}) > 1:
                raise ValueError(f"json_field finds columns of different lengths: { {n: len(c) for n, c in columns.items()} }")
            rows = [dict(zip(columns, r, strict=True)) for r in zip(*columns.values(), strict=True)]
        else:
            rows = at_path(value, options.get("content_field") or "$")
            rows = [x for v in rows for x in (v if isinstance(v, list) else [v])]
        yield from (json.dumps(r, ensure_ascii=False) for r in rows)


def request(options: dict, page: int | None = None, body: str | None = None) -> str:
    """One request with its retries; a page number fills ${field}, or is a parameter where no placeholder asks for it.

    Refused and broken connections, 429 and 5xx are tried again after a pause that doubles; other answers raise at once.
    """
    params = {k: str(v) for k, v in (options.get("params") or {}).items()}
    url, body, field = options["url"], body or options.get("body"), (options.get("pageing") or {}).get("page_field")
    if page is not None and field:
        mark, asked = f"${{{field}}}", False
        filled = []
        for text in (url, body, *params.values()):
            asked |= mark in (text or "")
            filled.append(text and text.replace(mark, str(page)))
        url, body, params = filled[0], filled[1], dict(zip(params, filled[2:], strict=True))
        if not asked:
            params[field] = str(page)
    headers = {k: str(v) for k, v in (options.get("headers") or {}).items()}
    method = options.get("method", "GET").upper()
    if options.get("keep_params_as_form") and method == "POST":
        body, params = urllib.parse.urlencode(params), {}
        headers.setdefault("Content-Type", "application/x-www-form-urlencoded")
    elif params:
        url += ("&" if "?" in url else "?") + urllib.parse.urlencode(params)
    if body is not None:
        headers.setdefault("Content-Type", "application/json")
    times, pause, most = int(options.get("retry") or 0), float(options.get("retry_backoff_multiplier_ms", 100)), float(options.get("retry_backoff_max_ms", 10000))
    for tried in range(times + 1):
        try:
            asked = urllib.request.Request(url, body.encode() if body is not None else None, headers, method=method)
            with urllib.request.urlopen(asked, timeout=float(options.get("socket_timeout_ms", 60000)) / 1000) as answer:
                return answer.read().decode(answer.headers.get_content_charset() or "utf-8")
        except OSError as e:
            if tried == times or isinstance(e, urllib.error.HTTPError) and e.code != 429 and e.code < 500:
                raise
            time.sleep(min(most, pause * 2**tried) / 1000)
    raise AssertionError("unreachable")


class Page(InputPartition):
    def __init__(self, number: int | None):
        self.number = number


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.paging = options.get("pageing") or {}

    def partitions(self):
        if not self.paging:
            return [Page(None)]
        first = int(self.paging.get("start_page_number", 1))
        total = self.paging.get("total_page_size")
        return [Page(first + i) for i in range(int(total))] if total else [Page(first)]

    def read(self, partition: Page):
        number, open_end = partition.number, bool(self.paging) and not self.paging.get("total_page_size")
        while True:
            count = 0
            for count, text in enumerate(records(request(self.options, number), self.options), 1):
                yield (text,)
            if not open_end or count < max(1, int(self.paging.get("batch_size", 1))):
                return
            number += 1


class _Poll(SimpleDataSourceStreamReader):
    """A batch for each poll, `poll_interval_millis` apart; a batch that is given again is asked for again."""

    def __init__(self, options: dict):
        self.reader = _Reader(options)
        self.pause = float(options.get("poll_interval_millis") or 0) / 1000
        self.last = None

    def initialOffset(self) -> dict:
        return {"polls": 0}

    def read(self, start: dict):
        if self.last is not None:
            time.sleep(max(0.0, self.last + self.pause - time.monotonic()))
        self.last = time.monotonic()
        end = {"polls": start["polls"] + 1}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([row for page in self.reader.partitions() for row in self.reader.read(page)])


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator):
        size, held = int(self.options.get("batch_size", 1)), []
        for row in iterator:
            held.append(row[0])
            if len(held) >= size:
                self.post(held, size)
                held = []
        if held:
            self.post(held, size)
        return WriterCommitMessage()

    def post(self, rows: list[str], size: int) -> None:
        """One request: a row as an object, or by a `batch_size` above 1 several as a list."""
        request({**self.options, "method": "POST"}, body=rows[0] if size == 1 else f"[{','.join(rows)}]")


class HttpSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "value string"

    def reader(self, schema):
        return _Reader(json.loads(self.options[SECRET]))

    def simpleStreamReader(self, schema):
        return _Poll(json.loads(self.options[SECRET]))

    def writer(self, schema, overwrite):
        return _Writer(json.loads(self.options[SECRET]))


#: The option that carries a job's options; Spark's redaction knows its name, so that plans and event logs do not show credentials.
SECRET = "job_secret"


def _job(spark: SparkSession, options: dict, service: str) -> str:
    spark.dataSource.register(HttpSource)
    return json.dumps({**options, "headers": {**SERVICES[service](options), **(options.get("headers") or {})}})


def read(spark: SparkSession, options: dict, schema: T.StructType | None = None, service: str = "Http", stream: bool = False) -> DataFrame:
    """Rows of the schema by format json, a record that does not fit it being an error; else, or without a schema, texts in one column `content`."""
    if not options.get("url"):
        raise ValueError("http needs url")
    df = (spark.readStream if stream else spark.read).format(FORMAT).option(SECRET, _job(spark, options, service)).load()
    if schema is None or options.get("format", "text").lower() != "json":
        return df.withColumnRenamed("value", "content")
    return df.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).filter("r IS NOT NULL").select("r.*")


def write(df: DataFrame, options: dict) -> None:
    """Each row posted as a JSON object, or `batch_size` of them as a list; row metadata is not sent."""
    if not options.get("url"):
        raise ValueError("http needs url")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value")).write.format(FORMAT).mode("append").option(SECRET, _job(df.sparkSession, options, "Http")).save()
