"""What the services share.

A sink gives, for its options, a batch size and a function from a batch of rows
to what is sent; tasks send their partition's rows batch by batch, so a task
holds one batch.  A task that runs again sends its rows again: delivery is at
least once, and exactly once in effect where rows have keys or labels.

A source gives parts, one a task, and a function that fetches a part's records
as dicts, page by page; Spark parses them to the schema.

Options with credentials go to the tasks inside the function, never into the
plan.
"""

from __future__ import annotations

import base64
import json
import ssl
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.sources import changes, shared


class ServiceError(OSError):
    """An answer that says that a request was not carried out."""


@dataclass
class Row:
    """A row to send: its fields, and whether it is taken away."""

    fields: dict
    gone: bool = False


@dataclass
class Sink:
    """`size` rows a batch; `send` gets a batch and its number within the task; `keyed`: rows taken away can be applied."""

    size: int
    send: Callable[[list[Row], str], None]
    keyed: bool = False


@dataclass
class Source:
    """`fetch` gives the records of a part; with `settle` each has a `_receipt`, and these are given back when the rows are safe."""

    parts: list
    fetch: Callable[[object], Iterable[dict]]
    settle: Callable[[list[str]], None] | None = None


WRITTEN: dict[str, Callable[[dict, dict], Sink]] = {}
READ: dict[str, Callable[[dict, T.StructType | None], Source]] = {}


def sink(*names: str):
    def add(fn):
        WRITTEN.update(dict.fromkeys(names, fn))
        return fn

    return add


def source(*names: str):
    def add(fn):
        READ.update(dict.fromkeys(names, fn))
        return fn

    return add


def basic(options: dict, user: str = "username", password: str = "password") -> dict[str, str]:
    if options.get(user) is None:
        return {}
    return {"Authorization": "Basic " + base64.b64encode(f"{options[user]}:{options.get(password) or ''}".encode()).decode()}


def listed(value) -> list[str]:
    return [x.strip() for x in value.split(",")] if isinstance(value, str) else list(value)


def web(host: str) -> str:
    return host.rstrip("/") if "://" in host else f"http://{host.rstrip('/')}"


def call(method: str, url: str, body=None, headers: dict | None = None, options: dict | None = None, params: dict | None = None) -> bytes:
    """One request with its retries; 429, 5xx and broken connections are tried again after a pause that doubles."""

    def whole(answer) -> bytes:
        with answer:
            return answer.read()

    return _requested(method, url, body, headers, options, params, whole)


def lines_of(method: str, url: str, body=None, headers: dict | None = None, options: dict | None = None, params: dict | None = None) -> Iterator[bytes]:
    """The lines of an answer as they come, so that it is never held whole; one that breaks off fails its task."""
    with _requested(method, url, body, headers, options, params, lambda answer: answer) as answer:
        for line in answer:
            if line.strip():
                yield line


def _requested(method: str, url: str, body, headers: dict | None, options: dict | None, params: dict | None, read: Callable):
    options = options or {}
    if params:
        url += ("&" if "?" in url else "?") + urllib.parse.urlencode(params)
    if body is not None and not isinstance(body, (bytes, str)):
        body = json.dumps(body, ensure_ascii=False)
    data = body.encode() if isinstance(body, str) else body
    headers = {"Content-Type": "application/json", **(headers or {})}
    tries = int(options.get("max_retries") or options.get("max_retry_count") or options.get("retry") or 3)
    pause, most = float(options.get("retry_backoff_multiplier_ms") or 100), float(options.get("max_retry_backoff_ms") or options.get("retry_backoff_max_ms") or 10_000)
    check = ssl.create_default_context()
    if str(options.get("tls_verify_certificate", True)).lower() == "false":
        check.check_hostname, check.verify_mode = False, ssl.CERT_NONE
    for tried in range(tries + 1):
        try:
            asked = urllib.request.Request(url, data, headers, method=method)
            answer = urllib.request.urlopen(asked, timeout=float(options.get("http_socket_timeout_ms") or options.get("socket_timeout_ms") or 60_000) / 1000, context=check if url.startswith("https") else None)
            return read(answer)
        except OSError as e:
            refused = isinstance(e, urllib.error.HTTPError) and e.code != 429 and e.code < 500
            if tried == tries or refused:
                if isinstance(e, urllib.error.HTTPError):
                    raise ServiceError(f"{method} {urllib.parse.urlsplit(url).path}: {e.code} {e.read()[:500]!r}") from e
                raise
            time.sleep(min(most, pause * 2**tried) / 1000)
    raise AssertionError("unreachable")


def ask(method: str, url: str, body=None, headers: dict | None = None, options: dict | None = None, params: dict | None = None):
    """`call`, with the answer read as JSON."""
    text = call(method, url, body, headers, options, params)
    return json.loads(text) if text.strip() else None


def key_of(fields: dict, keys: list[str], glue: str = "_") -> str | None:
    return glue.join(str(fields.get(k)) for k in keys) if keys else None


def filled(text: str, fields: dict) -> str:
    """A text with {name} and ${name} replaced by the row's fields."""
    for k, v in fields.items():
        text = text.replace(f"${{{k}}}", str(v)).replace(f"{{{k}}}", str(v))
    return text


def lines(rows: Iterable) -> str:
    return "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)


def write(df: DataFrame, name: str, options: dict, values: dict | None = None) -> None:
    """Sends a frame's rows; changes are reduced to one a key where there is one, else they must all be inserts."""
    made = WRITTEN[name](options, values or {})
    keys = listed(options.get("primary_keys") or (values or {}).get("primary_key") or [])
    keys = [k for k in keys if k]
    if changes.is_changelog(df) and keys and made.keyed:
        df = changes.last_changes(df, keys, listed(options.get("order_by") or []))
        gone = F.col("_row_kind").isin(*changes.GONE)
        df = df.select(gone.alias("_gone"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "_row_kind"]), {"ignoreNullFields": "false"}).alias("row"))
    else:
        df = changes.plain_rows(df, name)
        df = df.select(F.lit(False).alias("_gone"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("row"))
    size, send = max(1, made.size), made.send

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId() if TaskContext.get() else 0, 0, []
        for b in batches:
            for gone, row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.append(Row(json.loads(row), gone))
                if len(held) >= size:
                    send(held, f"{part}-{number}")
                    held, number = [], number + 1
        if held:
            send(held, f"{part}-{number}")
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["sent"])

    df.mapInArrow(run, "sent long").write.format("noop").mode("overwrite").save()


_unsettled: list[tuple[DataFrame, Callable[[list[str]], None]]] = []


def settle(safe: bool = True) -> None:
    """Gives back the receipts of all queues that were read, where their rows are safe; else forgets them, so the messages come again."""
    while _unsettled:
        receipts, give = _unsettled.pop()
        if not safe:
            continue

        def run(batches: Iterator[pa.RecordBatch], give=give) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    give(b.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["given"])

        receipts.mapInArrow(run, "given long").write.format("noop").mode("overwrite").save()


def read(spark: SparkSession, name: str, options: dict, schema: T.StructType | None = None) -> DataFrame:
    """Rows of the schema; without one, each record as JSON in one column `content`."""
    made = READ[name](options, schema)
    fetch, parts = made.fetch, [json.dumps(p) for p in made.parts]
    asked = spark.createDataFrame([(i, p) for i, p in enumerate(parts)], "i long, part string")
    if len(parts) > 1:
        asked = asked.repartitionById(len(parts), F.col("i").cast("int"))

    settles = made.settle is not None

    def packed(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], pa.string()) for i in (0, 1)], ["content", "receipt"])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for part in b.column(0).to_pylist():
                held: list[tuple] = []
                for record in fetch(json.loads(part)):
                    receipt = record.pop("_receipt", None) if settles else None
                    held.append((json.dumps(record, ensure_ascii=False), receipt))
                    if len(held) == 1000:
                        yield packed(held)
                        held = []
                yield packed(held)

    df = asked.select("part").mapInArrow(run, "content string, receipt string")
    if made.settle is not None:
        # What is taken from a queue is written before it is given back, and read from there however often.
        path = shared.folder(spark, "queues")
        df.write.parquet(path)
        df = spark.read.schema("content string, receipt string").parquet(path)
        _unsettled.append((df.select("receipt"), made.settle))
    df = df.select("content")
    if schema is None:
        return df
    return df.select(F.from_json("content", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
