"""Cloud services whose requests are signed."""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import json
import urllib.parse
import uuid

from weftline.sources.services.core import ServiceError, Sink, Source, call, sink, source


def signed(service: str, region: str, key: str, secret: str, url: str, headers: dict, body: bytes, now: dt.datetime) -> dict:
    """Headers of a POST request with its version 4 signature."""
    at = urllib.parse.urlsplit(url)
    stamp, day = now.strftime("%Y%m%dT%H%M%SZ"), now.strftime("%Y%m%d")
    headers = {**{k.lower(): v for k, v in headers.items()}, "host": at.netloc, "x-amz-date": stamp}
    names = ";".join(sorted(headers))
    request = "\n".join(["POST", at.path or "/", at.query, *(f"{k}:{headers[k].strip()}" for k in sorted(headers)), "", names, hashlib.sha256(body).hexdigest()])
    scope = f"{day}/{region}/{service}/aws4_request"
    text = "\n".join(["AWS4-HMAC-SHA256", stamp, scope, hashlib.sha256(request.encode()).hexdigest()])
    k = f"AWS4{secret}".encode()
    for part in (day, region, service, "aws4_request"):
        k = hmac.new(k, part.encode(), hashlib.sha256).digest()
    mark = hmac.new(k, text.encode(), hashlib.sha256).hexdigest()
    headers["Authorization"] = f"AWS4-HMAC-SHA256 Credential={key}/{scope}, SignedHeaders={names}, Signature={mark}"
    headers.pop("host")  # the client adds it
    return headers


def _asked(service: str, target: str, version: str, url: str, options: dict, body: dict) -> dict:
    data = json.dumps(body).encode()
    headers = {"Content-Type": f"application/x-amz-json-{version}", "X-Amz-Target": target}
    key, secret = options.get("access_key_id", ""), options.get("secret_access_key") or options.get("secret_access_key_id", "")
    headers = signed(service, options["region"], key, secret, url, headers, data, dt.datetime.now(dt.UTC))
    headers["Content-Type"] = headers.pop("content-type")
    return json.loads(call("POST", url, data, headers, options) or b"{}")


def _attribute(value) -> dict:
    if value is None:
        return {"NULL": True}
    if isinstance(value, bool):
        return {"BOOL": value}
    if isinstance(value, (int, float)):
        return {"N": repr(value)}
    if isinstance(value, list):
        return {"L": [_attribute(v) for v in value]}
    if isinstance(value, dict):
        return {"M": {k: _attribute(v) for k, v in value.items()}}
    return {"S": str(value)}


def _plain(attribute: dict):
    (kind, value), = attribute.items()
    if kind == "N":
        return float(value) if any(c in value for c in ".eE") else int(value)
    if kind == "L":
        return [_plain(v) for v in value]
    if kind == "M":
        return {k: _plain(v) for k, v in value.items()}
    if kind == "NS":
        return [_plain({"N": v}) for v in value]
    return None if kind == "NULL" else value


def _dynamo(options: dict, action: str, body: dict) -> dict:
    return _asked("dynamodb", f"DynamoDB_20120810.{action}", "1.0", options["url"], options, body)


@sink("AmazonDynamoDB")
def dynamo(options: dict, values: dict) -> Sink:
    """Rows put by batches of at most 25; a row replaces the one of its key, and one taken away is deleted by primary_keys."""
    keys = options.get("primary_keys") or []

    def send(rows, number):
        left = {options["table"]: [{"DeleteRequest": {"Key": {k: _attribute(r.fields[k]) for k in keys}}} if r.gone else {"PutRequest": {"Item": {k: _attribute(v) for k, v in r.fields.items()}}} for r in rows]}
        for _ in range(20):
            left = _dynamo(options, "BatchWriteItem", {"RequestItems": left}).get("UnprocessedItems") or {}
            if not left:
                return
        raise ServiceError("rows were left over again and again")

    return Sink(min(25, int(options.get("batch_size", 25))), send, keyed=True)


@source("AmazonDynamoDB")
def from_dynamo(options: dict, schema) -> Source:
    """A scan by segments, one a task."""
    n = int(options.get("parallel_scan_threads", 2))

    def fetch(part):
        start = None
        while True:
            page = _dynamo(options, "Scan", {"TableName": options["table"], "Segment": part, "TotalSegments": n, "Limit": int(options.get("scan_item_limit", 1000)), **({"ExclusiveStartKey": start} if start else {})})
            yield from ({k: _plain(v) for k, v in item.items()} for item in page.get("Items", []))
            start = page.get("LastEvaluatedKey")
            if not start:
                return

    return Source(list(range(n)), fetch)


def _queue(options: dict, action: str, body: dict) -> dict:
    url = urllib.parse.urlsplit(options["url"])
    return _asked("sqs", f"AmazonSQS.{action}", "1.0", f"{url.scheme}://{url.netloc}/", options, {"QueueUrl": options["url"], **body})


@sink("AmazonSqs")
def sqs(options: dict, values: dict) -> Sink:
    """Messages by tens; in a queue with groups the number of a row names it, so a task that runs again adds none."""
    group, load = options.get("message_group_id"), uuid.uuid4().hex

    def send(rows, number):
        said = _queue(options, "SendMessageBatch", {"Entries": [{"Id": str(i), "MessageBody": json.dumps(r.fields, ensure_ascii=False), **({"MessageGroupId": group, "MessageDeduplicationId": f"{load}-{number}-{i}"} if group else {})} for i, r in enumerate(rows)]})
        if said.get("Failed"):
            raise ServiceError(json.dumps(said["Failed"][0]))

    return Sink(10, send)


@source("AmazonSqs")
def from_sqs(options: dict, schema) -> Source:
    """What the queue gives until an answer is empty, to `parallelism` tasks.

    With `delete_message` the messages are deleted when the job's sinks have
    ended; they must end within the queue's visibility timeout, or the messages
    come again.
    """
    deletes = bool(options.get("delete_message"))

    def fetch(part):
        while True:
            page = _queue(options, "ReceiveMessage", {"MaxNumberOfMessages": 10}).get("Messages") or []
            for m in page:
                body = json.loads(m["Body"])
                yield {**body, "_receipt": m["ReceiptHandle"]} if deletes else body
            if not page:
                return

    def settle(receipts):
        for at in range(0, len(receipts), 10):
            said = _queue(options, "DeleteMessageBatch", {"Entries": [{"Id": str(i), "ReceiptHandle": r} for i, r in enumerate(receipts[at : at + 10])]})
            if said.get("Failed"):
                raise ServiceError(json.dumps(said["Failed"][0]))

    return Source(list(range(int(options.get("parallelism", 1)))), fetch, settle if deletes else None)
