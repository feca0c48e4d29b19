"""Chat, alerting and message services, and APIs that answer with records."""

from __future__ import annotations

import base64
import csv
import hashlib
import hmac
import io
import json
import smtplib
import time
import urllib.parse
import uuid
from email.message import EmailMessage

from weftline.sources.http import at_path
from weftline.sources.services.core import ServiceError, Sink, Source, ask, basic, call, sink, source, web


def _text(row) -> str:
    return json.dumps(row.fields, ensure_ascii=False)


@sink("Slack")
def slack(options: dict, values: dict) -> Sink:
    def send(rows, number):
        for r in rows:
            said = call("POST", options["webhooks_url"], {"channel": options["slack_channel"], "text": _text(r)}, {"Authorization": f"Bearer {options['oauth_token']}"}, options)
            if said.strip().startswith(b"{") and json.loads(said).get("ok") is False:
                raise ServiceError(json.loads(said).get("error"))

    return Sink(1, send)


@sink("Feishu")
def feishu(options: dict, values: dict) -> Sink:
    def send(rows, number):
        for r in rows:
            call("POST", options["url"], r.fields, options.get("headers"), options)

    return Sink(1, send)


def dingtalk_signature(secret: str, at: int) -> str:
    """The signature of a time in milliseconds."""
    return base64.b64encode(hmac.new(secret.encode(), f"{at}\n{secret}".encode(), hashlib.sha256).digest()).decode()


@sink("DingTalk")
def dingtalk(options: dict, values: dict) -> Sink:
    def send(rows, number):
        for r in rows:
            at = int(time.time() * 1000)
            said = ask("POST", options["url"], {"msgtype": "text", "text": {"content": _text(r)}}, None, options, {"timestamp": at, "sign": dingtalk_signature(options["secret"], at)})
            if said and said.get("errcode"):
                raise ServiceError(said.get("errmsg"))

    return Sink(1, send)


@sink("Enterprise-WeChat")
def wechat(options: dict, values: dict) -> Sink:
    def send(rows, number):
        for r in rows:
            text = {"content": _text(r), **{k: options[k] for k in ("mentioned_list", "mentioned_mobile_list") if options.get(k)}}
            said = ask("POST", options["url"], {"msgtype": "text", "text": text}, None, options)
            if said and said.get("errcode"):
                raise ServiceError(said.get("errmsg"))

    return Sink(1, send)


@sink("Sentry")
def sentry(options: dict, values: dict) -> Sink:
    """An event a row, to the project that the dsn names."""
    dsn = urllib.parse.urlsplit(options["dsn"])
    head, project = dsn.path.rstrip("/").rsplit("/", 1)
    url = f"{dsn.scheme}://{dsn.hostname}{f':{dsn.port}' if dsn.port else ''}{head}/api/{project}/store/"

    def send(rows, number):
        for r in rows:
            auth = f"Sentry sentry_version=7, sentry_client=weftline/1, sentry_key={dsn.username}"
            event = {"event_id": uuid.uuid4().hex, "message": _text(r), "level": "info", "platform": "other", **({"environment": options["env"]} if options.get("env") else {}), **({"release": options["release"]} if options.get("release") else {})}
            call("POST", url, event, {"X-Sentry-Auth": auth}, options)

    return Sink(1, send)


@sink("Email")
def email(options: dict, values: dict) -> Sink:
    """A message for each batch, with its rows as a table of comma-separated values."""

    def send(rows, number):
        text = io.StringIO()
        table = csv.DictWriter(text, list(rows[0].fields))
        table.writeheader()
        table.writerows(r.fields for r in rows)
        m = EmailMessage()
        m["From"], m["To"], m["Subject"] = options["email_from_address"], options["email_to_address"], options["email_message_headline"]
        m.set_content(options["email_message_content"])
        m.add_attachment(text.getvalue(), subtype="csv", filename=f"{number}.csv")
        port = int(options.get("email_smtp_port", 465))
        client = smtplib.SMTP_SSL if port == 465 else smtplib.SMTP
        with client(options["email_host"], port, timeout=60) as c:
            if str(options.get("email_smtp_auth", True)).lower() == "true" and options.get("email_authorization_code"):
                if port != 465 and c.has_extn("starttls"):
                    c.starttls()
                c.login(options["email_from_address"], options["email_authorization_code"])
            c.send_message(m)

    return Sink(int(options.get("batch_size", 100_000)), send)


def _rabbit(options: dict) -> tuple[str, str]:
    return f"http://{options['host']}:{options.get('management_port', 15672)}/api", urllib.parse.quote(options.get("virtual_host", "/"), safe="")


@sink("Rabbitmq")
def rabbit(options: dict, values: dict) -> Sink:
    """Messages published by the management interface; to the queue itself, or to an exchange with a routing key."""
    at, host = _rabbit(options)
    exchange, key = options.get("exchange") or "amq.default", options.get("routing_key") or options["queue_name"]

    def send(rows, number):
        for r in rows:
            said = ask("POST", f"{at}/exchanges/{host}/{urllib.parse.quote(exchange)}/publish", {"properties": {}, "routing_key": key, "payload": _text(r), "payload_encoding": "string"}, basic(options), options)
            if not said.get("routed"):
                raise ServiceError(f"no queue for {key}")

    return Sink(1, send)


@source("Rabbitmq")
def from_rabbit(options: dict, schema) -> Source:
    """What a queue holds when it is read, by `parallelism` tasks.

    The management interface takes messages away as it gives them, so those of
    a task that is lost are lost: for queues that must lose none, use another way.
    """
    at, host = _rabbit(options)

    def fetch(part):
        while True:
            page = ask("POST", f"{at}/queues/{host}/{urllib.parse.quote(options['queue_name'])}/get", {"count": 500, "ackmode": "ack_requeue_false", "encoding": "auto"}, basic(options), options)
            for m in page:
                text = m["payload"] if m.get("payload_encoding") == "string" else base64.b64decode(m["payload"]).decode()
                yield json.loads(text)
            if not page:
                return

    return Source(list(range(int(options.get("parallelism", 1)))), fetch)


@sink("Pulsar")
def pulsar(options: dict, values: dict) -> Sink:
    """Messages by the brokers' HTTP producer; the key is of `partition_key_fields`."""
    topic = options["topic"].replace("persistent://", "persistent/")
    topic = topic if topic.startswith("persistent/") else f"persistent/public/default/{topic}"
    keys = options.get("partition_key_fields") or []

    def send(rows, number):
        messages = [{"payload": _text(r), **({"key": "_".join(str(r.fields[k]) for k in keys)} if keys else {})} for r in rows]
        schema = json.dumps({"name": "", "schema": "", "type": "STRING", "properties": {}})
        headers = {"Authorization": f"Bearer {options['auth.params'].removeprefix('token:')}"} if options.get("auth.params") else {}
        said = ask("POST", f"{web(options['admin.service-url'])}/topics/{topic}", {"producerName": options.get("producer", "weftline"), "valueSchema": schema, "keySchema": schema, "messages": messages}, headers, options)
        if bad := [x for x in (said or {}).get("messagePublishResults", []) if x.get("errorCode")]:
            raise ServiceError(json.dumps(bad[0]))

    return Sink(int(options.get("batch_size", 500)), send)


@source("Web3j")
def from_web3(options: dict, schema) -> Source:
    """One record: the chain's latest block number, and when it was asked for."""

    def fetch(part):
        said = ask("POST", options["url"], {"jsonrpc": "2.0", "method": "eth_blockNumber", "params": [], "id": 1}, None, options)
        yield {"blockNumber": int(said["result"], 16), "timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}

    return Source([0], fetch)


@source("MyHours")
def from_myhours(options: dict, schema) -> Source:
    """Records of an endpoint, asked for with the token that a login gives."""

    def fetch(part):
        login = ask("POST", options.get("login_url", "https://api2.myhours.com/api/tokens/login"), {"grantType": "password", "email": options["email"], "password": options["password"], "clientId": "api"}, None, options)
        said = ask(str(options.get("method", "get")).upper(), options["url"], options.get("body"), {"Authorization": f"Bearer {login['accessToken']}", **(options.get("headers") or {})}, options, options.get("params"))
        for v in at_path(said, options.get("content_field") or options.get("content_json") or "$"):
            yield from v if isinstance(v, list) else [v]

    return Source([0], fetch)


def rs256(text: bytes, pem: str) -> bytes:
    """The RSA signature of SHA-256, by a private key in PKCS #8; made by the `cryptography` package."""
    try:
        from cryptography.hazmat.primitives import hashes, serialization
        from cryptography.hazmat.primitives.asymmetric import padding
    except ImportError as e:
        raise ServiceError("a service account's key needs the cryptography package; an access_token as an option does not") from e
    return serialization.load_pem_private_key(pem.encode(), None).sign(text, padding.PKCS1v15(), hashes.SHA256())


def google_token(account: dict, scope: str, options: dict) -> str:
    """The option `access_token`, or a token for a service account."""
    if options.get("access_token"):
        return options["access_token"]
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=")
    now = int(time.time())
    claim = part({"alg": "RS256", "typ": "JWT"}) + b"." + part({"iss": account["client_email"], "scope": scope, "aud": account["token_uri"], "iat": now, "exp": now + 3600})
    signed = claim + b"." + base64.urlsafe_b64encode(rs256(claim, account["private_key"])).rstrip(b"=")
    body = urllib.parse.urlencode({"grant_type": "urn:ietf:params:oauth:grant-type:jwt-bearer", "assertion": signed.decode()})
    return ask("POST", account["token_uri"], body, {"Content-Type": "application/x-www-form-urlencoded"}, options)["access_token"]


def _account(text: str) -> dict:
    return json.loads(text if text.lstrip().startswith("{") else base64.b64decode(text))


@source("GoogleSheets")
def from_sheets(options: dict, schema) -> Source:
    """A range's rows; their fields are named by the schema, or by the range's first row."""
    host = options.get("url", "https://sheets.googleapis.com")

    def fetch(part):
        token = google_token(_account(options.get("service_account_key") or "{}"), "https://www.googleapis.com/auth/spreadsheets.readonly", options)
        where = urllib.parse.quote(f"{options['sheet_name']}!{options['range']}")
        rows = ask("GET", f"{host}/v4/spreadsheets/{options['sheet_id']}/values/{where}", None, {"Authorization": f"Bearer {token}"}, options).get("values") or []
        names = schema.names if schema is not None else rows.pop(0) if rows else []
        yield from (dict(zip(names, [*r, *[None] * (len(names) - len(r))], strict=False)) for r in rows)

    return Source([0], fetch)


def _firestore(value) -> dict:
    if value is None:
        return {"nullValue": None}
    if isinstance(value, bool):
        return {"booleanValue": value}
    if isinstance(value, int):
        return {"integerValue": str(value)}
    if isinstance(value, float):
        return {"doubleValue": value}
    if isinstance(value, list):
        return {"arrayValue": {"values": [_firestore(v) for v in value]}}
    if isinstance(value, dict):
        return {"mapValue": {"fields": {k: _firestore(v) for k, v in value.items()}}}
    return {"stringValue": str(value)}


@sink("GoogleFirestore")
def firestore(options: dict, values: dict) -> Sink:
    """A document a row; with primary_keys the key is its name, so that it replaces the one before."""
    host = options.get("url", "https://firestore.googleapis.com")
    root = f"projects/{options['project_id']}/databases/(default)/documents"
    keys = options.get("primary_keys") or []

    def send(rows, number):
        token = google_token(_account(options.get("credentials") or "{}"), "https://www.googleapis.com/auth/datastore", options)
        writes = []
        for r in rows:
            name = f"{root}/{options['collection']}/{'_'.join(str(r.fields[k]) for k in keys) if keys else uuid.uuid4().hex}"
            writes.append({"delete": name} if r.gone else {"update": {"name": name, "fields": {k: _firestore(v) for k, v in r.fields.items()}}})
        ask("POST", f"{host}/v1/{root}:commit", {"writes": writes}, {"Authorization": f"Bearer {token}"}, options)

    return Sink(500, send, keyed=True)
