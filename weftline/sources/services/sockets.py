"""Services over plain connections: a key-value store's protocol, message frames, lines of text."""

from __future__ import annotations

import json
import socket
import time
from collections.abc import Iterable
from urllib.parse import urlsplit

from weftline.sources.services.core import ServiceError, Sink, Source, filled, sink, source


def connected(host: str, port: int, tries: int = 3) -> socket.socket:
    for tried in range(tries + 1):
        try:
            return socket.create_connection((host, port), timeout=60)
        except OSError:
            if tried == tries:
                raise
            time.sleep(0.1 * 2**tried)
    raise AssertionError("unreachable")


class Redis:
    """The store's wire protocol: commands as arrays of strings, sent together, answered in order."""

    def __init__(self, options: dict, node: str | None = None):
        host, _, port = (node or f"{options.get('host')}:{options.get('port', 6379)}").rpartition(":")
        self.at = connected(host, int(port))
        self.file = self.at.makefile("rb")
        if options.get("auth"):
            self.run([["AUTH", *([options["user"]] if options.get("user") else []), options["auth"]]])
        if int(options.get("db_num") or 0):
            self.run([["SELECT", options["db_num"]]])

    def run(self, commands: Iterable[list]) -> list:
        commands = list(commands)
        out = b""
        for c in commands:
            parts = [str(x).encode() for x in c]
            out += b"*%d\r\n" % len(parts) + b"".join(b"$%d\r\n%s\r\n" % (len(p), p) for p in parts)
        self.at.sendall(out)
        return [self.answer() for _ in commands]

    def answer(self):
        line = self.file.readline().rstrip(b"\r\n")
        kind, rest = line[:1], line[1:]
        if kind == b"-":
            raise ServiceError(rest.decode())
        if kind == b"$":
            if int(rest) < 0:
                return None
            body = self.file.read(int(rest) + 2)
            return body[:-2].decode()
        if kind == b"*":
            return [self.answer() for _ in range(max(0, int(rest)))]
        return int(rest) if kind == b":" else rest.decode()

    def close(self) -> None:
        self.file.close()
        self.at.close()


def _redis_commands(options: dict, fields: dict, gone: bool) -> list[list]:
    """What a row is to the store: the key from a field or a template, the value of a field or the whole row."""
    custom = options.get("support_custom_key")
    key = filled(options["key"], fields) if custom else str(fields.get(options["key"], options["key"]))
    kind = str(options.get("data_type", "KEY")).upper()
    value = fields.get(options["value_field"]) if options.get("value_field") else json.dumps(fields, ensure_ascii=False)
    if gone:
        commands = [["DEL", key]]
        if kind == "HASH" and options.get("hash_key_field"):
            commands = [["HDEL", key, fields[options["hash_key_field"]]]]
        elif kind == "LIST":
            commands = [["LREM", key, 0, value]]
        elif kind in ("SET", "ZSET"):
            commands = [["SREM" if kind == "SET" else "ZREM", key, value]]
        return commands
    if kind == "HASH":
        if options.get("hash_key_field"):
            of = options.get("hash_value_field")
            commands = [["HSET", key, fields[options["hash_key_field"]], fields[of] if of else value]]
        else:
            commands = [["HSET", key, *[x for k, v in fields.items() if v is not None for x in (k, v)]]]
    else:
        commands = [{"KEY": ["SET", key, value], "STRING": ["SET", key, value], "LIST": ["LPUSH", key, value], "SET": ["SADD", key, value], "ZSET": ["ZADD", key, 1, value]}[kind]]
    if int(options.get("expire", -1)) > 0:
        commands.append(["EXPIRE", key, options["expire"]])
    return commands


@sink("Redis")
def redis(options: dict, values: dict) -> Sink:
    def send(rows, number):
        store = Redis(options, (options.get("nodes") or [None])[0] if options.get("mode") == "cluster" else None)
        try:
            store.run([c for r in rows for c in _redis_commands(options, r.fields, r.gone)])
        finally:
            store.close()

    return Sink(int(options.get("batch_size", 10)), send, keyed=True)


@source("Redis")
def from_redis(options: dict, schema) -> Source:
    """The values of all keys of a pattern, found by scanning; hashes as one record, or as one for each of their entries."""
    kind = str(options.get("data_type", "KEY")).upper()
    nodes = options.get("nodes") if options.get("mode") == "cluster" else None

    def parsed(text):
        if text is None:
            return None
        if schema is None or options.get("format", "json") != "json":
            return {schema.names[0] if schema is not None and len(schema) else "content": text}
        return json.loads(text)

    def fetch(part):
        store, cursor, seen = Redis(options, part), "0", set()
        try:
            while True:
                cursor, names = store.run([["SCAN", cursor, "MATCH", options["keys"], "COUNT", options.get("batch_size", 10)]])[0]
                names = [n for n in names if n not in seen]  # a scan may give a key twice
                seen.update(names)
                read = {"KEY": ["GET"], "STRING": ["GET"], "HASH": ["HGETALL"], "LIST": ["LRANGE"], "SET": ["SMEMBERS"], "ZSET": ["ZRANGE"]}[kind]
                found = store.run([[*read, n, *(["0", "-1"] if kind in ("LIST", "ZSET") else [])] for n in names])
                for n, got in zip(names, found, strict=True):
                    if kind == "HASH":
                        pairs = dict(zip(got[::2], got[1::2], strict=True))
                        if options.get("hash_key_parse_mode") == "kv":
                            yield from ({"hash_key": k, **parsed(v)} for k, v in pairs.items())
                        else:
                            yield pairs
                    else:
                        yield from (x for x in map(parsed, got if isinstance(got, list) else [got]) if x is not None)
                if str(cursor) == "0":
                    return
        finally:
            store.close()

    return Source(list(nodes or [None]), fetch)


@sink("Socket")
def lines_to(options: dict, values: dict) -> Sink:
    """A row a line, as JSON."""

    def send(rows, number):
        with connected(options["host"], int(options["port"]), int(options.get("max_retries", 3))) as s:
            s.sendall("".join(json.dumps(r.fields, ensure_ascii=False) + "\n" for r in rows).encode())

    return Sink(int(options.get("batch_size", 1000)), send)


@source("Socket")
def lines_from(options: dict, schema) -> Source:
    """The lines of a connection, until it is closed."""
    name = schema.names[0] if schema is not None else "value"

    def fetch(part):
        with connected(options["host"], int(options["port"])) as s, s.makefile("r", encoding="utf-8") as f:
            yield from ({name: line.rstrip("\r\n")} for line in f)

    return Source([0], fetch)


def _frame(command: str, headers: dict, body: str = "") -> bytes:
    return "\n".join([command, *(f"{k}:{v}" for k, v in headers.items()), "", body]).encode() + b"\x00"


@sink("Activemq")
def activemq(options: dict, values: dict) -> Sink:
    """A message a row in text frames; a receipt for the last one says that all have arrived."""
    at = urlsplit(options.get("uri") or f"tcp://{options.get('host')}:{options.get('port')}")
    port = int(options.get("stomp_port") or (61613 if at.port in (None, 61616) else at.port))

    def send(rows, number):
        with connected(at.hostname, port) as s, s.makefile("rb") as f:

            def answer() -> str:
                text = bytearray()
                while (c := f.read(1)) not in (b"\x00", b""):
                    text += c
                return text.decode().lstrip("\n")

            login = {"login": options["username"], "passcode": options.get("password", "")} if options.get("username") else {}
            s.sendall(_frame("CONNECT", {"accept-version": "1.2", "host": options.get("virtual_host") or at.hostname, **login}))
            if not (said := answer()).startswith("CONNECTED"):
                raise ServiceError(said[:300])
            for i, r in enumerate(rows):
                last = {"receipt": "last"} if i == len(rows) - 1 else {}
                s.sendall(_frame("SEND", {"destination": f"/queue/{options['queue_name']}", "content-type": "application/json", **last}, json.dumps(r.fields, ensure_ascii=False)))
            if not (said := answer()).startswith("RECEIPT"):
                raise ServiceError(said[:300])

    return Sink(int(options.get("batch_size", 1000)), send)
