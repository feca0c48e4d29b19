"""Protocol buffers: messages read and written by the text of their definition.

The definition (proto3: messages, nested messages, enums, repeated fields and
maps) is parsed on the driver; executors read and write the wire format in
Arrow batches.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


class ProtoError(ValueError):
    """A definition that cannot be read, or bytes that are no message of it."""


#: Wire type of each scalar type.
_WIRE = {**dict.fromkeys(("int32", "int64", "uint32", "uint64", "sint32", "sint64", "bool"), 0), **dict.fromkeys(("fixed64", "sfixed64", "double"), 1), **dict.fromkeys(("string", "bytes"), 2), **dict.fromkeys(("fixed32", "sfixed32", "float"), 5)}
_PACK = {"fixed64": "<Q", "sfixed64": "<q", "double": "<d", "fixed32": "<I", "sfixed32": "<i", "float": "<f"}
_ZERO = {"string": "", "bytes": b"", "bool": False, "double": 0.0, "float": 0.0}


@dataclass
class Field:
    name: str
    kind: str
    repeated: bool = False
    key: str | None = None  # of a map


@dataclass
class Message:
    name: str
    fields: dict[int, Field] = field(default_factory=dict)


@dataclass
class Definition:
    messages: dict[str, Message]
    enums: dict[str, dict[int, str]]

    def find(self, name: str, within: str, kinds: dict):
        """A type by its name as seen from a message: its own ones first, then outwards."""
        parts = within.split(".")
        for i in range(len(parts), -1, -1):
            full = ".".join([*parts[:i], name.lstrip(".")])
            if full in kinds:
                return full
        return None


def parse(text: str) -> Definition:
    tokens = re.findall(r'"(?:[^"\\]|\\.)*"|[A-Za-z_.][\w.]*|-?\d\w*|[{}=;<>,\[\]()]', re.sub(r"//[^\n]*|/\*.*?\*/", " ", text, flags=re.S))
    out, at = Definition({}, {}), 0

    def need(token: str) -> None:
        nonlocal at
        if at >= len(tokens) or tokens[at] != token:
            raise ProtoError(f"expected {token}, found {tokens[at] if at < len(tokens) else 'the end'}")
        at += 1

    def skip() -> None:
        """To the end of a statement or its block."""
        nonlocal at
        depth = 0
        while at < len(tokens):
            t, at = tokens[at], at + 1
            depth += (t == "{") - (t == "}")
            if depth == 0 and t in (";", "}"):
                return

    def enum(within: str) -> None:
        nonlocal at
        name = f"{within}.{tokens[at]}".lstrip(".")
        at += 1
        need("{")
        values: dict[int, str] = {}
        while tokens[at] != "}":
            if tokens[at] in ("option", "reserved"):
                skip()
                continue
            label = tokens[at]
            at += 1
            need("=")
            values[int(tokens[at], 0)] = label
            skip()
        need("}")
        out.enums[name] = values

    def message(within: str) -> None:
        nonlocal at
        name = f"{within}.{tokens[at]}".lstrip(".")
        at += 1
        need("{")
        made = out.messages.setdefault(name, Message(name))
        while tokens[at] != "}":
            word = tokens[at]
            if word == "message":
                at += 1
                message(name)
            elif word == "enum":
                at += 1
                enum(name)
            elif word == "oneof":
                at += 2
                need("{")
                while tokens[at] != "}":
                    one(made)
                need("}")
            elif word in ("option", "reserved", "extensions", "extend"):
                skip()
            else:
                one(made)
        need("}")

    def one(made: Message) -> None:
        nonlocal at
        repeated = tokens[at] == "repeated"
        at += tokens[at] in ("repeated", "optional", "required")
        key = None
        kind = tokens[at]
        at += 1
        if kind == "map":
            need("<")
            key = tokens[at]
            at += 1
            need(",")
            kind = tokens[at]
            at += 1
            need(">")
        name = tokens[at]
        at += 1
        need("=")
        made.fields[int(tokens[at], 0)] = Field(name, kind, repeated, key)
        skip()

    package = ""
    while at < len(tokens):
        word = tokens[at]
        at += 1
        if word == "message":
            message(package)
        elif word == "enum":
            enum(package)
        elif word == "package":
            package = tokens[at]
            skip()
        elif word != ";":
            skip()
    return out


def _varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        if at >= len(data):
            raise ProtoError("a number that does not end")
        c = data[at]
        at += 1
        n |= (c & 127) << shift
        if c < 128:
            return n, at
        shift += 7


def _signed(n: int, kind: str):
    if kind == "bool":
        return bool(n)
    if kind.startswith("sint"):
        return (n >> 1) ^ -(n & 1)
    return n - (1 << 64) if kind in ("int32", "int64") and n >= 1 << 63 else n


def read_message(data: bytes, name: str, of: Definition) -> dict:
    """A message as a dict; fields that are not there have their type's zero, messages null."""
    about = of.messages[name]
    out: dict = {}
    for f in about.fields.values():
        if f.key:
            out[f.name] = []
        elif f.repeated:
            out[f.name] = []
        elif f.kind in _WIRE:
            out[f.name] = _ZERO.get(f.kind, 0)
        elif enum := of.find(f.kind, name, of.enums):
            out[f.name] = of.enums[enum].get(0)
        else:
            out[f.name] = None
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire, f = tag & 7, about.fields.get(tag >> 3)
        if wire == 0:
            raw, at = _varint(data, at)
        elif wire == 2:
            size, at = _varint(data, at)
            raw, at = data[at : at + size], at + size
            if at > len(data):
                raise ProtoError("a field longer than the message")
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            raw, at = data[at : at + size], at + size
        else:
            raise ProtoError(f"wire type {wire}")
        if f is None:
            continue
        if f.key:
            entry = Definition({"e": Message("e", {1: Field("key", f.key), 2: Field("value", _full(f.kind, name, of))}), **of.messages}, of.enums)
            pair = read_message(raw, "e", entry)
            out[f.name].append((pair["key"], pair["value"]))
        elif f.repeated and wire == 2 and f.kind not in ("string", "bytes") and of.find(f.kind, name, of.messages) is None:
            out[f.name] += _packed(raw, f.kind, name, of)
        elif f.repeated:
            out[f.name].append(_value(raw, f.kind, name, of))
        else:
            out[f.name] = _value(raw, f.kind, name, of)
    return out


def _full(kind: str, within: str, of: Definition) -> str:
    return kind if kind in _WIRE else of.find(kind, within, of.messages) or of.find(kind, within, of.enums) or kind


def _value(raw, kind: str, within: str, of: Definition):
    if kind in _PACK:
        return struct.unpack(_PACK[kind], raw)[0]
    if kind in ("string", "bytes"):
        return raw.decode() if kind == "string" else raw
    if kind in _WIRE:
        return _signed(raw, kind)
    if enum := of.find(kind, within, of.enums):
        return of.enums[enum].get(raw, str(raw))
    if inner := of.find(kind, within, of.messages):
        return read_message(raw, inner, of)
    raise ProtoError(f"unknown type {kind}")


def _packed(raw: bytes, kind: str, within: str, of: Definition) -> list:
    if kind in _PACK:
        size = struct.calcsize(_PACK[kind])
        return [struct.unpack_from(_PACK[kind], raw, i)[0] for i in range(0, len(raw), size)]
    out, at = [], 0
    while at < len(raw):
        n, at = _varint(raw, at)
        out.append(_value(n, kind, within, of))
    return out


def _number(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _written(value, kind: str, within: str, of: Definition) -> tuple[int, bytes]:
    """(wire type, bytes) of a value."""
    if kind in _PACK:
        return _WIRE[kind], struct.pack(_PACK[kind], value)
    if kind in _WIRE and _WIRE[kind] == 0:
        n = int(value)
        return 0, _number((n << 1) ^ (n >> 63) if kind.startswith("sint") else n)
    if kind in _WIRE:
        body = value.encode() if isinstance(value, str) else bytes(value)
    elif enum := of.find(kind, within, of.enums):
        return 0, _number(next((n for n, label in of.enums[enum].items() if label == value), 0))
    elif inner := of.find(kind, within, of.messages):
        body = write_message(value, inner, of)
    else:
        raise ProtoError(f"unknown type {kind}")
    return 2, _number(len(body)) + body


def write_message(row: dict, name: str, of: Definition) -> bytes:
    """The bytes of a message; nulls are left out."""
    out = b""
    for number, f in sorted(of.messages[name].fields.items()):
        value = row.get(f.name)
        if value is None:
            continue
        if f.key:
            for k, v in value.items() if isinstance(value, dict) else value:
                (wk, bk), (wv, bv) = _written(k, f.key, name, of), _written(v, f.kind, name, of)
                body = _number(8 | wk) + bk + _number(16 | wv) + bv
                out += _number(number << 3 | 2) + _number(len(body)) + body
            continue
        for v in value if f.repeated else [value]:
            wire, body = _written(v, f.kind, name, of)
            out += _number(number << 3 | wire) + body
    return out


def decode(df: DataFrame, schema: T.StructType, text: str, message: str, ignore_parse_errors: bool = False) -> DataFrame:
    """Rows of a binary column `value`; fields are matched by name, null values give none."""
    of = parse(text)
    name = message if message in of.messages else of.find(message, "", of.messages) or next((m for m in of.messages if m.endswith(f".{message}")), None)
    if name is None:
        raise ProtoError(f"no message {message}; there are {sorted(of.messages)}")
    arrow, names = to_arrow_schema(schema), schema.names

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = []
            for value in b.column(0).to_pylist():
                if value is None:
                    continue
                try:
                    got = read_message(value, name, of)
                except (ProtoError, struct.error, UnicodeDecodeError) as e:
                    if not ignore_parse_errors:
                        raise ProtoError(f"malformed message: {e}") from e
                    continue
                rows.append({n: got.get(n) for n in names})
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return df.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, schema)


def encode(df: DataFrame, text: str, message: str) -> DataFrame:
    """A binary column `value` of the rows as messages."""
    of = parse(text)
    name = message if message in of.messages else next((m for m in of.messages if m.endswith(f".{message}")), None)
    if name is None:
        raise ProtoError(f"no message {message}")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([write_message(r, name, of) for r in b.to_pylist(maps_as_pydicts="lossy")], pa.binary())], ["value"])

    return df.mapInArrow(run, "value binary")
