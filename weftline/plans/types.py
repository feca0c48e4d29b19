"""Type rules of the SQL transform, on Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, BOOLEAN = T.StringType(), T.BooleanType()
BYTE, SHORT, INT, LONG = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
FLOAT, DOUBLE = T.FloatType(), T.DoubleType()
BINARY, DATE, TIMESTAMP, VOID = T.BinaryType(), T.DateType(), T.TimestampNTZType(), T.NullType()

#: Numbers from the narrowest to the widest.
_WIDTH = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class SqlError(ValueError):
    """A query that the transform does not take."""


def rank(t: T.DataType) -> int:
    name = "decimal" if isinstance(t, T.DecimalType) else t.simpleString()
    return _WIDTH.index(name) if name in _WIDTH else -1


def numeric(t: T.DataType) -> bool:
    return rank(t) >= 0


def integral(t: T.DataType) -> bool:
    return 0 <= rank(t) <= 3


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that branches of CASE share."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return T.DecimalType(max(a.precision, b.precision), max(a.scale, b.scale))
    if numeric(a) and numeric(b):
        return max(a, b, key=rank)
    if isinstance(a, T.StringType) and isinstance(b, T.StringType):
        return a
    raise SqlError(f"types {a.simpleString()} and {b.simpleString()} have no common type")


def arithmetic(a: T.DataType, b: T.DataType) -> T.DataType:
    """INT for narrow integers, BIGINT with a BIGINT, decimals by their larger precision and scale, else DOUBLE."""
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if not (numeric(a) and numeric(b)):
        raise SqlError(f"no arithmetic on {a.simpleString()} and {b.simpleString()}")
    if integral(a) and integral(b):
        return LONG if LONG in (a, b) else INT
    decimals = [t for t in (a, b) if isinstance(t, T.DecimalType)]
    if decimals:
        return T.DecimalType(max(t.precision for t in decimals), max(t.scale for t in decimals))
    return DOUBLE


def parse_type(text: str) -> T.DataType:
    """A type by its name, such as decimal(10, 2), array<int> or map<string, bigint>."""
    t = text.strip()
    low = t.lower()
    plain = {"string": STRING, "varchar": STRING, "boolean": BOOLEAN, "tinyint": BYTE, "byte": BYTE, "smallint": SHORT, "int": INT, "integer": INT, "bigint": LONG, "long": LONG, "float": FLOAT, "double": DOUBLE, "bytes": BINARY, "binary": BINARY, "date": DATE, "timestamp": TIMESTAMP, "datetime": TIMESTAMP, "null": VOID, "void": VOID, "float_vector": T.ArrayType(FLOAT)}
    if low in plain:
        return plain[low]
    if low == "time":
        return T.TimeType()
    if low.startswith("decimal"):
        p, s = (int(x) for x in t[t.index("(") + 1 : t.rindex(")")].split(","))
        return T.DecimalType(min(p, 38), s)
    if low.startswith("array<"):
        return T.ArrayType(parse_type(t[6:-1]))
    if low.startswith("map<"):
        depth, inner = 0, t[4:-1]
        for i, c in enumerate(inner):
            depth += (c in "<(") - (c in ">)")
            if c == "," and not depth:
                return T.MapType(parse_type(inner[:i]), parse_type(inner[i + 1 :]))
    raise SqlError(f"unknown type {text}")
