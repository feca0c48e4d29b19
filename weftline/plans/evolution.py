"""Changes of a table's columns, and rows of older schemas brought forward."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class EvolutionError(ValueError):
    """A change that does not fit the table."""


@dataclass(frozen=True)
class Change:
    """`add` a column of a type, `drop` one, `rename` it `to` another name, `modify` its type to a wider one."""

    kind: str
    name: str
    to: str | None = None
    type: str | None = None

    @classmethod
    def of(cls, given: dict) -> Change:
        if given.get("kind") not in ("add", "drop", "rename", "modify"):
            raise EvolutionError(f"no change {given.get('kind')}")
        return cls(given["kind"], given["name"], given.get("to"), given.get("type"))

    def json(self) -> dict:
        return {k: v for k, v in asdict(self).items() if v is not None}


def data_type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {name}")[0].dataType


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new."""
    if old == new or isinstance(new, T.StringType):
        return True
    if isinstance(old, _WHOLE):
        digits = (3, 5, 10, 19)[_WHOLE.index(type(old))]
        if isinstance(new, _WHOLE):
            return _WHOLE.index(type(new)) > _WHOLE.index(type(old))
        return isinstance(new, T.DecimalType) and new.precision - new.scale >= digits or (isinstance(new, T.DoubleType) and digits <= 10)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)) or (isinstance(old, T.DateType) and isinstance(new, (T.TimestampType, T.TimestampNTZType)))


def schema_after(schema: T.StructType, changes: list[Change]) -> T.StructType:
    fields = list(schema.fields)
    for c in changes:
        at = next((i for i, f in enumerate(fields) if f.name == c.name), None)
        if c.kind == "add":
            if at is not None:
                raise EvolutionError(f"there is a column {c.name} already")
            fields.append(T.StructField(c.name, data_type(c.type)))
            continue
        if at is None:
            raise EvolutionError(f"no column {c.name}")
        if c.kind == "drop":
            del fields[at]
        elif c.kind == "rename":
            if any(f.name == c.to for f in fields):
                raise EvolutionError(f"there is a column {c.to} already")
            fields[at] = T.StructField(c.to, fields[at].dataType)
        else:
            new = data_type(c.type)
            if not wider(fields[at].dataType, new):
                raise EvolutionError(f"{c.name}: {fields[at].dataType.simpleString()} does not fit {c.type}")
            fields[at] = T.StructField(c.name, new)
    return T.StructType(fields)


def forward(df: DataFrame, changes: list[Change]) -> DataFrame:
    """Rows of an older schema as rows of the newer one: added columns are null; columns that the schema does not name stay."""
    for c in changes:
        if c.kind == "add":
            df = df.withColumn(c.name, F.lit(None).cast(data_type(c.type)))
        elif c.kind == "drop":
            df = df.drop(c.name)
        elif c.kind == "rename":
            df = df.withColumnRenamed(c.name, c.to)
        else:
            df = df.withColumn(c.name, F.col(f"`{c.name}`").cast(data_type(c.type)))
    return df


def between(old: T.StructType, new: T.StructType) -> list[Change]:
    """The changes that a new list of columns makes; by names, so a renamed column is dropped and added."""
    there = {f.name: f.dataType for f in new}
    was = {f.name: f.dataType for f in old}
    out = [Change("drop", n) for n in was if n not in there]
    out += [Change("modify", n, type=t.simpleString()) for n, t in there.items() if n in was and was[n] != t]
    return out + [Change("add", n, type=t.simpleString()) for n, t in there.items() if n not in was]
