"""Sinks: files with save modes, placeholders in names, the Assert sink."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.keys import keys, primary_key
from weftline.plans.sql import HIDDEN
from weftline.plans.types import parse_type


class AssertFailed(AssertionError):
    """Data that breaks a rule of the Assert sink."""


class SaveModeError(RuntimeError):
    """A target that the chosen mode does not allow."""


def placeholders(text: str, values: dict[str, str]) -> str:
    """${name} and ${name:default}; a name without a value or a default stays as it is."""
    return re.sub(r"\$\{(\w+)(?::([^}]*))?\}", lambda m: values.get(m[1]) or (m[2] if m[2] is not None else m[0]), text)


def table_values(path: str, df: DataFrame, primary_key: tuple[str, ...] = (), unique_key: tuple[str, ...] = ()) -> dict[str, str]:
    parts = path.split(".")
    return {"database_name": parts[0] if len(parts) > 1 else "", "schema_name": parts[1] if len(parts) > 2 else "", "schema_full_name": ".".join(parts[:-1]), "table_name": parts[-1], "table_full_name": path, "primary_key": ",".join(primary_key), "unique_key": ",".join(unique_key), "field_names": ",".join(c for c in df.columns if c not in HIDDEN)}


def save_table(df: DataFrame, table: str, schema_save_mode: str = "CREATE_SCHEMA_WHEN_NOT_EXIST", data_save_mode: str = "APPEND_DATA", custom_sql: str | None = None, format: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a catalog table: first the schema mode, then the data mode; a table just made is not emptied again."""
    spark = df.sparkSession
    df = df.drop(*HIDDEN)
    there = spark.catalog.tableExists(table)
    if schema_save_mode == "IGNORE" and not there:
        raise SaveModeError(f"{table} does not exist, and schema_save_mode is IGNORE")
    if schema_save_mode == "ERROR_WHEN_SCHEMA_NOT_EXIST" and not there:
        raise SaveModeError(f"{table} does not exist")
    if schema_save_mode == "RECREATE_SCHEMA" and there:
        spark.sql(f"DROP TABLE {table}")
        there = False
    mode = "append"
    if there and data_save_mode == "DROP_DATA":
        mode = "overwrite"
    elif there and data_save_mode == "ERROR_WHEN_DATA_EXISTS" and not spark.table(table).isEmpty():
        raise SaveModeError(f"{table} has rows")
    elif data_save_mode == "CUSTOM_PROCESSING" and custom_sql and there:
        spark.sql(custom_sql)
    writer = df.write.mode(mode).format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def save_files(df: DataFrame, path: str, file_format_type: str = "parquet", partition_by: list[str] | None = None, sink_columns: list[str] | None = None, mode: str = "append", single_file_mode: bool = False, **options) -> None:
    """Files in a folder, committed by rename; `options` go to Spark's writer."""
    df = df.drop(*HIDDEN)
    if sink_columns:
        df = df.select(*sink_columns)
    if single_file_mode:
        df = df.coalesce(1)
    if file_format_type == "text":
        df = df.select(F.concat_ws(options.pop("field_delimiter", "\x01"), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]).alias("value"))
    writer = df.write.format(file_format_type).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def name_files(spark: SparkSession, path: str, expression: str, time_format: str, transaction: str) -> list[str]:
    """Renames the part files of a folder by an expression of ${uuid}, ${now} and ${transactionId}; several get a number."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    now = jvm.java.time.LocalDateTime.now().format(jvm.java.time.format.DateTimeFormatter.ofPattern(time_format))
    name = placeholders(expression, {"uuid": uuid.uuid4().hex, "now": now, "transactionId": transaction})
    parts = sorted(f.getPath().getName() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-"))
    out = []
    for i, part in enumerate(parts):
        ending = part.partition(".")[2]
        out.append(f"{name}{f'_{i}' if len(parts) > 1 else ''}.{ending}")
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(at, part), jvm.org.apache.hadoop.fs.Path(at, out[-1])):
            raise OSError(f"cannot rename {part}")
    return out


def _literal(value, to: T.DataType):
    """A rule's value as a column of a type; arrays, maps and rows are given as in a job file."""
    if isinstance(to, (T.ArrayType, T.MapType, T.StructType)) and value is not None:
        return F.from_json(F.lit(value if isinstance(value, str) else json.dumps(value)), to)
    return F.lit(value).cast(to)


def _bad(c, kind: str, value, to: T.DataType):
    """Whether a value breaks a rule."""
    if kind in ("NOT_NULL", "NULL"):
        return c.isNull() if kind == "NOT_NULL" else c.isNotNull()
    if kind in ("MIN", "MAX"):
        return c < value if kind == "MIN" else c > value
    if kind in ("MIN_LENGTH", "MAX_LENGTH"):
        return F.length(c) < value if kind == "MIN_LENGTH" else F.length(c) > value
    if kind == "EQUALS":
        if isinstance(to, T.MapType):  # maps are equal if their entries are
            sort = lambda m: F.array_sort(F.map_entries(m))
            return ~sort(c).eqNullSafe(sort(_literal(value, to)))
        return ~c.eqNullSafe(_literal(value, to))
    raise AssertFailed(f"unknown rule {kind}")


def _catalog_faults(df: DataFrame, rule: dict) -> list[str]:
    """Where a table's columns and keys are not those of a catalog_table_rule."""
    out = []
    if want := rule.get("primary_key_rule"):
        if list(want["primary_key_columns"]) != primary_key(df):
            out.append(f"the primary key is {primary_key(df)}, not {list(want['primary_key_columns'])}")
    found = keys(df)
    for want in rule.get("constraint_key_rule") or []:
        columns = [c["constraint_key_column_name"] for c in want["constraint_key_columns"]]
        if found.get(want["constraint_key_name"]) != columns:
            out.append(f"the key {want['constraint_key_name']} is {found.get(want['constraint_key_name'])}, not {columns}")
    fields = {f.name: f for f in df.schema if f.name not in HIDDEN}
    wanted = rule.get("column_rule") or []
    if wanted and [w["name"] for w in wanted] != list(fields):
        out.append(f"the columns are {list(fields)}, not {[w['name'] for w in wanted]}")
    for w in wanted:
        f = fields.get(w["name"])
        if f is not None and w.get("type") and parse_type(w["type"]) != f.dataType:
            out.append(f"{f.name} is {f.dataType.simpleString()}, not {w['type']}")
        if f is not None and w.get("nullable") is False and f.nullable:
            out.append(f"{f.name} may be null")
    return out


def assert_sink(df: DataFrame, row_rules: list[dict] | None = None, field_rules: list[dict] | None = None, catalog_table_rule: dict | None = None, table_names: list[str] | None = None, path: str = "") -> dict[str, int]:
    """All rules in one aggregation; raises with the first that fails, else gives the counts."""
    if table_names and path not in table_names:
        raise AssertFailed(f"table {path} is not one of {', '.join(table_names)}")
    for fault in _catalog_faults(df, catalog_table_rule or {}):
        raise AssertFailed(fault)
    checks: dict[str, Column] = {}
    for f in field_rules or []:
        name = f["field_name"]
        if name not in df.columns:
            raise AssertFailed(f"no field {name}")
        to = df.schema[name].dataType
        if f.get("field_type") and not isinstance(f["field_type"], dict) and parse_type(f["field_type"]) != to:
            raise AssertFailed(f"{name} is {to.simpleString()}, not {f['field_type']}")
        for r in f.get("field_value") or []:
            kind = r.get("rule_type") or "EQUALS"
            value = r.get("rule_value", r.get("equals_to"))
            checks[f"{name} {kind} {value}"] = F.count_if(_bad(F.col(f"`{name}`"), kind, value, to))
            if r.get("rule_type") and "equals_to" in r:
                checks[f"{name} EQUALS {r['equals_to']}"] = F.count_if(_bad(F.col(f"`{name}`"), "EQUALS", r["equals_to"], to))
    got = df.agg(F.count("*").alias("_rows"), *[c.alias(f"c{i}") for i, c in enumerate(checks.values())]).first()
    for i, name in enumerate(checks):
        if got[i + 1]:
            raise AssertFailed(f"{got[i + 1]} rows break {name}")
    for r in row_rules or []:
        low = r["rule_type"] == "MIN_ROW"
        if (got[0] < r["rule_value"]) if low else (got[0] > r["rule_value"]):
            raise AssertFailed(f"{got[0]} rows break {r['rule_type']} {r['rule_value']}")
    return {"rows": got[0]}


def union(frames: list[DataFrame]) -> DataFrame:
    """What a sink with several inputs reads: all rows, one after the other."""
    return reduce(lambda a, b: a.unionByName(b), frames)
