"""Column and row transforms: each takes a DataFrame and options and gives a DataFrame.

All are single projections or filters over built-in expressions, so Catalyst
fuses a chain of them into one stage and prunes what they drop at the scan.
Hidden columns (`_table`, `_row_kind`, `_options`) ride along.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.sql import HIDDEN
from weftline.plans.types import parse_type

ROW_KINDS = {"+I": "INSERT", "-U": "UPDATE_BEFORE", "+U": "UPDATE_AFTER", "-D": "DELETE"}


class TransformError(ValueError):
    """Options that do not fit the input."""


def _hidden(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in HIDDEN if c in df.columns]


def _col(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        raise TransformError(f"no field {name} in {df.columns}")
    return F.col(f"`{name}`")


def _one_of(a, b, names: str):
    if (a is None) == (b is None):
        raise TransformError(f"exactly one of {names} is needed")


def field_mapper(df: DataFrame, field_mapper: dict[str, str]) -> DataFrame:
    """Keep, reorder and rename; other fields go."""
    return df.select(*[_col(df, a).alias(b) for a, b in field_mapper.items()], *_hidden(df))


def filter_fields(df: DataFrame, include_fields: list[str] | None = None, exclude_fields: list[str] | None = None) -> DataFrame:
    _one_of(include_fields, exclude_fields, "include_fields and exclude_fields")
    for name in include_fields or exclude_fields or []:
        _col(df, name)
    if include_fields is not None:
        return df.select(*[_col(df, c) for c in include_fields], *_hidden(df))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in exclude_fields])


def filter_row_kind(df: DataFrame, include_kinds: list[str] | None = None, exclude_kinds: list[str] | None = None) -> DataFrame:
    _one_of(include_kinds, exclude_kinds, "include_kinds and exclude_kinds")
    names = {v: k for k, v in ROW_KINDS.items()}
    kinds = [names.get(k, k) for k in include_kinds or exclude_kinds]
    test = F.col("_row_kind").isin(kinds)
    return df.filter(test if include_kinds is not None else ~test)


def row_kind_extractor(df: DataFrame, custom_field_name: str = "row_kind", transform_type: str = "SHORT") -> DataFrame:
    """Append the kind as a column; every row becomes an insert."""
    kind = F.col("_row_kind")
    if transform_type.upper() == "FULL":
        full = F.lit(None).cast("string")
        for k, v in ROW_KINDS.items():
            full = F.when(kind == k, v).otherwise(full)
        kind = full
    return df.withColumn(custom_field_name, kind).withColumn("_row_kind", F.lit("+I"))


def replace(df: DataFrame, replace_field: str, pattern: str, replacement: str, is_regex: bool = False, replace_first: bool = False) -> DataFrame:
    """Literal or regular-expression replacement in one field; null stays null."""
    c = _col(df, replace_field)
    if not is_regex:
        out = F.replace(c, F.lit(pattern), F.lit(replacement))
    elif not replace_first:
        out = F.regexp_replace(c, pattern, replacement)
    else:  # one more group stands before the pattern's own
        shifted = re.sub(r"(?<!\\)\$(\d+)", lambda m: f"${int(m[1]) + 1}", replacement)
        flags = re.match(r"\(\?[a-z]+\)", pattern)
        rest = pattern[flags.end() :] if flags else pattern
        inner = f"{flags[0][:-1]}:{rest})" if flags else rest
        # Text after the first match is taken up by the last group and put back.
        groups = re.compile(pattern).groups
        out = F.regexp_replace(c, f"^((?s:.*?))(?:{inner})((?s:.*))$", f"$1{shifted}${groups + 2}")
    return df.withColumn(replace_field, out)


def split(df: DataFrame, separator: str, split_field: str, output_fields: list[str]) -> DataFrame:
    """Regular-expression split into new string fields; missing parts are null, the last holds the rest."""
    parts = F.split(_col(df, split_field), separator, len(output_fields))
    return df.withColumns({name: F.try_element_at(parts, F.lit(i + 1)) for i, name in enumerate(output_fields)})


def copy(df: DataFrame, fields: dict[str, str] | None = None, src_field: str | None = None, dest_field: str | None = None) -> DataFrame:
    """Duplicate fields under new names: {new: old}."""
    pairs = dict(fields or {}) or {dest_field: src_field}
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *[_col(df, old).alias(new, metadata=df.schema[old].metadata) for new, old in pairs.items()])


def json_path(df: DataFrame, columns: list[dict], row_error_handle_way: str = "FAIL") -> DataFrame:
    """Values at JSON paths as typed fields.

    An error is a text that is no JSON, a path that is absent or a value that
    does not cast.  A column's policy (FAIL, SKIP: null, SKIP_ROW: the row
    goes) beats the row's (FAIL, SKIP: the row goes).
    """
    drop = F.lit(False)
    made: dict[str, Column] = {}
    for c in columns:
        src = _col(df, c["src_field"])
        to = parse_type(c.get("dest_type", "string"))
        if isinstance(df.schema[c["src_field"]].dataType, T.StringType):
            text = src
        else:
            text = F.to_json(src)
        found = F.get_json_object(text, c["path"])
        nested = isinstance(to, (T.ArrayType, T.MapType, T.StructType))
        value = F.from_json(found, to) if nested else found.try_cast(to)
        bad = src.isNotNull() & value.isNull()
        way = c.get("column_error_handle_way") or {"FAIL": "FAIL", "SKIP": "SKIP_ROW"}[row_error_handle_way]
        if way == "FAIL":
            value = F.when(bad, F.raise_error(F.concat(F.lit(f"JsonPath {c['path']} fails on: "), text))).otherwise(value)
        elif way == "SKIP_ROW":
            drop = drop | bad
        made[c["dest_field"]] = value
    return df.filter(~drop).withColumns(made)


def _renamer(convert_case: str | None, prefix: str, suffix: str, replacements: list[dict], regex: bool | None = None) -> Callable[[str], str]:
    """Replacements first, then prefix and suffix, then case."""

    def rename(name: str) -> str:
        for r in replacements or []:
            is_regex = r.get("is_regex", True) if regex is None else regex
            name = re.sub(r["replace_from"], re.sub(r"\$(\d+)", r"\\\1", r["replace_to"]), name) if is_regex else name.replace(r["replace_from"], r["replace_to"])
        name = f"{prefix or ''}{name}{suffix or ''}"
        return {"UPPER": name.upper(), "LOWER": name.lower()}.get((convert_case or "").upper(), name)

    return rename


def field_rename(df: DataFrame, convert_case: str | None = None, prefix: str = "", suffix: str = "", replacements_with_regex: list[dict] | None = None, specific: list[dict] | None = None) -> DataFrame:
    rename = _renamer(convert_case, prefix, suffix, replacements_with_regex or [])
    own = {s["field_name"]: s["target_name"] for s in specific or []}
    names = [c if c in HIDDEN else own.get(c) or rename(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise TransformError(f"names clash after renaming: {names}")
    return df.toDF(*names)


Tables = dict[str, DataFrame]


def table_rename(tables: Tables, convert_case: str | None = None, prefix: str = "", suffix: str = "", replacements_with_regex: list[dict] | None = None) -> Tables:
    rename = _renamer(convert_case, prefix, suffix, replacements_with_regex or [], regex=True)
    return {".".join([*path.split(".")[:-1], rename(path.split(".")[-1])]): df for path, df in tables.items()}


def table_merge(tables: Tables, table: str, database: str | None = None, schema: str | None = None, table_match_regex: str = ".*") -> Tables:
    """All matched tables become one; rows are never deduplicated."""
    matched = [p for p in tables if re.fullmatch(table_match_regex, p)]
    out = {p: d for p, d in tables.items() if p not in matched}
    if matched:
        merged = tables[matched[0]]
        for p in matched[1:]:
            merged = merged.unionByName(tables[p])
        out[".".join(x for x in (database, schema, table) if x)] = merged
    return out


def route(tables: Tables, transform: Callable[..., DataFrame], options: dict, table_match_regex: str = ".*", table_transform: list[dict] | None = None) -> Tables:
    """Apply a transform table by table; a table's own options beat the pattern, and the rest pass through."""
    own = {t["table_path"]: {k: v for k, v in t.items() if k != "table_path"} for t in table_transform or []}
    out = {}
    for path, df in tables.items():
        if path in own:
            out[path] = transform(df, **own[path])
        elif re.fullmatch(table_match_regex, path):
            out[path] = transform(df, **options)
        else:
            out[path] = df
    return out


def metadata(df: DataFrame, metadata_fields: dict[str, str]) -> DataFrame:
    """Expose Database, Table, RowKind, EventTime, Delay and Partition as fields."""
    parts = F.split("_table", r"\.")
    options = "_options" in df.columns
    known = {"Database": F.try_element_at(parts, F.lit(1)), "Table": F.element_at(parts, -1), "RowKind": F.col("_row_kind") if "_row_kind" in df.columns else F.lit("+I")}
    for key, kind in (("EventTime", "bigint"), ("Delay", "bigint"), ("Partition", "string")):
        known[key] = (F.try_element_at("_options", F.lit(key)) if options else F.lit(None)).cast(kind)
    for key in metadata_fields:
        if key not in known:
            raise TransformError(f"unknown metadata {key}")
    return df.withColumns({out: known[key] for key, out in metadata_fields.items()})


def dynamic_compile(df: DataFrame, output_columns: dict[str, str], values: Callable) -> DataFrame:
    """New fields from user code: `values` maps a pandas frame to a frame of the new fields; runs in Arrow batches."""
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, parse_type(t)) for n, t in output_columns.items()]])

    def run(frames):
        for frame in frames:
            yield frame.assign(**{n: v for n, v in values(frame)[list(output_columns)].items()})

    return df.mapInPandas(run, schema)


def llm(df: DataFrame, prompt: str, client: Callable[[list[str]], list[str]], inference_columns: list[str] | None = None, output_column_name: str = "llm_output", output_data_type: str = "STRING") -> DataFrame:
    """One prompt a row to a model client, by batches; the client is injected, so nothing here needs a network."""
    if output_column_name in df.columns:
        raise TransformError(f"the field {output_column_name} is there already")
    names = inference_columns or [c for c in df.columns if c not in HIDDEN]
    to = parse_type(output_data_type)
    sent = F.to_json(F.struct(*[_col(df, c) for c in names]))

    @F.pandas_udf("string")
    def ask(rows):
        import pandas as pd

        return pd.Series(client([f"{prompt}\n{r}" for r in rows]), index=rows.index)

    return df.withColumn(output_column_name, ask(sent).try_cast(to))


def embedding(df: DataFrame, vectorization_fields: dict[str, str], client: Callable[[list[str]], list[list[float]]], single_vectorized_input_number: int = 64) -> DataFrame:
    """Vectors of text fields, {vector field: text field}, by batches of the given size."""

    @F.pandas_udf("array<float>")
    def vectors(texts):
        import pandas as pd

        out: list[list[float]] = []
        rows = texts.fillna("").tolist()
        for i in range(0, len(rows), single_vectorized_input_number):
            out += client(rows[i : i + single_vectorized_input_number])
        return pd.Series(out, index=texts.index)

    return df.withColumns({out: vectors(_col(df, name)) for out, name in vectorization_fields.items()})
