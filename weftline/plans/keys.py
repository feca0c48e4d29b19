"""Keys of tables, carried in the metadata of their columns.

A key column says its place in the key and how many columns the key has, so a
key lives through selections and renames as long as all its columns do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIMARY = "primary_key"


def with_key(df: DataFrame, columns: list[str], name: str = PRIMARY) -> DataFrame:
    """`df` whose columns say that they are its key of this name."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} for the key {name}")
    return df.withColumns({c: F.col(f"`{c}`").alias(c, metadata={**df.schema[c].metadata, f"key.{name}": [i, len(columns)]}) for i, c in enumerate(columns)})


def keys(df: DataFrame) -> dict[str, list[str]]:
    """The whole keys of a table by name, columns in order; a key that lost a column is none."""
    found: dict[str, dict[int, str]] = {}
    size: dict[str, int] = {}
    for f in df.schema:
        for k, v in f.metadata.items():
            if k.startswith("key."):
                name = k[4:]
                found.setdefault(name, {}).setdefault(v[0], f.name)
                size[name] = v[1]
    return {n: [c[i] for i in range(size[n])] for n, c in found.items() if len(c) == size[n]}


def primary_key(df: DataFrame) -> list[str]:
    return keys(df).get(PRIMARY, [])
