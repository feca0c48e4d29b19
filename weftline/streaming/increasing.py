"""A database table with an increasing key as a stream, read by tasks in ranges of the key.

The offset is the last key that was given.  A batch is the keys after it up to
the greatest there is, cut into ranges of about `split.size` keys; each is read
by a task of its own over Python's database interface (PEP 249), since tasks of
Python have no JDBC.  A range whose task fails is given to another one, and a
job that starts again goes on after its checkpoint's last key, with the same
ranges for a batch that had begun.

Keys must come in increasing order.  Where transactions may commit a smaller
key after a greater one, `lag` keeps the newest so many keys for later.
"""

from __future__ import annotations

import importlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "weftline_increasing"
FETCHED = 1024
#: Ranges of a batch.
MOST = 1024
_PLAIN = re.compile(r'[A-Za-z_][\w$]*(\.[A-Za-z_][\w$]*)*')


class Range(InputPartition):
    def __init__(self, after: int, last: int):
        self.after, self.last = after, last


class IncreasingSource(DataSource):
    """Options: dbapi.module, dbapi.connect (the arguments as JSON), table, column, split.size, lag, start."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: T.StructType) -> IncreasingReader:
        return IncreasingReader(self.options, schema)


class IncreasingReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.module, self.arguments = options["dbapi.module"], json.loads(options["dbapi.connect"])
        self.table, self.column, self.names = options["table"], options["column"], schema.names
        for name in (self.table, self.column, *self.names):
            if not _PLAIN.fullmatch(name):
                raise ValueError(f"{name!r} is no plain name")
        self.size, self.lag, self.start = int(options.get("split.size", 8096)), int(options.get("lag", 0)), options.get("start")
        self.types = _arrow(schema)

    def _connect(self):
        return importlib.import_module(self.module).connect(**self.arguments) if isinstance(self.arguments, dict) else importlib.import_module(self.module).connect(*self.arguments)

    def _one(self, what: str):
        connection = self._connect()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT {what}({self.column}) FROM {self.table}")
            return cursor.fetchone()[0]
        finally:
            connection.close()

    def initialOffset(self) -> dict:
        if self.start is not None:
            return {"last": int(self.start) - 1}
        least = self._one("MIN")
        return {"last": -1 if least is None else int(least) - 1}

    def latestOffset(self) -> dict:
        most = self._one("MAX")
        begin = self.initialOffset()["last"]
        return {"last": begin if most is None else max(begin, int(most) - self.lag)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        a, b = start["last"], end["last"]
        n = min(MOST, max(1, -(-(b - a) // self.size)))
        ends = [a + (b - a) * i // n for i in range(n + 1)]
        return [Range(x, y) for x, y in zip(ends, ends[1:], strict=False) if y > x]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        connection = self._connect()
        try:
            cursor = connection.cursor()
            # Whole numbers alone are put in, so the text serves drivers of every parameter style.
            cursor.execute(f"SELECT {', '.join(self.names)} FROM {self.table} WHERE {self.column} > {int(partition.after)} AND {self.column} <= {int(partition.last)}")
            while rows := cursor.fetchmany(FETCHED):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), self.types, strict=True)], self.names)
        finally:
            connection.close()


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    known = {T.ByteType: pa.int8(), T.ShortType: pa.int16(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.FloatType: pa.float32(), T.DoubleType: pa.float64(), T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(), T.DateType: pa.date32(), T.TimestampType: pa.timestamp("us", "UTC"), T.TimestampNTZType: pa.timestamp("us")}
    out = []
    for f in schema:
        kind = pa.decimal128(f.dataType.precision, f.dataType.scale) if isinstance(f.dataType, T.DecimalType) else known.get(type(f.dataType))
        if kind is None:
            raise ValueError(f"{f.name}: a stream of a table has no {f.dataType.simpleString()}")
        out.append(kind)
    return out


def stream(spark: SparkSession, options: dict, schema: T.StructType) -> DataFrame:
    spark.dataSource.register(IncreasingSource)
    connect = options["dbapi.connect"]
    given = {"dbapi.module": options["dbapi.module"], "dbapi.connect": connect if isinstance(connect, str) else json.dumps(connect), "table": options["table_path"], "column": options["partition_column"]}
    given |= {k: str(options[k]) for k in ("split.size", "lag", "start") if options.get(k) is not None}
    return spark.readStream.format(NAME).options(**given).schema(schema).load()
