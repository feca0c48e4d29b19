"""Sources: files by format, and a generator of test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.types import parse_type


def schema_of(fields: dict[str, str | dict]) -> T.StructType:
    """A schema from {name: type}; a nested dict is a row."""
    return T.StructType([T.StructField(n, schema_of(t) if isinstance(t, dict) else parse_type(t)) for n, t in fields.items()])


def read_files(spark: SparkSession, path: str | list[str], file_format_type: str = "parquet", schema: T.StructType | None = None, read_columns: list[str] | None = None, **options) -> DataFrame:
    """Files by format; partition folders become columns and `read_columns` reaches the scan.

    Without a schema, text is one column `content`.
    """
    reader = spark.read.format({"text": "csv" if schema else "text", "binary": "binaryFile"}.get(file_format_type, file_format_type))
    if file_format_type == "text" and schema:
        options.setdefault("sep", options.pop("field_delimiter", "\x01"))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path)
    if file_format_type == "text" and schema is None:
        df = df.withColumnRenamed("value", "content")
    return df.select(*read_columns) if read_columns else df


#: The largest values that the generator makes by default.
_MOST = {"tinyint": 127, "smallint": 32767, "int": 2**31 - 1, "bigint": 2**63 - 1, "float": 3.4028234663852886e38, "double": 1.7976931348623157e308}
#: Parts of dates and times, their least and largest values, and the type they belong to.
_PARTS = {"date": {"year": (1970, 2038), "month": (1, 12), "day": (1, 28)}, "time": {"hour": (0, 23), "minute": (0, 59), "second": (0, 59)}}


def fake(spark: SparkSession, schema: T.StructType, row_num: int = 5, parallelism: int = 1, rows: list[dict] | None = None, seed: int = 0, options: dict | None = None, stream: bool = False) -> DataFrame:
    """Random rows of a schema, `row_num` for each degree of parallelism; or the given rows with their kinds.

    `options` by dotted name: a type's `min` and `max`, or its `template`, a
    list to choose from; `string.length`, `bytes.length`, `array.size`,
    `map.size`; `date.year.template` and so on for the parts of dates and
    times; `split.num` partitions for each degree of parallelism.  Values hang
    on the row's number and the seed, so a task that runs again gives the same.
    """
    if stream:
        return _fake_stream(spark, schema, row_num, parallelism, rows, seed, options or {})
    if rows is not None:
        given = T.StructType([*schema.fields, T.StructField("_row_kind", T.StringType())])
        return spark.createDataFrame([(*r["fields"], {"INSERT": "+I", "UPDATE_BEFORE": "-U", "UPDATE_AFTER": "+U", "DELETE": "-D"}.get(r["kind"], r["kind"])) for r in rows], given)
    conf = options or {}
    base = spark.range(0, row_num * parallelism, 1, max(1, parallelism * int(conf.get("split.num", 1))))
    return generated(base, schema, seed, conf)


def _fake_stream(spark: SparkSession, schema: T.StructType, row_num: int, parallelism: int, rows: list[dict] | None, seed: int, conf: dict) -> DataFrame:
    """`row_num` rows a batch and degree of parallelism, without an end; given rows come again in every batch."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", row_num * parallelism if rows is None else 1).option("numPartitions", max(1, parallelism)).load().withColumnRenamed("value", "id")
    if rows is None:
        return generated(ticks, schema, seed, conf)
    return ticks.select("id").join(F.broadcast(fake(spark, schema, rows=rows))).drop("id")


def generated(base: DataFrame, schema: T.StructType, seed: int, conf: dict) -> DataFrame:
    """Random values of a schema for each `id` of `base`; they hang on the id and the seed alone."""

    def below(span: int, at: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(at)), F.lit(min(span, 2**63 - 1)).cast("long"))

    def chosen(values: list, at: int, to: T.DataType) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(to) for v in values]), (below(len(values), at) + 1).cast("int"))

    def part(kind: str, name: str, at: int) -> Column:
        low, high = _PARTS[kind][name]
        values = conf.get(f"{'date' if kind == 'date' else 'time'}.{name}.template")
        return chosen(values, at, T.IntegerType()) if values else (below(high - low + 1, at) + low).cast("int")

    def text(at: int, length: int) -> Column:
        return F.substring(F.concat(*[F.md5(F.concat_ws("-", "id", F.lit(seed), F.lit(at), F.lit(i)).cast("binary")) for i in range(-(-length // 32) or 1)]), 1, length)

    def value(t: T.DataType, at: int) -> Column:
        name = t.simpleString().partition("(")[0]
        if values := conf.get(f"{name}.template"):
            return chosen(values, at, t)
        if isinstance(t, T.StringType):
            return text(at, int(conf.get("string.length", 5)))
        if isinstance(t, T.BooleanType):
            return below(2, at) == 1
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            day = F.make_date(*[part("date", n, at * 31 + i) for i, n in enumerate(_PARTS["date"])])
            return day if isinstance(t, T.DateType) else F.make_timestamp(F.year(day), F.month(day), F.day(day), *[part("time", n, at * 31 + 5 + i) for i, n in enumerate(_PARTS["time"])]).cast(t)
        if isinstance(t, T.BinaryType):
            return text(at, int(conf.get("bytes.length", 5))).cast("binary")
        if isinstance(t, T.ArrayType):
            return F.array(*[value(t.elementType, at * 31 + i) for i in range(int(conf.get("array.size", 5)))]).cast(t)
        if isinstance(t, T.MapType):
            # keys that meet keep the first value, so a map may be smaller than asked
            pairs = F.array(*[F.struct(value(t.keyType, at * 31 + 2 * i), value(t.valueType, at * 31 + 2 * i + 1)) for i in range(int(conf.get("map.size", 5)))])
            keep = F.array_distinct(F.transform(pairs, lambda p: p["col1"]))
            return F.map_from_arrays(keep, F.transform(keep, lambda k: F.filter(pairs, lambda p: p["col1"] == k)[0]["col2"])).cast(t)
        if isinstance(t, T.StructType):
            return F.struct(*[value(f.dataType, at * 31 + i).alias(f.name) for i, f in enumerate(t)])
        if isinstance(t, T.NullType):
            return F.lit(None)
        low, high = conf.get(f"{name}.min", 0), conf.get(f"{name}.max", _MOST.get(name))
        if isinstance(t, T.DecimalType):
            whole, cents = min(t.precision - t.scale, 18), min(t.scale, 18)
            digits = F.lpad(below(10**cents, at * 31 + 1).cast("string"), cents, "0") if cents else F.lit("0")
            return F.concat((below(10**whole, at) if whole else F.lit(0)).cast("string"), F.lit("."), digits).cast(t)
        if isinstance(t, (T.FloatType, T.DoubleType)):
            share = below(2**53, at) / float(2**53)
            return (F.lit(float(low)) + share * (float(high) - float(low))).cast(t)
        return (below(int(high) - int(low) + 1, at) + int(low)).cast(t)

    return base.select(*[value(f.dataType, 7 * i + 1).alias(f.name) for i, f in enumerate(schema)])
