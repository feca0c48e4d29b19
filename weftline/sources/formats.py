"""File formats that Spark does not bring: spreadsheets, Avro containers, files as rows, and headers of several lines.

A file is read by one task, whole; files are spread over tasks.  Writers give
each partition a file of its own name, and the driver moves the files of the
tasks that ended into place, so a task that ran twice leaves one file.
"""

from __future__ import annotations

import datetime as dt
import decimal
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_ZERO = dt.date(1970, 1, 1)
_START = dt.datetime(1970, 1, 1)


class FormatError(ValueError):
    """A file or schema that a format cannot express."""


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def _rows(spark: SparkSession, path: str, schema: T.StructType, parse: Callable[[bytes], Iterable[dict]]) -> DataFrame:
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for content in b.column(0):
                held = []
                for row in parse(content.as_py()):
                    held.append(row)
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held = []
                yield pa.RecordBatch.from_pylist(held, arrow)

    return _contents(spark, path).select("content").mapInArrow(run, schema)


def _written(df: DataFrame, path: str, mode: str, ending: str, encode: Callable[[Iterator[pa.RecordBatch]], Iterator[bytes]]) -> None:
    """A file a partition, put into place by the driver."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    at = fs.makeQualified(at)
    there = fs.exists(at) and len(fs.listStatus(at)) > 0
    if there and mode == "errorifexists":
        raise FileExistsError(path)
    aside = f"{at.toString()}/_temporary/{uuid.uuid4().hex}"
    fs.mkdirs(hadoop.Path(aside))
    uri = aside if "://" in aside else re.sub(r"^file:/+", "/", aside)

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        first = next(batches, None)
        if first is None:
            return
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.{ending}"
        files, folder = pa.fs.FileSystem.from_uri(uri)

        def all_batches():
            yield first
            yield from batches

        with files.open_output_stream(f"{folder}/{name}") as out:
            for piece in encode(all_batches()):
                out.write(piece)
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    names = [r.name for r in df.mapInArrow(run, "name string").collect()]
    if there and mode == "overwrite":
        for f in fs.listStatus(at):
            if not f.getPath().getName().startswith("_"):
                fs.delete(f.getPath(), True)
    for n in names:
        if not fs.rename(hadoop.Path(aside, n), hadoop.Path(at, n)):
            raise OSError(f"cannot move {n}")
    fs.delete(hadoop.Path(at, "_temporary"), True)


# Spreadsheets
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATED = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _place(ref: str) -> int:
    """The number of a cell's column, from 0."""
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_cells(content: bytes, sheet: str | None = None) -> Iterator[list]:
    """The rows of a sheet as texts, numbers, booleans and nulls; the first sheet if none is named."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        sheets = {s.get("name"): s.get(f"{_RELATED}id") for s in book.iter(f"{_MAIN}sheet")}
        if sheet is not None and sheet not in sheets:
            raise FormatError(f"no sheet {sheet}; there are {sorted(sheets)}")
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = links[sheets[sheet] if sheet is not None else next(iter(sheets.values()))]
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list = []
                for i, c in enumerate(row.iter(f"{_MAIN}c")):
                    at = _place(c.get("r")) if c.get("r") else i
                    cells += [None] * (at + 1 - len(cells))
                    kind, v = c.get("t", "n"), c.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif v is not None and v.text is not None:
                        cells[at] = shared[int(v.text)] if kind == "s" else v.text == "1" if kind == "b" else v.text if kind in ("str", "e") else float(v.text)
                row.clear()
                yield cells


def _cell(value, to: T.DataType):
    """A cell as a field's type; days of spreadsheets count from 1899-12-30."""
    if value is None or value == "" and not isinstance(to, T.StringType):
        return None
    if isinstance(to, T.StringType):
        return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value).lower() if isinstance(value, bool) else str(value)
    if isinstance(to, T.BooleanType):
        return value if isinstance(value, bool) else str(value).lower() in ("true", "1", "1.0")
    if isinstance(to, T.IntegralType):
        return int(float(value))
    if isinstance(to, (T.FloatType, T.DoubleType)):
        return float(value)
    if isinstance(to, T.DecimalType):
        return decimal.Decimal(str(value)).quantize(decimal.Decimal(1).scaleb(-to.scale))
    if isinstance(to, T.DateType):
        return dt.date(1899, 12, 30) + dt.timedelta(days=int(value)) if isinstance(value, float) else dt.date.fromisoformat(value[:10])
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        when = dt.datetime(1899, 12, 30) + dt.timedelta(seconds=round(value * 86400, 3)) if isinstance(value, float) else dt.datetime.fromisoformat(value)
        return when.replace(tzinfo=dt.UTC) if isinstance(to, T.TimestampType) and when.tzinfo is None else when
    return json.loads(value)


def read_excel(spark: SparkSession, path: str, schema: T.StructType | None, options: dict) -> DataFrame:
    """Rows of the sheet `sheet_name` after `skip_header_row_number` rows, by position."""
    if schema is None:
        raise FormatError("excel needs a schema")
    skip, sheet, fields = int(options.get("skip_header_row_number", 0)), options.get("sheet_name"), schema.fields

    def parse(content: bytes):
        for i, cells in enumerate(sheet_cells(content, sheet)):
            if i >= skip:
                cells += [None] * (len(fields) - len(cells))
                yield {f.name: _cell(v, f.dataType) for f, v in zip(fields, cells, strict=False)}

    return _rows(spark, path, schema, parse)


def _sheet_row(values: list) -> str:
    out = []
    for v in values:
        if v is None:
            out.append("<c/>")
        elif isinstance(v, bool):
            out.append(f'<c t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float, decimal.Decimal)):
            out.append(f"<c><v>{v}</v></c>")
        else:
            text = json.dumps(v, default=str) if isinstance(v, (list, dict, tuple)) else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)
            out.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text))}</t></is></c>')
    return f"<row>{''.join(out)}</row>"


def write_excel(df: DataFrame, path: str, mode: str, options: dict) -> None:
    """A workbook a partition, with a row of names."""
    names, title = df.columns, options.get("sheet_name") or "Sheet1"

    def encode(batches):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
            z.writestr("_rels/.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_RELATED[1:-1]}"><sheets><sheet name="{escape(title, {chr(34): "&quot;"})}" sheetId="1" r:id="r1"/></sheets></workbook>')
            with z.open("xl/worksheets/sheet1.xml", "w") as f:
                f.write(f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
                f.write(_sheet_row(names).encode())
                for b in batches:
                    for row in b.to_pylist():
                        f.write(_sheet_row(list(row.values())).encode())
                f.write(b"</sheetData></worksheet>")
        yield out.getvalue()

    _written(df, path, mode, "xlsx", encode)


# Avro containers
def avro_schema(t: T.DataType, name: str = "record"):
    """A type as an Avro schema; every field may be null."""
    plain = {T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.StringType: "string", T.BinaryType: "bytes", T.NullType: "null"}
    if type(t) in plain:
        return plain[type(t)]
    if isinstance(t, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return {"type": "long", "logicalType": "timestamp-micros" if isinstance(t, T.TimestampType) else "local-timestamp-micros"}
    if isinstance(t, T.DecimalType):
        return {"type": "bytes", "logicalType": "decimal", "precision": t.precision, "scale": t.scale}
    if isinstance(t, T.ArrayType):
        return {"type": "array", "items": ["null", avro_schema(t.elementType, f"{name}_item")]}
    if isinstance(t, T.MapType):
        return {"type": "map", "values": ["null", avro_schema(t.valueType, f"{name}_value")]}
    if isinstance(t, T.StructType):
        return {"type": "record", "name": name, "fields": [{"name": f.name, "type": ["null", avro_schema(f.dataType, f"{name}_{f.name}")], "default": None} for f in t]}
    raise FormatError(f"avro has no {t.simpleString()}")


def spark_type(schema, known: dict | None = None) -> T.DataType:
    """An Avro schema as a type."""
    known = known if known is not None else {}
    if isinstance(schema, list):
        rest = [s for s in schema if s != "null"]
        if len(rest) > 1:
            raise FormatError(f"a union of {rest}")
        return spark_type(rest[0], known) if rest else T.NullType()
    if isinstance(schema, str):
        plain = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(), "null": T.NullType()}
        return plain[schema] if schema in plain else spark_type(known[schema], known)
    logical, kind = schema.get("logicalType"), schema["type"]
    if "name" in schema:
        known[schema["name"]] = schema
    if logical == "date":
        return T.DateType()
    if logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType()
    if logical in ("local-timestamp-millis", "local-timestamp-micros"):
        return T.TimestampNTZType()
    if logical == "decimal":
        return T.DecimalType(schema["precision"], schema.get("scale", 0))
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"], known))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"], known))
    if kind == "record":
        return T.StructType([T.StructField(f["name"], spark_type(f["type"], known)) for f in schema["fields"]])
    if kind == "enum":
        return T.StringType()
    return T.BinaryType() if kind == "fixed" else spark_type(kind, known)


def _long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _read_long(f) -> int:
    n = shift = 0
    while True:
        c = f.read(1)
        if not c:
            raise EOFError
        n |= (c[0] & 127) << shift
        if c[0] < 128:
            return (n >> 1) ^ -(n & 1)
        shift += 7


def _micros(v: dt.datetime) -> int:
    if v.tzinfo is not None:
        v = v.astimezone(dt.UTC).replace(tzinfo=None)
    return round((v - _START) / dt.timedelta(microseconds=1))


def avro_bytes(value, schema) -> bytes:
    """A value in Avro's binary form."""
    if isinstance(schema, list):
        if value is None:
            return _long(schema.index("null"))
        at = next(i for i, s in enumerate(schema) if s != "null")
        return _long(at) + avro_bytes(value, schema[at])
    logical = schema.get("logicalType") if isinstance(schema, dict) else None
    kind = schema["type"] if isinstance(schema, dict) else schema
    if logical == "date":
        return _long((value - _ZERO).days)
    if logical and "timestamp" in logical:
        return _long(_micros(value) // (1000 if "millis" in logical else 1))
    if logical == "decimal":
        n = int(value.scaleb(schema.get("scale", 0)).to_integral_value())
        body = n.to_bytes((n.bit_length() + 8) // 8, "big", signed=True)
        return _long(len(body)) + body
    if kind == "record":
        return b"".join(avro_bytes(value.get(f["name"]), f["type"]) for f in schema["fields"])
    if kind == "array":
        return (_long(len(value)) + b"".join(avro_bytes(v, schema["items"]) for v in value) if value else b"") + b"\x00"
    if kind == "map":
        pairs = list(value.items()) if isinstance(value, dict) else list(value)
        return (_long(len(pairs)) + b"".join(avro_bytes(k, "string") + avro_bytes(v, schema["values"]) for k, v in pairs) if pairs else b"") + b"\x00"
    if kind in ("string", "bytes"):
        body = value.encode() if isinstance(value, str) else bytes(value)
        return _long(len(body)) + body
    if kind in ("int", "long"):
        return _long(value)
    if kind in ("float", "double"):
        return struct.pack("<f" if kind == "float" else "<d", value)
    return bytes([int(value)]) if kind == "boolean" else b""


def avro_value(f, schema, known: dict):
    """The next value of a stream."""
    if isinstance(schema, list):
        return avro_value(f, schema[_read_long(f)], known)
    if isinstance(schema, str) and schema in known:
        schema = known[schema]
    logical = schema.get("logicalType") if isinstance(schema, dict) else None
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return avro_value(f, kind, known)
    if isinstance(schema, dict) and "name" in schema:
        known[schema["name"]] = schema
    if kind in ("int", "long"):
        n = _read_long(f)
        if logical == "date":
            return _ZERO + dt.timedelta(days=n)
        if logical and "timestamp" in logical:
            when = _START + dt.timedelta(microseconds=n * (1000 if "millis" in logical else 1))
            return when if logical.startswith("local") else when.replace(tzinfo=dt.UTC)
        return n
    if kind in ("string", "bytes", "fixed"):
        body = f.read(schema["size"] if kind == "fixed" else _read_long(f))
        if logical == "decimal":
            return decimal.Decimal(int.from_bytes(body, "big", signed=True)).scaleb(-schema.get("scale", 0))
        return body.decode() if kind == "string" else body
    if kind == "record":
        return {x["name"]: avro_value(f, x["type"], known) for x in schema["fields"]}
    if kind in ("array", "map"):
        out: list = []
        while n := _read_long(f):
            if n < 0:
                n = -n
                _read_long(f)
            for _ in range(n):
                out.append(avro_value(f, schema["items"], known) if kind == "array" else (avro_value(f, "string", known), avro_value(f, schema["values"], known)))
        return out
    if kind in ("float", "double"):
        return struct.unpack("<f" if kind == "float" else "<d", f.read(4 if kind == "float" else 8))[0]
    if kind == "boolean":
        return f.read(1) == b"\x01"
    return schema["symbols"][_read_long(f)] if kind == "enum" else None


def avro_header(f) -> tuple[object, str, bytes]:
    """(schema, codec, mark between blocks) of a container."""
    if f.read(4) != b"Obj\x01":
        raise FormatError("not an avro container")
    about = dict(avro_value(f, {"type": "map", "values": "bytes"}, {}))
    return json.loads(about["avro.schema"]), about.get("avro.codec", b"null").decode(), f.read(16)


def avro_rows(content: bytes) -> Iterator[dict]:
    f = io.BytesIO(content)
    schema, codec, mark = avro_header(f)
    while f.tell() < len(content):
        n, size = _read_long(f), _read_long(f)
        block = f.read(size)
        if codec == "deflate":
            block = zlib.decompress(block, -15)
        elif codec == "snappy":
            block = pa.Codec("snappy").decompress(block[:-4], _snappy_size(block), asbytes=True)
        elif codec == "zstandard":
            block = _unzstd(block)
        elif codec != "null":
            raise FormatError(f"unknown avro codec {codec}")
        if f.read(16) != mark:
            raise FormatError("a broken avro block")
        b = io.BytesIO(block)
        for _ in range(n):
            yield avro_value(b, schema, {})


def _snappy_size(block: bytes) -> int:
    n = shift = 0
    for c in block:
        n |= (c & 127) << shift
        if c < 128:
            break
        shift += 7
    return n


def _unzstd(block: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(block)


def read_avro(spark: SparkSession, path: str, schema: T.StructType | None, options: dict) -> DataFrame:
    """Rows of containers; without a schema, by that of the first file.  Fields are matched by name."""
    if schema is None:
        first = _contents(spark, path).select(F.substring("content", F.lit(1), F.lit(1 << 20)).alias("head")).first()
        if first is None:
            raise FormatError(f"no file in {path}")
        schema = spark_type(avro_header(io.BytesIO(bytes(first.head)))[0])
    names = schema.names
    return _rows(spark, path, schema, lambda content: ({n: r.get(n) for n in names} for r in avro_rows(content)))


def write_avro(df: DataFrame, path: str, mode: str, options: dict) -> None:
    """A container a partition, in deflated blocks."""
    schema = avro_schema(df.schema)

    def encode(batches):
        mark = uuid.uuid4().bytes
        about = {"avro.schema": json.dumps(schema).encode(), "avro.codec": b"deflate"}
        yield b"Obj\x01" + avro_bytes(about, {"type": "map", "values": "bytes"}) + mark
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                rows = b.slice(at, 4096).to_pylist(maps_as_pydicts="lossy")
                packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                block = packer.compress(b"".join(avro_bytes(r, schema) for r in rows)) + packer.flush()
                yield _long(len(rows)) + _long(len(block)) + block + mark

    _written(df, path, mode, "avro", encode)


# Files as rows
def read_binary(spark: SparkSession, path: str, schema: T.StructType | None, options: dict) -> DataFrame:
    """data, relativePath and partIndex of every file that is not empty."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    root = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
    plain = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    here = plain(F.lit(root + "/"))
    relative = F.when(F.startswith(plain(F.col("path")), here), F.substring(plain(F.col("path")), F.length(here) + 1, F.length("path"))).otherwise(F.element_at(F.split("path", "/"), -1))
    return _contents(spark, path).select(F.col("content").alias("data"), relative.alias("relativePath"), F.lit(0).cast("long").alias("partIndex"))


def write_binary(df: DataFrame, path: str, mode: str, options: dict) -> None:
    """Rows of data, relativePath and partIndex as the files they came from: a file's parts, in order, by one task."""
    if not {"data", "relativePath"} <= set(df.columns):
        raise FormatError("binary needs data and relativePath")
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    at = fs.makeQualified(at)
    if fs.exists(at):
        if mode == "errorifexists":
            raise FileExistsError(path)
        if mode == "overwrite":
            fs.delete(at, True)
    fs.mkdirs(at)
    uri = re.sub(r"^file:/+", "/", at.toString())
    part = F.col("partIndex") if "partIndex" in df.columns else F.lit(0)
    parts = df.select("relativePath", part.cast("long").alias("partIndex"), "data").repartition("relativePath").sortWithinPartitions("relativePath", "partIndex")

    def run(batches):
        files, folder = pa.fs.FileSystem.from_uri(uri)
        name, out = None, None
        for b in batches:
            for row in b.to_pylist():
                if row["relativePath"] != name:
                    if out is not None:
                        out.close()
                    name = row["relativePath"]
                    if name.startswith("/") or ".." in name.split("/"):
                        raise FormatError(f"{name} leads out of the folder")
                    files.create_dir(f"{folder}/{name}".rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(f"{folder}/{name}")
                out.write(row["data"] or b"")
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["name"])

    parts.mapInArrow(run, "name string").collect()


def read_after(spark: SparkSession, path: str, schema: T.StructType | None, skip: int, sep: str) -> DataFrame:
    """Delimited rows after the first `skip` lines of each file; a file is one row until it is cut into lines."""
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.explode(F.slice(F.split("value", r"\r?\n"), F.lit(skip + 1), F.lit((1 << 31) - 1))).alias("value")).filter("value <> ''")
    if schema is None:
        return lines.withColumnRenamed("value", "content")
    return lines.select(F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"sep": sep}).alias("r")).select("r.*")


def read_attributes(spark: SparkSession, path: str, schema: T.StructType, tag: str) -> DataFrame:
    """A row for each element `tag`, its fields the element's attributes; a file is one row until it is cut."""
    whole = spark.read.text(path, wholetext=True)
    quoted = r"""\s*=\s*("[^"]*"|'[^']*')"""
    each = whole.select(F.explode(F.regexp_extract_all("value", F.lit(rf"""<{re.escape(tag)}(\s(?:[^>"']|"[^"]*"|'[^']*')*)?/?>"""), F.lit(1))).alias("a"))

    def field(f: T.StructField):
        text = F.regexp_extract("a", rf"\s{re.escape(f.name)}{quoted}", 1)
        value = F.substring(text, F.lit(2), F.length(text) - 2)
        for mark, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            value = F.replace(value, F.lit(mark), F.lit(plain))
        return F.when(text != "", value).cast(f.dataType).alias(f.name)

    return each.select(*[field(f) for f in schema])


READERS: dict[str, Callable[[SparkSession, str, T.StructType | None, dict], DataFrame]] = {"excel": read_excel, "avro": read_avro, "binary": read_binary}
WRITERS: dict[str, Callable[[DataFrame, str, str, dict], None]] = {"excel": write_excel, "avro": write_avro, "binary": write_binary}
