"""Formats that are written here, and stores' addresses."""

from __future__ import annotations

import datetime as dt
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.job import run_job
from weftline.sources import formats, packages, stores

SCHEMA = "i int, l long, f float, d double, s string, b boolean, n decimal(9,3), day date, at timestamp, y binary, a array<int>, m map<string,double>, r struct<x:int,y:array<string>>"
ROWS = [
    (1, 2**40, 1.5, -2.25, "é<&> \"x\"", True, Decimal("12.345"), dt.date(2024, 2, 29), dt.datetime(1969, 12, 31, 23, 59, 59, 5), bytearray(b"\x00\xff"), [1, None, -3], {"k": 1.0, "z": None}, (7, ["p", None])),
    (-1, -(2**40), None, 0.0, "", False, Decimal("-0.001"), dt.date(1901, 1, 1), dt.datetime(2030, 1, 2, 3, 4, 5), bytearray(), [], {}, None),
    (None,) * 13,
]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_avro_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "a")
    for mode, times in (("append", 1), ("append", 2), ("overwrite", 1)):
        formats.write_avro(frame, path, mode, {})
        for schema in (frame.schema, None):
            got = formats.read_avro(spark, path, schema, {})
            assert got.schema.simpleString() == frame.schema.simpleString()
            assert sorted(map(str, got.collect())) == sorted([str(r) for r in frame.collect()] * times)
    some = formats.read_avro(spark, path, T.StructType([T.StructField("s", T.StringType()), T.StructField("nope", T.IntegerType())]), {})
    assert {tuple(r) for r in some.collect()} == {("é<&> \"x\"", None), ("", None), (None, None)}
    with pytest.raises(FileExistsError):
        formats.write_avro(frame, path, "errorifexists", {})
    assert [p.name for p in tmp_path.joinpath("a").iterdir() if not p.name.endswith((".avro", ".crc"))] == []


def test_avro_by_hand():
    """A container written by the specification, with an enum, a fixed, a union and blocks with sizes."""
    schema = {"type": "record", "name": "R", "fields": [{"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}}, {"name": "x", "type": {"type": "fixed", "name": "X", "size": 2}}, {"name": "u", "type": ["string", "null"]}, {"name": "l", "type": {"type": "array", "items": "long"}}]}
    head = json.dumps(schema).encode()
    row = b"\x02" + b"hi" + b"\x00\x04yo" + b"\x03\x04\x02\x80\x01\x00"
    content = b"Obj\x01" + b"\x02" + b"\x16avro.schema" + formats._long(len(head)) + head + b"\x00" + b"m" * 16 + b"\x02" + formats._long(len(row)) + row + b"m" * 16
    assert list(formats.avro_rows(content)) == [{"e": "B", "x": b"hi", "u": "yo", "l": [1, 64]}]
    assert formats.spark_type(schema).simpleString() == "struct<e:string,x:binary,u:string,l:array<bigint>>"
    with pytest.raises(formats.FormatError):
        list(formats.avro_rows(b"PAR1"))


def test_excel_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "x")
    some = frame.select("i", "l", "d", "s", "b", "n", "day", "a")
    formats.write_excel(some.coalesce(1), path, "append", {"sheet_name": "A&B"})
    got = formats.read_excel(spark, path, some.schema, {"skip_header_row_number": 1, "sheet_name": "A&B"})
    want = [r.asDict() for r in some.collect()]
    assert sorted(str(r.asDict()) for r in got.collect()) == sorted(map(str, want))
    with pytest.raises(Exception, match="no sheet"):
        formats.read_excel(spark, path, some.schema, {"sheet_name": "C"}).collect()


def test_excel_of_other_writers(spark, tmp_path):
    """Shared strings, cells left out, days as numbers."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="x" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>one</t></si><si><r><t>t</t></r><r><t>wo</t></r></si></sst>")
        z.writestr("xl/worksheets/s.xml", f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>1</v></c><c r="C1"><v>45351.5</v></c></row><row><c r="B2" t="str"><v>7</v></c></row></sheetData></worksheet>')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.TimestampNTZType())])
    assert [tuple(r) for r in formats.read_excel(spark, str(tmp_path / "b.xlsx"), schema, {}).collect()] == [("two", None, dt.datetime(2024, 2, 29, 12)), (None, 7, None)]


def test_binary_round_trip(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.bin").write_bytes(b"\x00\x01" * 500)
    (tmp_path / "in" / "deep" / "b").write_bytes(b"z")
    rows = formats.read_binary(spark, str(tmp_path / "in"), None, {})
    assert sorted((r.relativePath, len(r.data), r.partIndex) for r in rows.collect()) == [("a.bin", 1000, 0), ("deep/b", 1, 0)]
    cut = rows.filter("length(data) > 1").select(F.explode(F.sequence(F.lit(9), F.lit(0))).alias("i"), "data", "relativePath").selectExpr("substring(data, i * 100 + 1, 100) AS data", "relativePath", "cast(i as long) AS partIndex")
    formats.write_binary(cut, str(tmp_path / "out"), "append", {})
    assert (tmp_path / "out" / "a.bin").read_bytes() == b"\x00\x01" * 500
    with pytest.raises(Exception, match="leads out"):
        formats.write_binary(spark.createDataFrame([(b"x", "../y")], "data binary, relativePath string"), str(tmp_path / "out"), "append", {})


def test_job_formats(spark, tmp_path):
    (tmp_path / "h.csv").write_text("made by\nsomeone\nid,name\n1,a\n2,b\n")
    (tmp_path / "canal").mkdir()
    (tmp_path / "canal" / "c.json").write_text('{"type":"INSERT","data":[{"id":"1","name":"a"}]}\n{"type":"UPDATE","data":[{"id":"1","name":"b"}],"old":[{"name":"a"}]}\n')
    schema = 'schema = { fields { id = int, name = string }\n primaryKey { columnNames = ["id"] } }'
    run_job(spark, f"""env {{ job.mode = BATCH }}
source {{ LocalFile {{ path = "{tmp_path}/h.csv", file_format_type = csv, skip_header_row_number = 3, {schema}, plugin_output = h }}
 LocalFile {{ path = "{tmp_path}/canal", file_format_type = canal_json, {schema}, plugin_output = c }} }}
sink {{ LocalFile {{ plugin_input = h, path = "{tmp_path}/e", file_format_type = excel }}
 LocalFile {{ plugin_input = h, path = "{tmp_path}/v", file_format_type = avro }}
 LocalFile {{ plugin_input = h, path = "{tmp_path}/q", file_format_type = csv, csv_string_quote_mode = ALL }}
 LocalFile {{ plugin_input = h, path = "{tmp_path}/x", file_format_type = xml, xml_row_tag = R, xml_root_tag = T, xml_use_attr_format = true }}
 LocalFile {{ plugin_input = c, path = "{tmp_path}/c" }} }}""")
    want = [(1, "a"), (2, "b")]
    types = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    assert sorted(map(tuple, formats.read_excel(spark, f"{tmp_path}/e", types, {"skip_header_row_number": 1}).collect())) == want
    assert sorted(map(tuple, formats.read_avro(spark, f"{tmp_path}/v", None, {}).collect())) == want
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/c").collect()] == [(1, "b")]
    assert '"1","a"' in "".join(p.read_text() for p in (tmp_path / "q").glob("*.csv"))
    assert '<R id="1" name="a"' in "".join(p.read_text() for p in (tmp_path / "x").glob("part-*"))
    back = run_job(spark, f'env {{ job.mode = BATCH }}\nsource {{ LocalFile {{ path = "{tmp_path}/x", file_format_type = xml, xml_row_tag = R, xml_use_attr_format = true, {schema} }} }}\nsink {{ Assert {{ rules {{ row_rules = [{{ rule_type = MIN_ROW, rule_value = 2 }}] }} }} }}')
    assert sorted(map(tuple, back.datasets["source_0"]["source_0"].collect())) == want


def test_stores():
    for plugin, options, prefix, setting in [
        ("S3File", {"bucket": "s3a://b", "access_key": "k", "secret_key": "s", "fs.s3a.endpoint": "e"}, "s3a://b", ("fs.s3a.bucket.b.access.key", "k")),
        ("OssFile", {"bucket": "oss://b", "access_key": "k", "access_secret": "s", "endpoint": "e"}, "oss://b", ("fs.oss.accessKeySecret", "s")),
        ("CosFile", {"bucket": "cosn://b", "secret_id": "k", "secret_key": "s", "region": "r"}, "cosn://b", ("fs.cosn.bucket.region", "r")),
        ("ObsFile", {"bucket": "obs://b", "access_key": "k", "access_secret": "s", "endpoint": "e"}, "obs://b", ("fs.obs.endpoint", "e")),
        ("FtpFile", {"host": "h", "port": 21, "user": "u", "password": "p"}, "ftp://h:21", ("fs.ftp.password.h", "p")),
        ("SftpFile", {"host": "h", "user": "u", "password": "p"}, "sftp://u@h:22", ("fs.sftp.password.h.u", "p")),
        ("HdfsFile", {"fs.defaultFS": "hdfs://n:9000"}, "hdfs://n:9000", ("dfs.client.use.datanode.hostname", "true")),
    ]:
        where, conf = stores.settings(plugin, options)
        assert where == prefix and conf[setting[0]] == setting[1], plugin
    assert stores.settings("LocalFile", {}) == ("", {})


def test_store_address(spark):
    assert stores.located(spark, "S3File", {"bucket": "s3a://b", "path": "/x/y", "access_key": "k"}) == "s3a://b/x/y"
    assert spark._jsc.hadoopConfiguration().get("fs.s3a.bucket.b.access.key") == "k"
    assert stores.located(spark, "LocalFile", {"path": "/x"}) == "/x"


def test_packages():
    assert packages.mongodb({"uri": "u", "database": "d", "collection": "c", "match.query": '{"a": 1}', "primary_keys": ["x", "y"]}) == ("mongodb", {"connection.uri": "u", "database": "d", "collection": "c", "aggregation.pipeline": '[{"$match": {"a": 1}}]', "idFieldList": "x,y", "operationType": "replace"})
    assert packages.cassandra({"host": "h:9042", "keyspace": "k", "table": "t", "username": "u"})[1]["spark.cassandra.connection.port"] == "9042"
    assert packages.hudi({"table_dfs_path": "/w", "table_name": "t", "op_type": "UPSERT", "record_key_fields": "id"})[1] == {"path": "/w/default/t", "hoodie.table.name": "t", "hoodie.datasource.write.operation": "upsert", "hoodie.datasource.write.recordkey.field": "id"}
    made = packages.hbase({"zookeeper_quorum": "z", "table": "t", "rowkey_column": ["id"], "family_name": {"all_columns": "f", "b": "g"}})[1]
    assert packages.hbase_mapping(["id", "a", "b"], made) == "id STRING :key, a STRING f:a, b STRING g:b"
    assert packages.pulsar({"client.service-url": "s", "admin.service-url": "a", "topic": "t", "cursor.startup.mode": "EARLIEST"})[1]["startingOffsets"] == "earliest"
    assert packages.merge_statement("c.t", "s", ["id", "v"], ["id"]).startswith("MERGE INTO c.t t USING s s ON t.`id` <=> s.`id` WHEN MATCHED AND s._row_kind IN ('-D', '-U') THEN DELETE")


PROTO = """
syntax = "proto3"; // a comment
package shop;
import "other.proto";
message Order {
  option deprecated = true;
  enum State { NEW = 0; PAID = 1; }
  message Line { string sku = 1; sint32 n = 2; repeated double prices = 3; }
  int64 id = 1;
  string name = 2;
  bool ok = 3;
  double total = 4;
  bytes raw = 5;
  State state = 6;
  repeated Line lines = 7 [packed = false];
  map<string, int32> counts = 8;
  Line first = 9;
  repeated int32 ns = 10;
  oneof which { float f = 11; fixed64 x = 12; }
  reserved 13, 14;
}
"""


def test_protobuf(spark):
    from weftline.sources import protobuf

    schema = "id long, name string, ok boolean, total double, raw binary, state string, lines array<struct<sku:string,n:int,prices:array<double>>>, counts map<string,int>, first struct<sku:string,n:int,prices:array<double>>, ns array<int>, f float, x long"
    rows = [(-5, "é", True, 2.5, bytearray(b"\x00"), "PAID", [("a", -3, [1.0, 2.0]), ("b", 4, [])], {"k": 1, "l": -2}, ("z", 0, []), [1, -1, 300], 0.5, 7), (0, "", False, 0.0, bytearray(), "NEW", [], {}, None, [], 0.0, 0)]
    df = spark.createDataFrame(rows, schema)
    back = protobuf.decode(protobuf.encode(df, PROTO, "Order"), df.schema, PROTO, "shop.Order")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    # Test vectors of the wire format's description.
    small = protobuf.parse('message Test { int32 a = 1; string b = 2; repeated int32 f = 6; sint32 s = 7; }')
    assert protobuf.read_message(b"\x08\x96\x01\x12\x07testing\x32\x06\x03\x8e\x02\x9e\xa7\x05\x38\x03", "Test", small) == {"a": 150, "b": "testing", "f": [3, 270, 86942], "s": -2}
    broken = spark.createDataFrame([(bytearray(b"\x12\x70x"),), (bytearray(b"\x08\x01"),), (None,)], "value binary")
    one = T.StructType([T.StructField("id", T.LongType())])
    with pytest.raises(Exception, match="malformed"):
        protobuf.decode(broken, one, PROTO, "Order").collect()
    assert [r.id for r in protobuf.decode(broken, one, PROTO, "Order", True).collect()] == [1]
