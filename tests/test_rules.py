"""Rules of the SQL transform, transforms, changelogs and sinks on small rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators import transforms as tr
from weftline.plans.sql import sql
from weftline.plans.types import SqlError, parse_type
from weftline.sources import cdc, connectors, readers, sinks


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "Joy Ding", 20), (2, "May Ding", 21), (3, None, 24)], "id int, name string, age int")


@pytest.mark.parametrize(
    ("where", "ids"),
    [("name = 'Joy Ding'", [1]), ("name <> 'Joy Ding'", [2, 3]), ("name <> NULL", [1, 2]), ("name LIKE 'Joy%'", [1]), ("name NOT LIKE 'Joy%'", [2]), ("name IN ('May Ding', NULL)", [2]), ("name NOT IN ('May Ding', NULL)", [1]), ("name NOT IN (NULL, 'May Ding')", [1, 3]), ("(id = 1 OR id = 2) AND age > 20", [2]), ("name LIKE '_oy.D%'", [1])],
)
def test_two_valued(people, where, ids):
    assert sorted(r.id for r in sql(people, f"SELECT id FROM dual WHERE {where}").collect()) == ids


@pytest.mark.parametrize("query", ["SELECT id FROM a JOIN b", "SELECT id FROM a ORDER BY id", "SELECT id FROM a GROUP BY id", "SELECT id FROM a LIMIT 1", "DELETE FROM a", "SELECT id FROM a UNION SELECT 1", "SELECT id FROM a WHERE NOT (id = 1)", "SELECT SUM(id) FROM a", "SELECT CAST(id AS BOOLEAN) FROM a", "SELECT nope FROM a", "SELECT id FROM a WHERE id BETWEEN 1 AND 2", "SELECT DISTINCT id FROM a", "SELECT id FROM (SELECT 1)"])
def test_rejected(people, query):
    with pytest.raises(SqlError):
        sql(people, query)


def test_types_and_names(people):
    out = sql(people, "SELECT id, age + 1, 1.5 AS d, age / 3 AS q, CEIL(2.1) AS c FROM dual")
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "int", "double", "int", "int"]
    assert out.columns[1] == "age + 1"
    assert out.first()[3] == 6


def test_hidden_columns_ride(people):
    df = people.withColumn("_row_kind", F.lit("+U"))
    out = sql(df, "SELECT *, 'from' AS w FROM dual WHERE id = 1")
    assert out.columns == ["id", "name", "age", "w", "_row_kind"]
    assert out.first()["_row_kind"] == "+U"


def test_types():
    assert parse_type("map<string, array<decimal(10,2)>>").simpleString() == "map<string,array<decimal(10,2)>>"


@pytest.mark.parametrize(("row", "col", "want"), [("FAIL", None, "raise"), ("SKIP", None, 1), ("FAIL", "SKIP", 2), ("FAIL", "SKIP_ROW", 1), ("SKIP", "FAIL", "raise")])
def test_json_policies(spark, row, col, want):
    df = spark.createDataFrame([('{"f1": 1}',), ('{"f2": 1}',)], "data string")
    out = tr.json_path(df, [{"src_field": "data", "path": "$.f1", "dest_field": "f1", "dest_type": "int", "column_error_handle_way": col}], row)
    if want == "raise":
        with pytest.raises(Exception, match="JsonPath"):
            out.collect()
    else:
        assert out.count() == want


def test_replace_first_with_groups(spark):
    df = spark.createDataFrame([("ab-ab\nab",), (None,)], "s string")
    assert [r.s for r in tr.replace(df, "s", "(a)(b)", "$2$1", True, True).collect()] == ["ba-ab\nab", None]


def test_changelog(spark):
    schema = readers.schema_of({"pk_id": "bigint", "name": "string", "score": "int"})
    kinds = [("+I", 1, "A"), ("+I", 2, "B"), ("+I", 3, "C"), ("-U", 1, "A"), ("+U", 1, "A_1"), ("-D", 2, "B")]
    df = readers.fake(spark, schema, rows=[{"kind": k, "fields": (i, n, 100)} for k, i, n in kinds]).coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    assert sorted(map(tuple, cdc.collapse(df, ["pk_id"], ["seq"]).collect())) == [(1, "A_1", 100), (3, "C", 100)]


def test_fake_and_assert(spark):
    df = readers.fake(spark, readers.schema_of({"i": "int", "s": "string", "m": "map<string, int>", "r": {"x": "date"}}), row_num=5, parallelism=2)
    assert sinks.assert_sink(df, [{"rule_type": "MIN_ROW", "rule_value": 10}], [{"field_name": "s", "field_value": [{"rule_type": "NOT_NULL"}]}]) == {"rows": 10}
    with pytest.raises(sinks.AssertFailed):
        sinks.assert_sink(df, [{"rule_type": "MAX_ROW", "rule_value": 9}])


def test_files_round_trip(spark, tmp_path, people):
    for kind, options in (("parquet", {}), ("orc", {}), ("json", {}), ("csv", {"header": "true"})):
        sinks.save_files(people, str(tmp_path / kind), kind, **options)
        back = readers.read_files(spark, str(tmp_path / kind), kind, schema=people.schema, **options)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, people.collect()))


def test_stream(spark, tmp_path, people):
    from weftline.streaming import run

    sinks.save_files(people, str(tmp_path / "in"))
    df = sql(run.stream_files(spark, str(tmp_path / "in"), people.schema), "SELECT id, age + 1 AS a FROM dual WHERE id > 1")
    for _ in range(2):  # a restart on the same checkpoint writes nothing twice
        run.write_files(df, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(2, 22), (3, 25)]


def test_placeholders():
    assert sinks.placeholders("x_${table_name}_${nope:d}_${gone}", {"table_name": "t"}) == "x_t_d_${gone}"


def test_client_transforms(people):
    out = tr.llm(people, "say", lambda prompts: [str(len(p)) for p in prompts], ["name"], output_data_type="INT")
    assert out.schema["llm_output"].dataType == T.IntegerType() and out.count() == 3
    assert tr.embedding(people, {"v": "name"}, lambda texts: [[float(len(t))] for t in texts], 2).first()["v"] == [8.0]


def test_changelog_messages(spark):
    rows = [(1, None, "+I"), (2, 'q"é', "-U"), (2, "z", "+U"), (3, "", "-D")]
    df = spark.createDataFrame(rows, "id int, s string, _row_kind string")
    for name, encode in cdc.ENCODERS.items():
        back = cdc.DECODERS[name](encode(df), T.StructType([T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType())]))
        assert [(r.id, r.s, r._row_kind) for r in back.collect()] == [(1, None, "+I"), (2, 'q"é', "-D"), (2, "z", "+I"), (3, "", "-D")], name
        keyed = connectors.encoded(df, name, ["id"])
        assert keyed.columns == ["key", "value"] and keyed.first().key == '{"id":1}'


def test_kafka_connect(spark):
    texts = ['{"schema": {"type": "struct"}, "payload": {"id": 1, "s": "a"}}', '{"id": 2, "s": null}', '{"schema": null, "payload": null}', "not json", None]
    back = cdc.kafka_connect(spark.createDataFrame([(t,) for t in texts], "value string"), T.StructType([T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType())]), ignore_parse_errors=True)
    assert [tuple(r) for r in back.collect()] == [(1, "a", "+I"), (2, None, "+I")]


def test_fake_options(spark):
    schema = readers.schema_of({"a": "int", "b": "string", "c": "array<int>", "d": "map<string, bigint>", "e": "double", "f": "date", "g": "timestamp", "h": "bytes", "i": "decimal(30, 8)", "j": "decimal(4, 4)", "k": "bigint", "l": {"m": "tinyint", "n": "null"}})
    conf = {"int.min": 5, "int.max": 9, "string.length": 40, "array.size": 3, "map.size": 2, "double.template": [1.5, 2.5], "date.year.template": [2001], "bytes.length": 7, "tinyint.min": -3, "tinyint.max": -3, "split.num": 2}
    df = readers.fake(spark, schema, 50, 2, options=conf)
    rows = df.collect()
    assert len(rows) == 100 and df.rdd.getNumPartitions() == 4 and rows == df.collect()
    assert {r.a for r in rows} == {5, 6, 7, 8, 9} and {v for r in rows for v in r.c} == {5, 6, 7, 8, 9}
    assert all(len(r.b) == 40 and len(r.c) == 3 and len(r.d) == 2 and len(r.h) == 7 and r.l.m == -3 and r.l.n is None for r in rows)
    assert {r.e for r in rows} == {1.5, 2.5} and {r.f.year for r in rows} == {2001} and all(0 <= r.j < 1 for r in rows)
    assert len({r.k for r in rows}) == len({r.i for r in rows}) == len({r.b for r in rows}) == 100
    every = readers.fake(spark, schema, 20).collect()
    assert len(every) == 20 and all(len(r.b) == 5 and len(r.c) == 5 and 1970 <= r.g.year <= 2038 for r in every)
