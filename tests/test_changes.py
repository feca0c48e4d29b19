"""Changelogs written to files, catalog tables and JDBC tables, in batch and streaming jobs."""

from __future__ import annotations

import datetime
import os
import subprocess
import sys
import uuid
from pathlib import Path

import pyspark
import pytest
from pyspark.sql import functions as F

from weftline.plans import catalogue, rules
from weftline.plans.job import JobError, run_job, savepoint
from weftline.plans.keys import keys, primary_key, with_key
from weftline.plans.sql import SqlError, sql
from weftline.sources import cdc, changes, connectors, jdbc
from weftline.sources.sinks import AssertFailed, SaveModeError

CHANGES = [(1, "a", "+I"), (2, "b", "+I"), (1, "a", "-U"), (1, "c", "+U"), (3, "d", "+I"), (2, "b", "-D"), (4, None, "+I"), (4, None, "-D"), (4, "e", "+I")]
LEFT = {(1, "c"), (3, "d"), (4, "e")}


@pytest.fixture
def changed(spark):
    return spark.createDataFrame(CHANGES, "id int, name string, _row_kind string").coalesce(1)


@pytest.fixture
def database():
    return {"url": f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_files(spark, changed, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):  # a second time changes nothing
        changes.upsert_files(changed, path, ["id"])
        assert got(spark.read.parquet(path)) == LEFT
    more = spark.createDataFrame([(3, None, "-D"), (5, "f", "+I"), (1, "g", None)], "id int, name string, _row_kind string")
    changes.upsert_files(more, path, ["id"])
    assert got(spark.read.parquet(path)) == {(1, "g"), (4, "e"), (5, "f")}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_tables(spark, changed):
    name = f"t{uuid.uuid4().hex}"
    try:
        for _ in range(2):
            changes.upsert_table(changed, name, ["id"])
            assert got(spark.table(name)) == LEFT
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_null_keys_and_order(spark):
    rows = spark.createDataFrame([(None, "b", 2, "+I"), (None, "a", 1, "+I"), (1, "x", 5, "-D"), (1, "y", 4, "+I")], "id int, name string, at int, _row_kind string")
    assert {tuple(r) for r in changes.last_changes(rows, ["id"], ["at"]).collect()} == {(None, "b", 2, "+I"), (1, "x", 5, "-D")}
    with pytest.raises(changes.ChangelogError):
        changes.last_changes(rows, ["nope"])


def test_no_key_no_changes(spark, changed, tmp_path):
    with pytest.raises(changes.ChangelogError):
        changes.plain_rows(changed, "t")
    assert changes.plain_rows(changed.filter("_row_kind = '+I'"), "t").columns == ["id", "name"]


@pytest.mark.parametrize("key", [["id"], ["name"]])
def test_jdbc(spark, database, key):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(40)], "id int, name string")
    options = {**database, "primary_keys": key, "table_path": "t", "split.size": 10}
    jdbc.prepare(rows, options, "t")
    for _ in range(2):
        jdbc.write(rows, options, "t")
    assert jdbc.read(spark, options).count() == 40
    gone = spark.createDataFrame([(3, "n3", "-D"), (4, "n4", "-U"), (4, "n4", "+U"), (99, "new", "+I")], "id int, name string, _row_kind string").coalesce(1)
    jdbc.write(gone, options, "t")
    assert got(jdbc.read(spark, options)) == {(i, f"n{i}") for i in range(40) if i != 3} | {(99, "new")}


@pytest.mark.parametrize("key", [["id"], ["id", "part"]])
def test_jdbc_null_keys(spark, database, key):
    schema = "id int, part int, name string, _row_kind string"
    options = {**database, "primary_keys": key, "table_path": "t"}
    for rows in ([(None, 1, "a", "+I"), (1, None, "b", "+I"), (2, 1, "c", "+I")], [(None, 1, "d", "+U"), (1, None, "b", "-D"), (3, None, "e", "+I")]):
        df = spark.createDataFrame(rows, schema)
        jdbc.prepare(df, options, "t")
        jdbc.write(df, options, "t")
    assert got(jdbc.read(spark, options)) == {(None, 1, "d"), (2, 1, "c"), (3, None, "e")}


@pytest.mark.parametrize("name", ["cdc_upsert_files", "cdc_upsert_jdbc"])
def test_upserts_of_rows_without_time_or_user(spark, tmp_path, name):
    at = [datetime.datetime(2024, 1, d) for d in range(1, 5)]
    rows = [(1, None, 1, "signup", 1.0), (2, None, 2, "view", 2.0), (3, at[0], 2, "signup", 3.0), (4, at[1], None, "view", 4.0), (5, at[3], None, "signup", 5.0), (6, at[2], 3, "view", 6.0), (7, at[3], 3, "error", 7.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert got(catalogue.QUERIES[name](spark, str(tmp_path))) == got(catalogue.QUERIES["cdc_collapse"](spark, str(tmp_path))) == {(1, 1.0, "signup"), (2, 3.0, "signup"), (None, 5.0, "signup")}


ON_A_CLUSTER = """
import sys
from pyspark.sql import SparkSession
from weftline.plans import catalogue
from weftline.sources import jdbc
from weftline.sources.sinks import SaveModeError

spark = SparkSession.builder.master("local-cluster[2,1,512]").config("spark.executor.memory", "512m").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
jdbc.HELD_ROWS = 4
rows = lambda q: sorted(map(str, q.collect()))
assert rows(catalogue.QUERIES["cdc_upsert_jdbc"](spark, sys.argv[2])) == rows(catalogue.QUERIES["cdc_collapse"](spark, sys.argv[2])) != []
options = {"url": "jdbc:derby:memory:x;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "table_path": "t"}
df = spark.range(10).selectExpr("id", "IF(id = 3, NULL, CAST(id AS STRING)) AS name")
jdbc.prepare(df, options, "t")
assert jdbc.read(spark, options).count() == 0
jdbc.write(df, options, "t")
jdbc.write(df, {**options, "is_exactly_once": True}, "t")
assert rows(jdbc.read(spark, options)) == rows(df.union(df))
assert jdbc.read(spark, {"url": options["url"], "query": 'SELECT "id" FROM t WHERE "id" < 3'}).count() == 6
try:
    jdbc.prepare(df, {**options, "data_save_mode": "ERROR_WHEN_DATA_EXISTS"}, "t")
except SaveModeError:
    print("all is there")
"""


def test_embedded_database_on_a_cluster(tmp_path):
    """Executors are processes of their own there, so that only the driver reaches the database."""
    home = tmp_path / "home"  # executors' logs go to Spark's home
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYTHONPATH": str(Path(__file__).resolve().parent.parent), "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", ON_A_CLUSTER, f"file://{tmp_path}/shared", "/root/testdata/sf0.001"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all is there" in done.stdout, done.stderr[-4000:]


def test_jdbc_splits(spark, database):
    jdbc.execute(spark, database, "CREATE TABLE t (id BIGINT NOT NULL PRIMARY KEY, v DOUBLE)")
    jdbc.write(spark.range(100).selectExpr("id", "id * 0.5 AS v"), {**database, "primary_keys": ["id"]}, "t")
    assert jdbc.table_key(spark, database, "t") == ["ID"]
    one = jdbc.read(spark, {**database, "table_path": "t"})
    many = jdbc.read(spark, {**database, "table_path": "t", "split.size": 25})
    asked = jdbc.read(spark, {**database, "query": "SELECT * FROM t WHERE id < 50", "partition_column": "ID", "split.size": 25})
    assert [x.rdd.getNumPartitions() for x in (one, many, asked)] == [1, 4, 2]
    assert got(one) == got(many) and asked.count() == 50


def test_jdbc_save_modes(spark, database):
    rows = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(SaveModeError):
        jdbc.prepare(rows, {**database, "schema_save_mode": "ERROR_WHEN_SCHEMA_NOT_EXIST"}, "t")

    def save(**more):
        options = {**database, "table_path": "t", **more}
        jdbc.prepare(rows, options, "t")
        jdbc.write(rows, options, "t")
        return jdbc.read(spark, options).count()

    assert [save(), save(), save(data_save_mode="DROP_DATA"), save(), save(schema_save_mode="RECREATE_SCHEMA"), save(is_exactly_once=True)] == [1, 2, 1, 2, 1, 2]
    assert save(data_save_mode="CUSTOM_PROCESSING", custom_sql='DELETE FROM t WHERE "id" = 1') == 1
    with pytest.raises(SaveModeError):
        save(data_save_mode="ERROR_WHEN_DATA_EXISTS")


def fake(rows, fields="{ id = int, name = string }", key='primaryKey { name = "k", columnNames = ["id"] }'):
    kinds = {"+I": "INSERT", "-U": "UPDATE_BEFORE", "+U": "UPDATE_AFTER", "-D": "DELETE"}
    text = ", ".join(f'{{ kind = {kinds[k]}, fields = [{i}, {"null" if n is None else chr(34) + n + chr(34)}] }}' for i, n, k in rows)
    return f"FakeSource {{ schema = {{ fields {fields}\n {key} }}\n rows = [{text}] }}"


def test_job_writes_changes_by_the_key_of_its_schema(spark, database, tmp_path):
    heard = []
    job = run_job(spark, f"""env {{ job.mode = BATCH }}
source {{ {fake(CHANGES)} }}
transform {{ Sql {{ query = "SELECT id, UPPER(name) AS name FROM t" }} }}
sink {{ LocalFile {{ path = "{tmp_path}/a" }}
 Jdbc {{ url = "{database['url']}", driver = "{database['driver']}", table = "t" }} }}""", listener=lambda e, about: heard.append(e))
    want = {(i, n.upper()) for i, n in LEFT}
    assert got(spark.read.parquet(f"{tmp_path}/a")) == want
    assert got(jdbc.read(spark, {**database, "table_path": "t"})) == want
    assert heard[0] == "JOB_STARTED" and heard[-1] == "JOB_FINISHED" and heard.count("SINK_CLOSED") == 2 and job.id


def test_job_refuses_changes_without_a_key(spark, tmp_path):
    with pytest.raises(changes.ChangelogError):
        run_job(spark, f'env {{ job.mode = BATCH }}\nsource {{ {fake(CHANGES, key="")} }}\nsink {{ LocalFile {{ path = "{tmp_path}/a" }} }}')


def test_metrics_and_read_once(spark, tmp_path):
    job = run_job(spark, f"""env {{ job.mode = BATCH, read_limit.rows_per_second = 100000 }}
source {{ FakeSource {{ row.num = 25, schema = {{ fields {{ id = int }} }} }} }}
sink {{ LocalFile {{ path = "{tmp_path}/a", file_format_type = json, custom_filename = true, file_name_expression = "x_${{now}}", filename_time_format = "yyyy" }}
 LocalFile {{ path = "{tmp_path}/b" }}
 Assert {{ rules {{ row_rules = [{{ rule_type = MIN_ROW, rule_value = 25 }}] }} }} }}""")
    assert job.metrics["SinkWriteCount"] == {"LocalFile.source_0": 50, "Assert.source_0": 25}
    assert all(p.name.startswith("x_2") for p in (tmp_path / "a").glob("*.json"))
    assert spark.read.json(f"{tmp_path}/a").count() == 25


def test_shards_are_one_table(spark):
    tables = [f'{{ schema = {{ table = "s.t{i}", fields {{ id = int }} }}\n row.num = {i + 2} }}' for i in range(2)]
    job = run_job(spark, f"env {{ job.mode = BATCH }}\nsource {{ FakeSource {{ parsing_mode = SHARDING, tables_configs = [{', '.join(tables)}] }} }}\nsink {{ Assert {{ rules {{ row_rules = [{{ rule_type = MIN_ROW, rule_value = 5 }}, {{ rule_type = MAX_ROW, rule_value = 5 }}] }} }} }}")
    assert list(job.datasets["source_0"]) == ["s.t0"]


def test_streams_to_jdbc_and_goes_on_from_a_savepoint(spark, database, tmp_path):
    text = lambda env: f"""env {{ job.mode = STREAMING, checkpoint.path = "{tmp_path}/{env}"{', restore.from = "' + str(tmp_path) + '/saved"' if env == "two" else ""} }}
source {{ LocalFile {{ path = "{tmp_path}/in", file_format_type = json, schema = {{ fields {{ id = int, name = string }}\n primaryKey {{ columnNames = ["id"] }} }} }} }}
sink {{ Jdbc {{ url = "{database['url']}", driver = "{database['driver']}", table = "t", primary_keys = ["id"] }} }}"""  # noqa: E731
    (tmp_path / "in").mkdir()

    def put(name, *rows):
        (tmp_path / "in" / name).write_text("".join(f'{{"id": {i}, "name": "{n}"}}\n' for i, n in rows))

    put("a.json", (1, "a"), (2, "b"))
    first = run_job(spark, text("one"))
    first.results[0].awaitTermination(60)
    savepoint(first, f"{tmp_path}/saved")
    assert got(jdbc.read(spark, {**database, "table_path": "t"})) == {(1, "a"), (2, "b")}
    put("b.json", (2, "c"), (3, "d"))
    jdbc.execute(spark, database, "DELETE FROM t WHERE \"id\" = 1")  # would come back if the first file were read again
    second = run_job(spark, text("two"))
    second.results[0].awaitTermination(60)
    assert got(jdbc.read(spark, {**database, "table_path": "t"})) == {(2, "c"), (3, "d")}


def test_fake_stream(spark, tmp_path):
    job = run_job(spark, f"""env {{ job.mode = STREAMING, checkpoint.path = "{tmp_path}/c" }}
source {{ FakeSource {{ row.num = 7, schema = {{ fields {{ id = int, name = string }} }} }} }}
sink {{ LocalFile {{ path = "{tmp_path}/out" }} }}""")
    job.results[0].awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() % 7 == 0


@pytest.mark.parametrize("format", ["canal_json", "debezium_json", "maxwell_json", "ogg_json", "compatible_kafka_connect_json", "json"])
def test_broken_messages_fail_unless_ignored(spark, format):
    schema = spark.createDataFrame([], "id int, name string").schema
    good = {"canal_json": '{"type":"INSERT","data":[{"id":"1","name":"a"}]}', "debezium_json": '{"op":"c","after":{"id":1,"name":"a"}}', "maxwell_json": '{"type":"insert","data":{"id":1,"name":"a"}}', "ogg_json": '{"table":"d.t","op_type":"I","after":{"id":1,"name":"a"}}'}.get(format, '{"id":1,"name":"a"}')
    df = spark.createDataFrame([(good,), ("{broken",), (None,)], "value string")
    with pytest.raises(Exception, match=r"(?i)malformed"):
        connectors.decoded(df, format, schema).collect()
    assert [(r.id, r.name) for r in connectors.decoded(df, format, schema, ignore_parse_errors=True).collect()] == [(1, "a")]


def test_message_metadata(spark):
    schema = spark.createDataFrame([], "id int").schema
    df = spark.createDataFrame([('{"id": 1}', 3, 7)], "value string, partition int, offset long").withColumn("timestamp", F.timestamp_millis(F.lit(5000)))
    row = connectors.decoded(df, "json", schema).first()
    assert row.id == 1 and row._options["Partition"] == "3" and row._options["EventTime"] == "5000" and int(row._options["Delay"]) > 0
    assert cdc.canal(df, schema, ignore_parse_errors=True).count() == 0


def test_keys_live_as_long_as_their_columns(spark):
    df = with_key(with_key(spark.createDataFrame([(1, 2, "x")], "a int, b int, c string"), ["b", "a"]), ["c"], "u")
    assert keys(df) == {"primary_key": ["b", "a"], "u": ["c"]}
    assert primary_key(sql(df, "SELECT a AS x, b, UPPER(c) AS c FROM t")) == ["b", "x"]
    assert keys(sql(df, "SELECT a, c FROM t")) == {"u": ["c"]}


@pytest.mark.parametrize("query", ["SELECT TRIM('x' FROM s) AS v FROM t", "SELECT i FROM t WHERE s > 5", "SELECT i FROM t WHERE d <= '2024-01-01'", "SELECT i FROM t WHERE b < b"])
def test_refused(spark, query):
    df = spark.createDataFrame([], "i int, s string, d date, b boolean")
    with pytest.raises(SqlError):
        sql(df, query)


def test_trim_of_a_column(spark):
    df = spark.createDataFrame([("xax",)], "s string")
    assert sql(df, "SELECT TRIM(s FROM 'x') AS v, TRIM(s) AS w FROM t").first() == ("a", "xax")


def test_rules():
    check = rules.RULES.check
    for kind, plugin, options, fault in [
        ("source", "Jdbc", {"url": "u"}, "query, table_path"),
        ("source", "Jdbc", {"url": "u", "query": "q", "partition_lower_bound": 1}, "partition_upper_bound must come with"),
        ("source", "kafka", {"topic": "t"}, "bootstrap.servers is missing"),
        ("source", "Kafka", {"topic": "t", "bootstrap": {"servers": "s"}, "start_mode": "timestamp"}, "start_mode.timestamp is missing"),
        ("source", "Kafka", {"topic": "t", "bootstrap.servers": "s", "start_mode": "soon"}, "start_mode is soon"),
        ("source", "LocalFile", {"tables_configs": [{"path": "a"}, {"file_format_type": "csv"}]}, r"tables_configs\[1\]: path is missing"),
        ("sink", "Hive", {"table_name": "t", "data_save_mode": "CUSTOM_PROCESSING"}, "custom_sql is missing"),
        ("sink", "Jdbc", {"url": "u", "table": "t", "schema_save_mode": "NEVER"}, "schema_save_mode is NEVER"),
    ]:
        with pytest.raises(rules.OptionError, match=fault):
            check(kind, plugin, options)
    check("source", "Jdbc", {"url": "u", "table_list": [{"table_path": "a"}, {"query": "q"}]})
    check("sink", "Unknown", {})
    assert rules.OneOf(("a", "b")).faults({"a": 1, "b": 2}) == ["a and b exclude each other"]


def test_assert_rules(spark):
    from weftline.sources.sinks import assert_sink

    df = with_key(spark.createDataFrame([(1, [1, 2], {"a": 1, "b": 2}, (3, "x"))], "id int, l array<int>, m map<string,int>, r struct<a:int,b:string>"), ["id"])
    field = lambda name, value: [{"field_name": name, "field_value": [{"equals_to": value}]}]
    for name, value in (("l", [1, 2]), ("m", {"b": 2, "a": 1}), ("r", {"a": 3, "b": "x"})):
        assert assert_sink(df, field_rules=field(name, value)) == {"rows": 1}
    for name, value in (("l", [1]), ("m", {"a": 1}), ("r", {"a": 4, "b": "x"})):
        with pytest.raises(AssertFailed):
            assert_sink(df, field_rules=field(name, value))
    assert_sink(df, catalog_table_rule={"primary_key_rule": {"primary_key_columns": ["id"]}}, table_names=["a.b"], path="a.b")
    for bad in ({"primary_key_rule": {"primary_key_columns": ["l"]}}, {"column_rule": [{"name": "id", "type": "int"}]}):
        with pytest.raises(AssertFailed):
            assert_sink(df, catalog_table_rule=bad)


def test_inline_code_needs_leave(spark):
    job = """env { job.mode = BATCH%s }
source { FakeSource { row.num = 3, schema = { fields { id = int } } } }
transform { DynamicCompile { compile_language = PYTHON, source_code = \"\"\"
columns = {"twice": "bigint"}
def values(frame):
    return frame.assign(twice=frame["id"].astype("int64") * 2)
\"\"\" } }
sink { Assert { rules { field_rules = [{ field_name = twice, field_type = bigint, field_value = [{ rule_type = NOT_NULL }] }] } } }"""
    with pytest.raises(JobError, match="allow.inline.code"):
        run_job(spark, job % "")
    run_job(spark, job % ", allow.inline.code = true")
