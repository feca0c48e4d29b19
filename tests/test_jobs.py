"""Job files, their runner, connector options and date detection."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.datetimes import parse_date, parse_datetime, parse_time
from weftline.plans import config
from weftline.plans.job import JobError, run_job
from weftline.sources import connectors
from weftline.sources.sinks import AssertFailed

ROWS = 'schema = { fields { id = int, name = string } }\n rows = [ { kind = INSERT, fields = [1, "a"] }, { kind = INSERT, fields = [2, null] } ]'


def test_relaxed_notation():
    conf = config.parse('# note\nenv { job.mode = "BATCH", n = 1 // end\n f = 1.5\n url = "jdbc:x://h" }\nsource { A { a = [1, x y, true] }\n A { a += 1 } }\nt = """q "w" \\n"""')
    assert conf["env"] == {"job.mode": "BATCH", "n": 1, "f": 1.5, "url": "jdbc:x://h"}
    assert config.steps(conf["source"]) == [("A", {"a": [1, "x y", True]}), ("A", {"a": [1]})]
    assert conf["t"] == 'q "w" \\n'
    assert config.parse('{"a": {"b": [null, -2]}, "c": "\\u0041\\n"}') == {"a": {"b": [None, -2]}, "c": "A\n"}


@pytest.mark.parametrize("text", ["a { b = 1", 'a = "x', "a = [1", "a", "{a = 1} b = 2"])
def test_broken_files(text):
    with pytest.raises(config.ConfigError):
        config.parse(text)


def test_variables():
    conf = config.parse('a = ${x}\nb = "${y:d}_t"\nc = "${z:}"\nd = ${nope}', {"x": "p=1", "y": "v"})
    assert conf == {"a": "p=1", "b": "v_t", "c": "", "d": "${nope}"}


def test_job(spark, tmp_path):
    job = f"""
    env {{ job.mode = BATCH }}
    source {{ FakeSource {{ plugin_output = fake
      {ROWS} }} }}
    transform {{
      Sql {{ plugin_input = fake, plugin_output = s, query = "select id, name, id + 1 as n from fake where id > 1" }}
      FieldMapper {{ field_mapper {{ n = m, id = id }} }}
    }}
    sink {{
      LocalFile {{ path = "{tmp_path}/${{table_name}}", file_format_type = json }}
      Assert {{ plugin_input = [fake, fake], rules {{ row_rules = [ {{ rule_type = MIN_ROW, rule_value = 4 }} ] }} }}
    }}"""
    done = run_job(spark, job)
    assert done.results[1] == {"rows": 4}
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "fake")).select("m", "id").collect()] == [(3, 2)]


def test_sources_of_one_name_are_united(spark):
    job = f"source {{ FakeSource {{ plugin_output = f\n {ROWS} }}\n FakeSource {{ plugin_output = f\n {ROWS} }} }}\nsink {{ Assert {{ rules {{ row_rules = [ {{ rule_type = MAX_ROW, rule_value = 3 }} ] }} }} }}"
    with pytest.raises(AssertFailed):
        run_job(spark, job)


def test_sql_job(spark):
    job = """/* config
    env { parallelism = 1 }
    */
    CREATE TABLE a WITH ('connector'='FakeSource', 'type'='source',
      'schema' = '{ fields { id = "int", name = "string", c_time = "timestamp" } }',
      'rows' = '[ { fields = [21, "it''s; x", null], kind = INSERT }, { fields = [22, "Andy", "2020-01-02T03:04:05"], kind = INSERT } ]');
    -- a comment
    CREATE TABLE b AS SELECT id, name, CAST(null AS TIMESTAMP) AS c_time FROM a;
    INSERT INTO out SELECT id, name FROM b WHERE id > 21;
    INSERT INTO out SELECT a;
    CREATE TABLE out WITH ('connector'='Keep', 'type'='sink');"""
    kept = []
    run_job(spark, job, plugins={"Keep": lambda job, df, path, options: kept.append(sorted(tuple(r)[:2] for r in df.drop("_row_kind").collect()))})
    assert kept == [[(22, "Andy")], [(21, "it's; x"), (22, "Andy")]]


@pytest.mark.parametrize("job", ["source { Nope {} }", f"source {{ FakeSource {{ {ROWS} }} }}\ntransform {{ Nope {{}} }}", f"source {{ FakeSource {{ {ROWS} }} }}\nsink {{ Console {{ plugin_input = x }} }}", f"source {{ FakeSource {{ {ROWS} }} }}\ntransform {{ LLM {{ prompt = p }} }}"])
def test_jobs_that_do_not_fit(spark, job):
    with pytest.raises(JobError):
        run_job(spark, job)


def test_streaming_job(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    job = f"""env {{ job.mode = STREAMING, checkpoint.path = "{tmp_path}/cp" }}
    source {{ LocalFile {{ path = "{tmp_path}/in", schema {{ fields {{ id = bigint }} }} }} }}
    sink {{ LocalFile {{ path = "{tmp_path}/out" }} }}"""
    for query in run_job(spark, job).results:
        query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_connector_options():
    read = connectors.jdbc_read({"url": "u", "table_path": "t", "where_condition": "where a > 1", "partition_column": "id", "partition_lower_bound": 0, "partition_upper_bound": 9, "partition_num": 3, "fetch_size": 5})
    assert read == {"url": "u", "fetchsize": "5", "dbtable": "(SELECT * FROM t where a > 1) q", "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    assert connectors.kafka_read({"bootstrap.servers": "b", "topic": "a-b", "start_mode": "specific_offsets", "start_mode.offsets": {"a-b-0": 7}})["startingOffsets"] == '{"a-b": {"0": 7}}'
    with pytest.raises(ValueError, match="partition_lower_bound"):
        connectors.jdbc_read({"url": "u", "query": "q", "partition_column": "id"})


def test_messages(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, "x"), (2, None)], schema)
    back = connectors.decoded(connectors.encoded(df, "json", ["a"]), "json", schema)
    assert sorted(back.collect()) == sorted(df.collect())
    assert connectors.decoded(connectors.encoded(df, "text"), "text", schema).filter("a = 1").first().b == "x"


def test_detected_dates(spark):
    when = dt.datetime(2020, 10, 10, 10, 10, 10)
    texts = ["2020-10-10 10:10:10", "2020-10-10T10:10:10", "2020/10/10 10:10:10", "2020年10月10日 10时10分10秒", "2020.10.10 10:10:10", "20201010101010"]
    odd = {"2020/1/1 10:10": dt.datetime(2020, 1, 1, 10, 10), "2020-10-10 10:10:10.201111001": when.replace(microsecond=201111), "2020-10-10 10:10:10.201": when.replace(microsecond=201000), "x": None, "2020-13-01 00:00:00": None}
    got = spark.createDataFrame([(t,) for t in [*texts, *odd]], "t string").select("t", parse_datetime(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in got} == {**dict.fromkeys(texts, when), **odd}
    assert spark.sql("select '2020年1月2日' t").select(parse_date(F.col("t"))).first()[0] == dt.date(2020, 1, 2)


def test_command_line(tmp_path, capsys):
    from weftline.__main__ import main, shaded, shown

    job = tmp_path / "j.conf"
    job.write_text('env { job.mode = BATCH }\nsource { Jdbc { url = "${u}", user = me, password = "pä" } }\nsink { Console {} }')
    assert main(["-c", str(job), "--check", "-i", "u=jdbc:x"]) == 1 and "query, table_path" in capsys.readouterr().out
    assert main(["-c", str(job), "--encrypt"]) == 0
    hidden = capsys.readouterr().out
    assert "pä" not in hidden and '"me"' not in hidden
    conf = config.load(str(job), {})
    assert shown(shaded(conf)) == conf


def test_http_options_are_redacted(spark):
    from weftline.sources import http

    spark.dataSource.register(http.HttpSource)
    plan = spark.read.format(http.FORMAT).option(http.SECRET, '{"url": "http://x", "headers": {"Authorization": "hide-me"}}').load()._jdf.queryExecution().toString()
    assert "hide-me" not in plan


def test_times_of_day(spark):
    texts = ["00:00:00", "23:59:59.999", "12:34:56", "24:00:00", "12:60:00", "1:02:03", "12:34", "12:34:56.7", "", None]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_time(F.col("t")).alias("v")).collect()]
    assert got == [dt.timedelta(0), dt.timedelta(hours=23, minutes=59, seconds=59, milliseconds=999), dt.timedelta(hours=12, minutes=34, seconds=56), *[None] * 7]
