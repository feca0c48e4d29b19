"""Change capture over logs of Debezium messages: starts, stops, hand-over, restarts, jobs."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import types as T

from weftline.plans import job
from weftline.plans.rules import OptionError
from weftline.sources import capture, cdc
from weftline.sources.capture import Place

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
SHAPE = "id long, name string"


def message(pos, op, i, before=None, after=None, file="b.1", table="t", **more):
    row = lambda n: None if n is None else {"id": i, "name": n}
    return json.dumps({"op": op, "before": row(before), "after": row(after), "source": {"db": "d", "table": table, "file": file, "pos": pos, "ts_ms": pos * 1000, **more}})


def log(tmp_path, *lines, name=None):
    (tmp_path / "log").mkdir(exist_ok=True)
    (tmp_path / "log" / (name or uuid.uuid4().hex)).write_text("\n".join(lines) + "\n")
    return str(tmp_path / "log")


LINES = [message(1, "c", 1, after="a"), message(2, "c", 2, after="b"), message(3, "u", 1, "a", "c"), message(4, "d", 2, "b"), message(1, "c", 3, after="d", file="b.2"), message(9, "c", 1, after="other", file="b.2", table="x")]


def places(df):
    return sorted((r["_at"].file, r["_at"].pos, r["_row_kind"], r.id, r.name) for r in df.collect())


def test_starts_and_stops(spark, tmp_path):
    path = log(tmp_path, *LINES)
    take = lambda **o: places(capture.capture(spark, path, SCHEMA, ["id"], {k.replace("__", ".").replace("_offset", "-offset"): v for k, v in o.items()}, str(tmp_path / uuid.uuid4().hex), table="d.t"))
    every = take(startup__mode="earliest")
    assert len(every) == 6 and every[-1] == ("b.2", 1, "+I", 3, "d")
    assert take(startup__mode="latest") == []
    assert take(startup__mode="specific", startup__specific_offset__file="b.1", startup__specific_offset__pos=3) == every[2:]
    assert take(startup__mode="earliest", stop__mode="specific", stop__specific_offset__file="b.1", stop__specific_offset__pos=2) == every[:2]
    assert take(startup__mode="earliest", stop__mode="latest") == every
    assert {r[1] for r in take(startup__mode="timestamp", startup__timestamp=2000, stop__mode="timestamp", stop__timestamp=3000)} == {2, 3}
    assert capture.last_place(spark, path) == Place("b.2", 9) and capture.last_place(spark, str(tmp_path / "none")) == capture.NOWHERE
    for bad in ({"startup.mode": "now"}, {"startup.mode": "earliest", "stop.mode": "soon"}, {"startup.mode": "specific"}, {}):
        with pytest.raises(capture.CaptureError):
            capture.capture(spark, path, SCHEMA, [], bad, str(tmp_path / uuid.uuid4().hex))


def test_hand_over(spark):
    """Rows are right whether they were read before or after each change between the marks."""
    lines = [message(1, "u", 1, "old", "new"), message(2, "c", 2, after="two"), message(3, "d", 3, "three"), message(4, "c", 4, after="x"), message(5, "d", 4, "x"), message(6, "u", 5, "five", "later")]
    events = capture.decoded(spark.createDataFrame([(x,) for x in lines], "value string"), SCHEMA)
    for rows in ([(1, "old"), (3, "three"), (5, "five"), (9, "still")], [(1, "new"), (2, "two"), (5, "five"), (9, "still")], [(1, "old"), (2, "two"), (3, "three"), (4, "x"), (5, "later"), (9, "still")]):
        out = capture.hand_over(spark.createDataFrame(rows, SHAPE), events, ["id"], Place("b.1", 0), Place("b.1", 5))
        left = {r.id: r.name for r in out.collect()}
        assert left == {1: "new", 2: "two", 5: "later" if (5, "later") in rows else "five", 9: "still"}
        assert {r["_row_kind"] for r in out.collect()} == {"+I"}


def test_initial_is_read_once(spark, tmp_path):
    path, folder, reads = log(tmp_path, *LINES[:2]), str(tmp_path / "f"), []

    def read():
        reads.append(1)
        log(tmp_path, *LINES[2:4])
        return spark.createDataFrame([(1, "a"), (2, "b"), (7, "g")], SHAPE)

    for more, want in (((), [(1, "c"), (7, "g")]), (LINES[4:], [(1, "c"), (3, "d"), (7, "g")])):
        if more:
            log(tmp_path, *more)
        df = capture.capture(spark, path, SCHEMA, ["id"], {}, folder, read, "t")
        assert sorted((r.id, r.name) for r in cdc.collapse(df, ["id"], []).drop("_table").collect()) == want
    assert reads == [1]


def test_a_job_goes_on_where_it_stopped(spark, tmp_path):
    database = {"url": f"jdbc:derby:memory:c{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.createDataFrame([(1, "a"), (2, "b"), (7, "g")], SHAPE).write.format("jdbc").options(**database, dbtable="t").save()
    path = log(tmp_path, *LINES[:2])
    source = {"plugin_name": "MySQL-CDC", "base-url": database["url"], "driver": database["driver"], "table-names": ["t"], "log.path": path, "schema": {"fields": {"id": "bigint", "name": "string"}, "primaryKey": {"columnNames": ["id"]}}}
    sink = {"plugin_name": "LocalFile", "path": str(tmp_path / "out"), "file_format_type": "parquet", "primary_keys": ["id"], "bucket_num": 2}
    whole = {"env": {"job.mode": "STREAMING", "checkpoint.path": str(tmp_path / "checkpoint")}, "source": [source], "sink": [sink]}
    from weftline.sources import buckets

    for lines, want in (((), [(1, "a"), (2, "b"), (7, "g")]), (LINES[2:4], [(1, "c"), (7, "g")]), (LINES[4:], [(1, "c"), (3, "d"), (7, "g")])):
        if lines:
            log(tmp_path, *lines)
        now = job.run_job(spark, whole)
        for q in now.results:
            q.awaitTermination()
        assert sorted((r.id, r.name) for r in buckets.read(spark, str(tmp_path / "out")).collect()) == want


def test_options():
    from weftline.plans import rules

    with pytest.raises(OptionError, match="log.path"):
        rules.RULES.check("source", "MySQL-CDC", {})
    with pytest.raises(OptionError, match="specific-offset.pos"):
        rules.RULES.check("source", "PostgreSQL-CDC", {"log.path": "x", "startup.mode": "specific"})
