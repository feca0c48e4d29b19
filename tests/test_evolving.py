"""Tables whose columns change, kept in files and in JDBC tables; a rerun alters nothing twice."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import types as T

from weftline.plans import evolution, job
from weftline.plans.evolution import Change
from weftline.sources import buckets, jdbc
from weftline.sources.capture import Place
from weftline.streaming import evolving

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
FIRST = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("name", T.StringType())])


def row(pos, op, **fields):
    return json.dumps({"op": op, ("before" if op == "d" else "after"): fields, "source": {"db": "d", "table": "t", "file": "b", "pos": pos}})


def told(pos, *changes, **more):
    return json.dumps({"op": "schema", "changes": list(changes), "source": {"table": "t", "file": "b", "pos": pos}, **more})


PARTS = [
    [row(1, "c", id=1, n=1, name="a"), row(2, "c", id=2, n=2, name="b"), row(3, "c", id=3, n=3, name="c")],
    [told(4, {"kind": "rename", "name": "name", "to": "label"}, {"kind": "add", "name": "more", "type": "double"}), row(5, "c", id=4, n=4, label="d", more=0.5), row(6, "u", id=1, n=9, label="z", more=1.5)],
    [row(8, "c", id=5, n=1 << 40, more=2.5), told(7, columns=[{"name": "id", "type": "bigint"}, {"name": "n", "type": "bigint"}, {"name": "more", "type": "double"}]), row(9, "d", id=2, n=2)],
]
WANT = [[(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], [(1, 9, "z", 1.5), (2, 2, "b", None), (3, 3, "c", None), (4, 4, "d", 0.5)], [(1, 9, 1.5), (3, 3, None), (4, 4, 0.5), (5, 1 << 40, 2.5)]]


def append(tmp_path, lines):
    (tmp_path / "log").mkdir(exist_ok=True)
    (tmp_path / "log" / uuid.uuid4().hex).write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize("kind", ["files", "jdbc"])
@pytest.mark.parametrize("steps", [(1, 2, 3), (3,)])
def test_targets_follow(spark, tmp_path, kind, steps, monkeypatch):
    """In batches of their own, or all in one, where the target is made as the newest version."""
    database = {"url": f"jdbc:derby:memory:v{uuid.uuid4().hex};create=true", "driver": DERBY, "primary_keys": ["id"]}
    altered, real = [], jdbc.execute
    monkeypatch.setattr(jdbc, "execute", lambda s, o, *x: (altered.extend(y for y in x if y.startswith(("ALTER", "RENAME"))), real(s, o, *x)))
    done = 0
    for step in steps:
        for part in PARTS[done:step]:
            append(tmp_path, part)
        done = step
        for _ in range(2):  # the second time there is nothing new
            target = evolving.BucketTarget(spark, str(tmp_path / "t"), ["id"], "w", 3) if kind == "files" else evolving.JdbcTarget(spark, database, "t", "w")
            evolving.follow(spark, str(tmp_path / "log"), FIRST, str(tmp_path / "marks"), target, str(tmp_path / "checkpoint"), "d.t").awaitTermination()
        out = buckets.read(spark, str(tmp_path / "t")) if kind == "files" else jdbc.read(spark, {**database, "table_path": "t"})
        names = ["id", "n", *{1: ["name"], 2: ["label", "more"], 3: ["more"]}[step]]
        assert sorted(tuple(r[n] for n in map(str, names)) for r in out.collect()) == WANT[step - 1]
        assert sorted(c.lower() for c in out.columns) == sorted(names)
    versions = evolving.versions(spark, str(tmp_path / "marks"))
    assert [v.place.pos for v in versions] == [-1, 4, 7] and versions[2].schema == T.StructType.fromDDL("id bigint, n bigint, more double")
    if kind == "jdbc" and len(steps) == 3:
        assert len(altered) == len(set(altered)) and sum("ADD" in a for a in altered) == 2 and jdbc.epoch_of(spark, database, "schema:t") == 2
    if kind == "files" and len(steps) == 3:
        assert buckets.manifest(spark, str(tmp_path / "t"))["evolved"] == 2 and buckets.read(spark, str(tmp_path / "t"), 1).columns == ["id", "n", "name"]


def test_a_job_with_rows_before_the_log(spark, tmp_path):
    database = {"url": f"jdbc:derby:memory:v{uuid.uuid4().hex};create=true", "driver": DERBY}
    spark.createDataFrame([(1, 1, "a"), (7, 7, "g")], FIRST).write.format("jdbc").options(**database, dbtable="t").save()
    append(tmp_path, PARTS[0][:1])
    source = {"plugin_name": "MySQL-CDC", "base-url": database["url"], "driver": DERBY, "table-names": ["t"], "log.path": str(tmp_path / "log"), "schema-changes.enabled": True, "schema": {"fields": {"id": "bigint", "n": "int", "name": "string"}, "primaryKey": {"columnNames": ["id"]}}}
    sink = {"plugin_name": "Jdbc", **database, "table": "copy"}
    whole = {"env": {"job.mode": "STREAMING", "checkpoint.path": str(tmp_path / "checkpoint")}, "source": [source], "sink": [sink]}
    for lines, want in (((), {(1, "a"), (7, "g")}), (PARTS[1], {(1, "z"), (4, "d"), (7, "g")}), ((), {(1, "z"), (4, "d"), (7, "g")})):
        if lines:
            append(tmp_path, lines)
        job.run_job(spark, whole).results[0].awaitTermination()
        out = jdbc.read(spark, {**database, "table_path": "copy"})
        assert {(r[0], r["label" if "label" in out.columns else "name"]) for r in out.collect()} == want
    with pytest.raises(job.JobError, match="no part"):
        job.run_job(spark, {**whole, "transform": [{"plugin_name": "Copy", "fields": {"x": "n"}}]})
    with pytest.raises(job.JobError, match="cannot follow"):
        job.run_job(spark, {**whole, "sink": [{"plugin_name": "LocalFile", "path": str(tmp_path / "x")}]})


def test_changes_that_do_not_fit(spark):
    for bad in (Change("add", "n", type="int"), Change("drop", "x"), Change("rename", "n", "id"), Change("modify", "id", type="int"), Change("modify", "name", type="int")):
        with pytest.raises(evolution.EvolutionError):
            evolution.schema_after(FIRST, [bad])
    with pytest.raises(evolution.EvolutionError):
        Change.of({"kind": "truncate", "name": "n"})
    wide = [("int", "bigint"), ("int", "double"), ("bigint", "decimal(19,0)"), ("float", "double"), ("decimal(5,2)", "decimal(8,3)"), ("date", "timestamp"), ("double", "string")]
    narrow = [("bigint", "int"), ("bigint", "double"), ("decimal(5,2)", "decimal(5,3)"), ("string", "int"), ("double", "float")]
    assert all(evolution.wider(evolution.data_type(a), evolution.data_type(b)) for a, b in wide) and not any(evolution.wider(evolution.data_type(a), evolution.data_type(b)) for a, b in narrow)
    assert Place("b.1", 9) < Place("b.2", 1)
