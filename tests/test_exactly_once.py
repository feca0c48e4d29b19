"""Streams whose rows come once, though they are stopped anywhere."""

from __future__ import annotations

import sqlite3
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from weftline.plans import job
from weftline.sources import jdbc
from weftline.streaming import increasing

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def files(spark, path, low, high):
    spark.range(low, high).select("id", F.concat(F.lit("n"), "id").alias("name")).coalesce(2).write.mode("append").parquet(path)


def streamed(tmp_path, options):
    source = {"plugin_name": "LocalFile", "path": str(tmp_path / "in"), "file_format_type": "parquet", "schema": {"fields": {"id": "bigint", "name": "string"}}}
    return {"env": {"job.mode": "STREAMING", "checkpoint.path": str(tmp_path / "checkpoint")}, "source": [source], "sink": [{"plugin_name": "Jdbc", "table": "t", **options}]}


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_stream_killed_around_its_commit(spark, tmp_path, monkeypatch, when):
    """Rows without a key, staged but not applied, or applied but not noted by Spark, are in the table once after a restart."""
    options = {"url": f"jdbc:derby:memory:e{uuid.uuid4().hex};create=true", "driver": DERBY}
    path, real, failed = str(tmp_path / "in"), jdbc.execute, []

    def killed(s, o, *statements):
        if not failed and any(x.startswith("INSERT INTO t") for x in statements):
            failed.append(1)
            if when == "after":
                real(s, o, *statements)
            raise RuntimeError("killed")
        real(s, o, *statements)

    files(spark, path, 0, 50)
    monkeypatch.setattr(jdbc, "execute", killed)
    with pytest.raises(StreamingQueryException, match="killed"):
        job.run_job(spark, streamed(tmp_path, options)).results[0].awaitTermination()
    for low in (50, 70):
        job.run_job(spark, streamed(tmp_path, options)).results[0].awaitTermination()
        got = sorted(r[0] for r in jdbc.read(spark, {**options, "table_path": "t"}).collect())
        assert got == list(range(low)), when
        files(spark, path, low, low + 20)
    assert failed == [1]


def test_a_batch_counts_once_for_each_writer(spark):
    options = {"url": f"jdbc:derby:memory:e{uuid.uuid4().hex};create=true", "driver": DERBY}
    rows = spark.createDataFrame([(1,), (1,)], "id long")
    jdbc.prepare(rows, options, "t")
    for writer, epoch in (("a", 0), ("a", 0), ("b'c", 0), ("a", 1), ("a", 0), ("b'c", 0)):
        jdbc.write(rows, options, "t", writer, epoch)
    assert jdbc.read(spark, {**options, "table_path": "t"}).count() == 6
    assert jdbc.epoch_of(spark, options, "a") == 1 and jdbc.epoch_of(spark, options, "b'c") == 0 and jdbc.epoch_of(spark, options, "z") is None


def test_an_increasing_table(spark, tmp_path):
    """Ranges are read by tasks, and a stream goes on after its last key."""
    path = str(tmp_path / "d.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, name TEXT, v REAL)")
        c.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, f"n{i}" if i % 5 else None, i / 2) for i in range(10, 110)])
    source = {"plugin_name": "Jdbc", "url": "jdbc:sqlite:x", "dbapi": {"module": "sqlite3", "connect": {"database": path}}, "table_path": "t", "partition_column": "id", "split": {"size": 30}, "schema": {"fields": {"id": "bigint", "name": "string", "v": "double"}}}
    whole = {"env": {"job.mode": "STREAMING", "checkpoint.path": str(tmp_path / "checkpoint")}, "source": [source], "sink": [{"plugin_name": "LocalFile", "path": str(tmp_path / "out"), "file_format_type": "parquet"}]}
    for high in (110, 110, 150):
        with sqlite3.connect(path) as c:
            c.executemany("INSERT OR IGNORE INTO t VALUES (?, ?, ?)", [(i, f"n{i}" if i % 5 else None, i / 2) for i in range(10, high)])
        job.run_job(spark, whole).results[0].awaitTermination()
        out = spark.read.parquet(str(tmp_path / "out"))
        assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == [(i, f"n{i}" if i % 5 else None, i / 2) for i in range(10, high)]
    assert len(list((tmp_path / "out").glob("*.parquet"))) >= 4 + 2


def test_ranges_and_names(tmp_path):
    path = str(tmp_path / "d.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE t (id INTEGER)")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType())])
    given = {"dbapi.module": "sqlite3", "dbapi.connect": f'["{path}"]', "table": "t", "column": "id", "split.size": "10", "lag": "5"}
    reader = increasing.IncreasingReader(given, schema)
    assert reader.initialOffset() == reader.latestOffset() == {"last": -1} and reader.partitions({"last": 3}, {"last": 3}) == []
    assert [(p.after, p.last) for p in reader.partitions({"last": 0}, {"last": 25})] == [(0, 8), (8, 16), (16, 25)]
    with sqlite3.connect(path) as c:
        c.executemany("INSERT INTO t VALUES (?)", [(i,) for i in range(7, 30)])
    assert reader.initialOffset() == {"last": 6} and reader.latestOffset() == {"last": 24}
    assert [b.column(0).to_pylist() for b in reader.read(increasing.Range(6, 9))] == [[7, 8, 9]]
    with pytest.raises(ValueError, match="plain name"):
        increasing.IncreasingReader({**given, "table": "t; DROP TABLE t"}, schema)
    with pytest.raises(ValueError, match="array"):
        increasing.IncreasingReader(given, T.StructType([T.StructField("a", T.ArrayType(T.LongType()))]))
