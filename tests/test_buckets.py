"""Buckets: only those that changes touch are written, and readers see one manifest."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.plans import job
from weftline.sources import buckets, changes

SCHEMA = "id long, name string, at long, _row_kind string"


def rows(df):
    return sorted((r.id, r.name) for r in df.collect())


def folders(path):
    return {p.name for p in path.iterdir() if not p.name.startswith(("_", "."))}


def test_few_changes_write_few_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.range(2000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.lit(0).cast("long").alias("at"), F.lit("+I").alias("_row_kind"))
    assert buckets.upsert(start, path, ["id"], ["at"], 256) == list(range(256))
    before = buckets.manifest(spark, path)
    batch = spark.createDataFrame([(i, "new", 1, "+U") for i in range(0, 2000, 100)], SCHEMA)
    touched = buckets.upsert(batch, path, ["id"], ["at"])
    after = buckets.manifest(spark, path)
    assert 1 <= len(touched) <= 20 and {b for b in before["folders"] if before["folders"][b] != after["folders"][b]} == set(map(str, touched))
    assert len(list((tmp_path / "t" / after["folders"][str(touched[0])][0]).glob("_bucket=*"))) == len(touched)
    want = sorted((i, "new" if i % 100 == 0 else f"n{i}") for i in range(2000))
    assert rows(buckets.read(spark, path)) == want
    assert rows(buckets.read(spark, path, 1)) == sorted((i, f"n{i}") for i in range(2000))


def test_kinds_batches_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        buckets.read(spark, path)
    first = spark.createDataFrame([(1, "a", 1, "+I"), (None, "n", 1, "+I"), (2, "b", 1, "+I"), (2, "x", 2, "-U"), (2, "c", 2, "+U"), (3, "d", 1, "+I")], SCHEMA)
    second = spark.createDataFrame([(1, "a", 3, "-D"), (None, "m", 3, "+U"), (4, "e", 3, "+I")], SCHEMA)
    for batch in (0, 0, 1, 1, 0):
        buckets.upsert((first, second)[batch], path, ["id"], ["at"], 4, writer="w", batch=batch)
    left = {(None, "m"), (2, "c"), (3, "d"), (4, "e")}
    assert {(r.id, r.name) for r in buckets.read(spark, path).collect()} == left
    assert buckets.manifest(spark, path)["version"] == 2 and buckets.manifest(spark, path)["batches"] == {"w": 1}
    (tmp_path / "t" / "half").mkdir()  # what a writer that failed left behind
    assert buckets.vacuum(spark, path, 1) >= 1 and "half" not in folders(tmp_path / "t")
    assert {(r.id, r.name) for r in buckets.read(spark, path).collect()} == left
    with pytest.raises(changes.ChangelogError):
        buckets.upsert(first, path, ["name"])
    assert buckets.upsert(first.limit(0), path, ["id"]) == [] and {(r.id, r.name) for r in buckets.read(spark, path).collect()} == left


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.upsert(spark.createDataFrame([(1, "a", 1, "+I")], SCHEMA), path, ["id"])
    at = buckets.manifest(spark, path)
    with pytest.raises(buckets.ConflictError):
        buckets._put(spark, path, at)
    assert buckets.manifest(spark, path) == at


def test_a_deleted_bucket_is_gone(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.upsert(spark.createDataFrame([(1, "a", 1, "+I")], SCHEMA), path, ["id"], buckets=1)
    buckets.upsert(spark.createDataFrame([(1, "a", 2, "-D")], SCHEMA), path, ["id"])
    assert buckets.read(spark, path).columns == ["id", "name", "at"] and buckets.read(spark, path).count() == 0


def test_jobs(spark, tmp_path):
    path = str(tmp_path / "t")
    source = {"plugin_name": "FakeSource", "schema": {"fields": {"id": "bigint", "name": "string"}}, "rows": [{"kind": "INSERT", "fields": [1, "a"]}, {"kind": "UPDATE_AFTER", "fields": [1, "b"]}]}
    sink = {"plugin_name": "LocalFile", "path": path, "file_format_type": "parquet", "primary_keys": ["id"], "bucket_num": 2}
    job.run_job(spark, {"source": [source], "sink": [sink]})
    back = job.run_job(spark, {"source": [{"plugin_name": "LocalFile", "path": path, "file_format_type": "parquet", "bucketed": True, "plugin_output": "x"}], "sink": [{"plugin_name": "Console"}]})
    assert rows(next(iter(back.datasets["x"].values()))) == [(1, "b")]


@pytest.mark.parametrize("parts", [1, 7])
def test_images_of_one_time(spark, parts):
    """The image after an update counts, however the rows are dealt."""
    pairs = [(i, t, 5, k) for i in range(20) for t, k in (("old", "-U"), ("new", "+U"))] + [(30, "gone", 5, "-D"), (30, "back", 5, "+I"), (31, "x", 4, "+I"), (31, "x", 5, "-D")]
    df = spark.createDataFrame(pairs, SCHEMA).repartition(parts, "_row_kind")
    last = {r.id: (r.name, r["_row_kind"]) for r in changes.last_changes(df, ["id"], ["at"]).collect()}
    assert last == {**{i: ("new", "+U") for i in range(20)}, 30: ("back", "+I"), 31: ("x", "-D")}
