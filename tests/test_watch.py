"""Counters of jobs, and batches that overrun."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from weftline.plans import job


def source(tmp_path, n):
    return {"plugin_name": "LocalFile", "path": str(tmp_path / "in"), "file_format_type": "parquet", "schema": {"fields": {"id": "bigint", "name": "string"}}}


def files(spark, tmp_path, n):
    spark.range(n).select("id", F.lit("abé").alias("name")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_counts_bytes_and_rates(spark, tmp_path):
    files(spark, tmp_path, 100)
    done = job.run_job(spark, {"source": [source(tmp_path, 1)], "sink": [{"plugin_name": "LocalFile", "path": str(tmp_path / "out"), "file_format_type": "parquet"}]})
    of = {k: next(iter(v.values())) for k, v in done.metrics.items()}
    assert of["SinkWriteCount"] == 100 and of["SinkWriteBytes"] == 100 * (8 + 4)
    assert 0 < of["SinkWriteQPS"] < 100_000 and abs(of["SinkWriteBytesPerSeconds"] / of["SinkWriteQPS"] - 12) < 1e-6


def test_a_stream_counts_its_batches(spark, tmp_path):
    files(spark, tmp_path, 30)
    now = job.run_job(spark, {"env": {"job.mode": "STREAMING", "checkpoint.path": str(tmp_path / "c")}, "source": [source(tmp_path, 1)], "sink": [{"plugin_name": "LocalFile", "path": str(tmp_path / "out"), "file_format_type": "parquet"}]})
    now.results[0].awaitTermination()
    end = time.monotonic() + 20
    while "SourceReceivedCount" not in now.metrics and time.monotonic() < end:
        time.sleep(0.2)
    assert list(now.metrics["SourceReceivedCount"].values()) == [30] and "SinkWriteQPS" in now.metrics


def test_a_stalled_sink_is_stopped(spark, tmp_path):
    """The job fails after the timeout; started again it does what was left."""
    files(spark, tmp_path, 7)
    got, waits = [], [60]

    def slow(j, df, path, options):
        n = df.count()
        end = time.monotonic() + (waits.pop() if waits else 0)
        while time.monotonic() < end:
            time.sleep(0.2)
        got.append(n)

    whole = {"env": {"job.mode": "STREAMING", "checkpoint.path": str(tmp_path / "c"), "checkpoint.timeout": 3000}, "source": [source(tmp_path, 1)], "sink": [{"plugin_name": "slow"}]}
    begin = time.monotonic()
    now = job.run_job(spark, whole, plugins={"slow": slow})
    while now.results[0].isActive and time.monotonic() - begin < 45:
        time.sleep(0.5)
    assert time.monotonic() - begin < 45 and now.events[-1][0] == "JOB_FAILED" and "more than 3.0 s" in now.events[-1][1]
    got.clear()
    job.run_job(spark, whole, plugins={"slow": slow}).results[0].awaitTermination()
    assert got[-1] == 7
