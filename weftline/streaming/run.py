"""Streaming: transforms over readStream, with idempotent writes by batch id."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def stream_files(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format(format).schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def write_files(df: DataFrame, path: str, checkpoint: str, interval: str | None = None, format: str = "parquet") -> StreamingQuery:
    """The file sink's commit log makes a batch that is written twice count once."""
    writer = df.writeStream.format(format).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(path)


def write_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """`write` gets each batch with its id, and must give the same result if it gets one again."""
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def watch(query: StreamingQuery, timeout: float, told: Callable[[str], None]) -> threading.Thread:
    """Stops a query whose batch has run for longer than `timeout` seconds, and tells of it.

    The batch is not in the checkpoint then, so a query that starts again begins with it.
    """

    def look() -> None:
        batch, since = None, time.monotonic()
        while query.isActive:
            time.sleep(min(1.0, timeout / 5))
            done = query.lastProgress
            now = (done["batchId"] if done else None, query.status["isTriggerActive"])
            if now != batch or not now[1]:
                batch, since = now, time.monotonic()
            elif time.monotonic() - since > timeout:
                told(f"a batch of {query.name or query.id} ran for more than {timeout} s")
                query.stop()
                return

    thread = threading.Thread(target=look, daemon=True)
    thread.start()
    return thread


class Counters(StreamingQueryListener):
    """Rows and rates of one query, as its batches end; a batch that is tried again tells of itself once, when it ends."""

    def __init__(self, query: StreamingQuery, metrics: dict, name: str):
        self.id, self.metrics, self.name = str(query.id), metrics, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.id) != self.id or not p.numInputRows:
            return
        count = self.metrics.setdefault("SourceReceivedCount", {})
        count[self.name] = count.get(self.name, 0) + p.numInputRows
        self.metrics.setdefault("SourceReceivedQPS", {})[self.name] = p.inputRowsPerSecond
        self.metrics.setdefault("SinkWriteQPS", {})[self.name] = p.processedRowsPerSecond

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def throttled(df: DataFrame, rows_per_second: int) -> DataFrame:
    """`df` with its tasks slowed down, so that those that run side by side give about this many rows a second in all."""
    slots = max(1, df.sparkSession.sparkContext.defaultParallelism)
    each = max(1.0, rows_per_second / slots)

    def run(batches):
        begin, given = time.monotonic(), 0
        for b in batches:
            for at in range(0, b.num_rows, max(1, int(each))):
                part = b.slice(at, max(1, int(each)))
                wait = begin + given / each - time.monotonic()
                if wait > 0:
                    time.sleep(wait)
                given += part.num_rows
                yield part

    return df.mapInArrow(run, df.schema)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """A copy of a folder on any file system Hadoop knows; what was at the target goes."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    a, b = hadoop.Path(source), hadoop.Path(target)
    b.getFileSystem(conf).delete(b, True)
    if not hadoop.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf):
        raise OSError(f"cannot copy {source} to {target}")


def restore(spark: SparkSession, savepoint: str, checkpoint: str) -> None:
    copy_folder(spark, savepoint, checkpoint)
