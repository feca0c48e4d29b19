"""Vectorised text primitives shared by the operators of this subpackage.

Everything here works on the UTF-8 buffer of an Arrow string column, in chunks
of a few megabytes, so one Python call handles thousands of documents and the
memory of a worker does not depend on the length of a batch.  The delimiters
of words (space and 0x09-0x0D) are ASCII, so cutting at bytes is exact.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Documents are handled in runs of about this many bytes.
CHUNK_BYTES = 1 << 20

WS = np.zeros(256, bool)
WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CONT = (np.arange(256) & 0xC0) == 0x80
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_MASK = (1 << 64) - 1


def splitmix(x: int) -> int:
    """One step of the splitmix64 generator, on Python integers."""
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


_TABLE = np.array([splitmix(i + 1) for i in range(256)], dtype=np.uint64)
_P = 0xD1342543DE82EF95
_PINV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["p"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("p", _P), ("i", _PINV)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _powers[key] = np.multiply.accumulate(a)
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of any spans of a byte buffer, from one prefix sum."""

    def __init__(self, buf: np.ndarray):
        self.pow, inv = _pow(len(buf) + 1)
        acc = np.empty(len(buf) + 1, dtype=np.uint64)
        acc[0] = 0
        np.cumsum(_TABLE[buf] * inv[: len(buf)], out=acc[1:])
        self.acc = acc

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.acc[end] - self.acc[start]) * self.pow[end]
        return mix(h + (end - start).astype(np.uint64))


def chunks(col: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):  # no chunk at all
        col = pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], kind)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the words `[^\\x20\\x09-\\x0D]+`."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    ws = WS[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.empty(len(buf), bool)
    before[0] = True
    before[1:] = ws[:-1]
    after = np.empty(len(buf), bool)
    after[-1] = True
    after[:-1] = ws[1:]
    ink = ~ws
    s = np.flatnonzero(ink & (before | edge[:-1]))
    e = np.flatnonzero(ink & (after | edge[1:])) + 1
    return s, e, np.searchsorted(off, s, "right") - 1


def per_doc(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of a mask over the bytes of each document."""
    acc = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=acc[1:])
    return acc[off[1:]] - acc[off[:-1]]


def shingles(buf: np.ndarray, off: np.ndarray, k: int, hasher: Hasher | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every run of k words; a shorter document gives its whole sequence once."""
    s, e, doc = words(buf, off)
    if not len(s):
        return doc, np.zeros(0, np.uint64)
    h = (hasher or Hasher(buf))(s, e)
    count = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(count) - count
    size = np.minimum(count, k)
    at = np.arange(len(s)) - first[doc]
    starts = np.flatnonzero(at <= count[doc] - size[doc])
    d = doc[starts]
    x = np.zeros(len(starts), np.uint64)
    for j in range(k):
        live = size[d] > j
        x[live] = mix(x[live] * np.uint64(0x9E3779B97F4A7C15) + h[starts[live] + j])
    return d, x


def distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs, by document, then hash."""
    if not len(doc):
        return doc, h
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return d[new], x[new]


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches at a size a small worker holds, however long the texts are."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1024), ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)):
        try:
            now = int(spark.conf.get(key))
        except Exception:  # a version without this setting
            continue
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def map_text(docs: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType, *cols: str) -> DataFrame:
    """mapInArrow over the named columns alone; clashing extra columns never reach Python."""
    small_batches(docs.sparkSession)
    return docs.select(*(cols or ("doc_id", "text"))).mapInArrow(fn, schema)


def quoted(name: str) -> str:
    """A column's name as Spark reads it, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame):
    """All columns as one struct `_row`, so that names of helpers cannot clash with them."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row")


def id_type(docs: DataFrame, name: str = "doc_id") -> T.DataType:
    return docs.schema[name].dataType


def crc_mod(column: str, n: int):
    """crc32 of an id written as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


_tables: list[tuple[SparkSession, str]] = []


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    Cuts lineage: what is computed once is not computed again when an executor
    is lost, every later step sees the same rows, and Spark knows the size of
    what it joins.  The folder is the one the cluster names in
    spark.checkpoint.dir.  Where that is unset a local one is made, but only if
    the session runs in one process; on a cluster it is an error.  The tables go
    with `forget`, or when the Python process ends.
    """
    spark = frame.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="weftline-")
        spark.sparkContext.setCheckpointDir(folder)
    path = f"{folder.rstrip('/')}/weftline/{uuid.uuid4().hex}/{name}"
    frame.write.option("compression", "zstd").parquet(path)
    _tables.append((spark, path))
    return spark.read.schema(frame.schema).parquet(path)


def forget() -> None:
    """Remove the intermediate tables written so far; results that were not yet written cannot be read after it."""
    while _tables:
        spark, path = _tables.pop()
        with contextlib.suppress(Exception):  # the session may be gone
            at = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


atexit.register(forget)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_sample(rows: DataFrame, key: str, size: int, seed: int = 17) -> DataFrame:
    """About `size` rows, the ones with the smallest seeded hashes; all rows if there are fewer.

    The cut is a threshold on the hash, so no sort and no single-task limit is
    needed and the bound holds at any input size (binomial spread around it).
    """
    n = rows.count()
    return rows if n <= size else rows.filter(seeded_hash(key, seed) < F.lit(int((size / n) * (1 << 62))))


def seeded_hash(key: str, seed: int):
    """A seeded hash below 2 ** 62."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int, most_bytes: int) -> DataFrame:
    """doc_id, text and _y of about `size` labelled documents of `most_bytes` bytes of text at most, in a written table.

    Rows of `labels` whose doc_id's crc32 is 0 modulo 5, and null labels, are
    left out; of several labels of one doc_id the greatest counts.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("_y")).filter(F.col("_y").isNotNull() & (crc_mod("doc_id", 5) != 0)).groupBy("doc_id").agg(F.max("_y").alias("_y"))
    chosen = written(bounded_sample(usable, "doc_id", size), "labelled_ids")
    rows = written(docs.select("doc_id", "text").join(chosen, "doc_id"), "labelled_sample")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return rows if total <= most_bytes else rows.filter(seeded_hash("doc_id", 18) < F.lit(int((most_bytes / total) * (1 << 62))))
