"""Shared by the span finders: digest columns of spans, and running a finder over batches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm._text import map_text

Span = tuple[str, int, int]


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest_columns(docs: DataFrame, base: tuple[str, ...], find: Callable[[pa.Array], list[tuple[list[Span], list[Span]]]]) -> DataFrame:
    """doc_id, n_<kind> of each base kind, base_sha256 and spans; `find` gives (base spans, all spans) of each text, ordered."""

    def run(batches):
        empty = hashlib.sha256(b"").hexdigest()
        for b in batches:
            found = find(b.column(1))
            counts = {k: [0] * len(b) for k in base}
            shas, spans = [], []
            for i, (own, every) in enumerate(found):
                for k, _, _ in own:
                    counts[k][i] += 1
                shas.append(hashlib.sha256(join_spans(own).encode()).hexdigest() if own else empty)
                spans.append(join_spans(every))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(counts[k], pa.int64()) for k in base], pa.array(shas, pa.string()), pa.array(spans, pa.string())], schema.names)

    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in base], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return map_text(docs, run, schema)
