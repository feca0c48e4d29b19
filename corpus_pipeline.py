"""The corpus pipeline: documents in, packed training sequences out.

Stages, in order, each on all that its predecessor kept:

1. quality_classifier: trains on the labels and drops the documents it rejects.
2. exact_dedup: of equal normalised texts, the row with the smallest doc_id stays.
3. near_dedup: five-word shingles at a Jaccard similarity of 0.8 or more; of
   each connected group the smallest doc_id stays.
4. mixing: documents come as often as the mixture takes them.
5. packing: pieces of sequences of at most 1024 tokens.

All stages but the last return the columns of their input.  Each is written as
Parquet and read again before the next, in the folder that the cluster names
in spark.checkpoint.dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import exact_dedup, jaccard, mixing, packing
from weftline.llm import quality_classifier as quality
from weftline.llm._text import documents, written


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without a label to learn from, all documents score 0.5 and stay."""
    return quality.keep(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.dedup(docs, k=5, percent=80)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", stage_quality),
    ("exact_dedup", stage_exact_dedup),
    ("near_dedup", stage_near_dedup),
    ("mixing", stage_mixing),
    ("packing", stage_packing),
]

#: The classifier is trained, the near duplicates are components and the last stage tokenises: none of it is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
