"""The corpus pipeline: documents that fail quality rules go, near copies go, repeated passages go, sources are mixed
to weights, and what is left is encoded. Each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.stages import encode_stage, mixing_stage, near_dedup_stage, passage_stage, quality_stage
from plumbline.sources.staging import scratch_path

STAGES = [
    ("quality rules", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("suffix-array dedup", passage_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", encode_stage),
]

#: Viterbi paths, sketches and subword merges are not SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
