"""The corpus pipeline: stages over `documents`, each by one operator of `txclean.llm`."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from txclean.llm import stages
from txclean.shared import shared_folder

STAGES = [
    ("toxicity", stages.toxicity),
    ("line dedup", stages.line_dedup),
    ("SimHash near-dedup", stages.near_dedup),
    ("benchmark decontamination", stages.decontamination),
    ("SentencePiece encoding", stages.sentencepiece),
]

#: SQL can't express the kernel machine, fuzzy lines or SentencePiece; tests compare
#: each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/txclean/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
