"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txclean.llm.common import table, unused
from txclean.llm.decontamination import find_passages
from txclean.llm.line_dedup import dedup_lines
from txclean.llm.queries import tokenizer, toxicity_model
from txclean.llm.sentencepiece_codec import encode_documents
from txclean.llm.simhash_dedup import near_duplicates
from txclean.llm.toxicity import score


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5, by a machine trained on the labelled documents."""
    name = unused(docs, "__score")
    return score(docs, toxicity_model(spark, sf_dir), name=name).where(F.col(name) < 0.5).drop(name)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one. A document that has
    nothing left goes; one that had nothing before stays. n_chars follows the text."""
    lines = dedup_lines(docs, least_words=1)
    dropped = F.col(unused(docs, "__dropped")) > 0
    gone = dropped & (F.trim(F.col("text")) == "")
    changed = lines.where(~F.coalesce(gone, F.lit(False)))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = changed.withColumn(
            "n_chars", F.when(dropped, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return changed.select(*(f"`{c}`" for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row, of the smallest id. Documents link by the
    operator's own rule: 4-word shingles, fingerprints within 4 bits. Rows without an
    id can't stand for a group and stay."""
    named = docs.where("doc_id IS NOT NULL")
    rows = unused(docs, "__rows")
    kept = (
        near_duplicates(named, words_per_shingle=4)
        .where("doc_id = component_id")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias(rows))
    )
    unique = named.join(kept, "doc_id")
    # A repeated id is a group too, of which one row stays.
    once = unique.where(F.col(rows) == 1).unionByName(
        unique.where(F.col(rows) > 1).dropDuplicates(["doc_id"])
    )
    columns = [f"`{c}`" for c in docs.columns]
    return once.select(*columns).unionByName(docs.where("doc_id IS NULL").select(*columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark stands."""
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size(unused(docs, "__passages")) == 0).select(*(f"`{c}`" for c in docs.columns))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(
        docs,
        tokenizer("piece_bpe_32k.model"),
        columns=["n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"],
    )
