"""The queries of this subpackage, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txclean.llm import neighbour_quality
from txclean.llm.chat import format_conversations, read_back
from txclean.llm.common import table
from txclean.llm.decontamination import find_passages
from txclean.llm.exact_dedup import exact_duplicates
from txclean.llm.html_extraction import extract
from txclean.llm.line_dedup import dedup_lines
from txclean.llm.sentencepiece_codec import encode_documents
from txclean.llm.simhash_dedup import near_duplicates
from txclean.llm.spelling import spelling_variants
from txclean.llm.substring_dedup import remove_duplicate_spans
from txclean.llm.token_alignment import align_documents
from txclean.llm.token_counts import count_tokens
from txclean.llm.toxicity import Model, score, train

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(column: str = "doc_id", folds: int = 5, fold: int = 0):
    """Rows whose labels are not learnt."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(folds)) == fold


def toxicity_model(spark: SparkSession, sf_dir: str) -> Model:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return train(table(spark, sf_dir, "documents"), labels)


@query
def op1_toxicity(spark, sf_dir):
    scored = score(
        table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir)
    )
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op2_sentencepiece(spark, sf_dir):
    return encode_documents(
        table(spark, sf_dir, "documents"),
        tokenizer("piece_bpe_32k.model"),
        columns=["n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"],
    )


@query
def op3_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op4_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_html(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op7_chat(spark, sf_dir):
    probe = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = read_back(format_conversations(turns.unionByName(added)))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""
            ),
            256,
        ).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, least_words=1).select(
        "doc_id",
        F.col("__lines").cast("long").alias("n_lines"),
        F.col("__dropped").cast("long").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query
def op9_decontamination(spark, sf_dir):
    found = find_passages(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        (F.size("__passages") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.col("__passages.item"))).alias("item_ids"),
        F.aggregate(
            "__passages", F.lit(0).cast("long"), lambda n, p: n + (p.stop - p.start).cast("long")
        ).alias("n_words"),
    )


@query
def op10_substring_dedup(spark, sf_dir):
    return remove_duplicate_spans(table(spark, sf_dir, "documents"), keep_text=False).drop("removed")


@query
def op11_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aside = held_out(folds=3, fold=1)
    model = neighbour_quality.train(docs, table(spark, sf_dir, "labels").where(~aside))
    return neighbour_quality.score(docs, model).select(
        "doc_id",
        aside.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op12_alignment(spark, sf_dir):
    documents, _ = align_documents(
        table(spark, sf_dir, "documents"),
        tokenizer("byte_bpe_50k.json"),
        tokenizer("piece_bpe_32k.model"),
    )
    return documents


@query
def op13_spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from txclean.llm.sql import ORACLE

    return dict(ORACLE)
