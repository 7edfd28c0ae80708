"""Ordered keyword classification and conditional relabelling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txclean.shared import shared_table

Rules = Sequence[tuple[Sequence[str], str]]


def classify_keywords(
    df: DataFrame, col: str, rules: Rules, out: str | None = None
) -> DataFrame:
    """Label of the first rule one of whose keywords occurs in the text.

    Keywords are matched anywhere, ignoring case; text which no rule claims
    stays as it is, casing included.
    """
    # A column of its own, so that the text is lowered once per row and not once
    # per keyword.
    lowered = df.withColumn("__lowered", F.lower(col))
    label = F
    for words, name in rules:
        hit = reduce(or_, (F.col("__lowered").contains(word.lower()) for word in words))
        label = label.when(hit, F.lit(name))
    label = F.col(col) if label is F else label.otherwise(F.col(col))
    return lowered.withColumn(out or col, label).drop("__lowered")


def rules_table(spark: SparkSession, rules: Rules) -> DataFrame:
    """(rank, keyword, label): the keywords of rules in their order, as a table."""
    pairs = [(word, label) for words, label in rules for word in words]
    return spark.createDataFrame(
        pa.table(
            {
                "rank": pa.array(range(1, len(pairs) + 1), pa.int32()),
                "keyword": pa.array([word for word, _ in pairs], pa.string()),
                "label": pa.array([label for _, label in pairs], pa.string()),
            }
        )
    )


#: Letters of the part of a keyword by which it meets the texts.
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The different parts of so many characters."""
    if size == 0:
        return F.array(F.lit(""))
    parts = F.transform(
        F.sequence(F.lit(1), F.length(text) - size + 1), lambda at: F.substring(text, at, F.lit(size))
    )
    return F.when(F.length(text) >= size, F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))


def keyword_matches(df: DataFrame, col: str, rules: DataFrame) -> DataFrame:
    """(text, rows, rank, keyword, label): every rule whose keyword a text holds, ignoring
    case, for each different lowered text with its number of rows.

    A keyword is looked for only in texts that hold its rarest part of three characters
    (shorter keywords: the whole), told by how many texts have each part, so rules
    may be many: their number adds to a table and not to an expression.
    """
    texts = shared_table(
        df.where(F.col(col).isNotNull())
        .groupBy(F.lower(col).alias("text"))
        .agg(F.count(F.lit(1)).alias("rows")),
        "rule-texts",
    )
    words = rules.where("keyword IS NOT NULL").select(
        "rank", "label", "keyword", F.lower("keyword").alias("__word")
    ).withColumn("__size", F.least(F.length("__word"), F.lit(GRAM)))
    # Four sizes at most.
    sizes = sorted(r[0] for r in words.select("__size").distinct().collect())
    if not sizes:
        return texts.join(words.select("rank", "keyword", "label", F.col("__word").alias("text")), "text").where("false").select(
            "text", "rows", "rank", "keyword", "label"
        )
    parts = words.withColumn("__gram", F.explode(reduce(
        lambda other, n: F.when(F.col("__size") == n, _grams(F.col("__word"), n)).otherwise(other),
        sizes, F.array().cast("array<string>"),
    )))
    wanted = parts.select("__gram").distinct()
    held = shared_table(
        texts.select("text", F.explode(F.array_distinct(F.concat(*(_grams(F.col("text"), n) for n in sizes)))).alias("__gram"))
        .join(wanted, "__gram", "left_semi"),
        "rule-grams",
    )
    spread = held.groupBy("__gram").agg(F.count(F.lit(1)).alias("__texts"))
    rarest = parts.join(spread, "__gram").groupBy("rank", "label", "keyword", "__word").agg(
        F.min(F.struct("__texts", "__gram")).alias("__best"), F.count(F.lit(1)).alias("__known")
    )
    # A keyword some of whose parts no text has is in no text.
    whole = parts.groupBy("rank", "keyword").agg(F.count(F.lit(1)).alias("__all"))
    anchors = rarest.join(whole, ["rank", "keyword"]).where("__known = __all").select(
        "rank", "label", "keyword", "__word", F.col("__best.__gram").alias("__gram")
    )
    found = held.join(anchors, "__gram").where(F.col("text").contains(F.col("__word")))
    return found.join(texts, "text").select("text", "rows", "rank", "keyword", "label")


def classify_by_table(
    df: DataFrame, col: str, rules: DataFrame, out: str | None = None
) -> DataFrame:
    """`classify_keywords` by a table (rank, keyword, label): the label of the least rank
    whose keyword the text holds; other texts stay as they are. Ranks must differ.

    What each different text is labelled is worked out when this is called, and written.
    """
    labels = shared_table(
        keyword_matches(df, col, rules)
        .groupBy("text")
        .agg(F.min(F.struct("rank", "label")).alias("first"))
        .select(F.col("text").alias("__text"), F.col("first.label").alias("__label"), F.lit(True).alias("__found")),
        "rule-labels",
    )
    label = F.when(F.col("__found"), F.col("__label")).otherwise(F.col(col))
    return (
        df.join(labels, F.lower(col) == F.col("__text"), "left")
        .withColumn(out or col, label)
        .drop("__text", "__label", "__found")
    )


def rule_use(df: DataFrame, col: str, rules: DataFrame) -> DataFrame:
    """One row per rule: rank, keyword, label, `matched`, the rows whose text holds the
    keyword, and `first`, those it gives the label to. A rule with matches that never
    comes first is hidden by those before it."""
    matches = keyword_matches(df, col, rules)
    least = matches.groupBy("text").agg(F.min("rank").alias("__least"))
    counted = (
        matches.join(least, "text")
        .groupBy(F.col("rank").alias("__rank"))
        .agg(
            F.sum("rows").alias("matched"),
            F.sum(F.when(F.col("rank") == F.col("__least"), F.col("rows")).otherwise(0)).alias("first"),
        )
    )
    return rules.join(counted, F.col("rank") == F.col("__rank"), "left").select(
        "rank", "keyword", "label", F.coalesce("matched", F.lit(0)).alias("matched"), F.coalesce("first", F.lit(0)).alias("first")
    )


def relabel_when(df: DataFrame, col: str, condition: Column, label: str) -> DataFrame:
    """Replace the value where the condition is true (not false, not null)."""
    return df.withColumn(col, F.when(condition, F.lit(label)).otherwise(F.col(col)))
