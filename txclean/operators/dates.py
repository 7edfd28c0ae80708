"""Whether a source writes the day or the month first, told by the dates it has written."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txclean.functions import parse_mixed_timestamp
from txclean.functions.timestamps import MIXED_LAYOUTS


def _turned(layout: str) -> str:
    """The layout with the month before the day, where both are numbers."""
    return re.sub(r"\bdd(\W)MM\b", r"MM\1dd", layout)


def _readings(text: Column, layouts: Sequence[str], low: str, high: str) -> tuple[Column, Column]:
    """The text read with the day first and with the month first, null outside the range.
    Texts of other layouts are read alike by both."""
    low_at, high_at = (F.lit(at).cast("timestamp_ntz") for at in (low, high))

    def within(parsed: Column) -> Column:
        return F.when((parsed >= low_at) & (parsed < high_at), parsed)

    return (
        within(parse_mixed_timestamp(text, layouts)),
        within(parse_mixed_timestamp(text, [_turned(layout) for layout in layouts])),
    )


def date_order(
    df: DataFrame,
    source: str,
    text: str,
    low: str,
    high: str,
    layouts: Sequence[str] = MIXED_LAYOUTS,
) -> DataFrame:
    """One row per source: source, rows, `day_first` and `month_first`, how many texts can be
    read in that way alone within [low, high), `either`, how many give two different dates, and
    `order`: 'day' or 'month' where only one of the ways has witnesses, 'mixed' where both
    have, and 'undecided' where none has.

    Different texts of a source are counted before they are read, and one scan is all. A null
    source is one like any other; null texts count as rows only.
    """
    texts = df.groupBy(F.col(source).alias("source"), F.col(text).alias("__text")).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    day, month = _readings(F.col("__text"), layouts, low, high)
    read = texts.withColumn("__day", day).withColumn("__month", month)

    def rows(condition: str) -> Column:
        return F.sum(F.when(F.expr(condition), F.col("__rows")).otherwise(0))

    counted = read.groupBy("source").agg(
        F.sum("__rows").alias("rows"),
        rows("__day IS NOT NULL AND __month IS NULL").alias("day_first"),
        rows("__day IS NULL AND __month IS NOT NULL").alias("month_first"),
        rows("__day <> __month").alias("either"),
    )
    order = (
        F.when((F.col("day_first") > 0) & (F.col("month_first") > 0), "mixed")
        .when(F.col("day_first") > 0, "day")
        .when(F.col("month_first") > 0, "month")
        .otherwise("undecided")
    )
    return counted.withColumn("order", order)


def parse_by_evidence(
    df: DataFrame,
    source: str,
    text: str,
    low: str,
    high: str,
    layouts: Sequence[str] = MIXED_LAYOUTS,
    out: str = "parsed",
    order: str = "order",
) -> DataFrame:
    """All rows with `out`, the date in the order that its source's texts tell, and `order`.

    Texts with one reading in the range have that one. Those with two are read in the order
    of a decided source and are null for the others, to be looked at.
    """
    told = date_order(df, source, text, low, high, layouts).select(
        F.col("source").alias("__source"), F.col("order").alias("__order")
    )
    day, month = _readings(F.col(text), layouts, low, high)
    joined = (
        df.join(told, F.col(source).eqNullSafe(F.col("__source")), "left")
        .withColumn("__day", day)
        .withColumn("__month", month)
    )
    one = F.coalesce("__day", "__month")
    two = F.col("__day") != F.col("__month")
    parsed = (
        F.when(~F.coalesce(two, F.lit(False)), one)
        .when(F.col("__order") == "day", F.col("__day"))
        .when(F.col("__order") == "month", F.col("__month"))
    )
    return joined.select(*df.columns, parsed.alias(out), F.col("__order").alias(order))
