"""Typed CSV in, one parquet directory per relation out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txclean.shared import shared_table
from txclean.sources.schemas import fit_lengths

# Stands for an unquoted empty field, so that it can be told from a quoted one.
_NO_VALUE = "\u0001\u0002\u0001"


def read_transactions(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    header: bool = True,
    lengths: Mapping[str, int] | None = None,
    multiline: bool = False,
    table: str | None = None,
) -> DataFrame:
    """Load CSV by position, with types, to a parquet table; any bad row stops the load.

    An empty field is null, a quoted empty field is an empty text, outer spaces
    are kept and `""` inside quotes is a quote. `lengths` holds text columns to
    declared lengths. Files are split between tasks; a file with line breaks
    inside quotes cannot be, and needs `multiline=True`: without it, a file with a
    line that leaves a quote open is refused.

    Every column is written, so every value is converted and checked whatever is
    read later. `table` is the path of the new table, by default one in the shared folder.
    """
    if not multiline:
        _refuse_open_quotes(spark, path)
    df = (
        spark.read.schema(schema)
        .option("header", header)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("encoding", "UTF-8")
        .option("nullValue", _NO_VALUE)
        .option("emptyValue", "")
        .option("multiLine", multiline)
        .csv(path)
    )
    if lengths:
        df = fit_lengths(df, lengths)
    if table is None:
        return shared_table(df, "transactions")
    df.write.parquet(table)
    return spark.read.schema(df.schema).parquet(table)


def _refuse_open_quotes(spark: SparkSession, path: str) -> None:
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    if not spark.read.text(path).where(quotes % 2 == 1).isEmpty():
        raise ValueError(f"malformed: a line of {path} leaves a quote open; is multiline=True meant?")


def conform(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Select, rename, cast and order columns: {source: (target, type)}."""
    return df.select(
        *(F.col(src).cast(kind).alias(dst) for src, (dst, kind) in mapping.items())
    )


def write_relations(
    relations: Mapping[str, DataFrame], path: str, mode: str = "overwrite"
) -> None:
    """One parquet directory per relation under `path`."""
    for name, df in relations.items():
        df.write.mode(mode).parquet(f"{path.rstrip('/')}/{name}")
