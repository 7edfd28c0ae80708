"""Nulls and numeric precision."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_from(df: DataFrame, target: str, *sources: str) -> DataFrame:
    """Fill nulls of `target` from the first source which has a value."""
    return df.withColumn(target, F.coalesce(F.col(target), *map(F.col, sources)))


def fix_precision(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to exact types; decimals round half up."""
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
