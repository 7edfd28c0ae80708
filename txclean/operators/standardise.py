"""Whitespace and letter case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.functions.text import pg_initcap


def standardise_text(
    df: DataFrame, trim: Sequence[str] = (), titlecase: Sequence[str] = ()
) -> DataFrame:
    """Strip outer spaces (not tabs or newlines), then title-case."""
    df = df.withColumns({name: F.trim(name) for name in trim})
    return df.withColumns({name: pg_initcap(F.col(name)) for name in titlecase})
