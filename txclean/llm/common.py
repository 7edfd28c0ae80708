"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The white space of the contracts, `[\x20\x09-\x0D]`.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns under the operator's own names, so that no further
    column of the input can clash with them: narrow(df, doc_id="id")."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def unused(df: DataFrame, name: str) -> str:
    """The name, with so many underscores before it that `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


#: What tasks remember in a worker, which lives on: it is emptied when a task ends, or the
#: memory of all operators that a worker has run would add up.
_remembered: dict[int, dict] = {}


def forgotten_after_task(cache: dict) -> dict:
    """The cache itself, from now on emptied at the end of each task of `in_slices`."""
    return _remembered.setdefault(id(cache), cache)


def forget() -> None:
    for cache in _remembered.values():
        cache.clear()
    pa.default_memory_pool().release_unused()


def in_slices(
    df: DataFrame,
    schema: str | StructType,
    work: Callable[[pa.RecordBatch], Iterator[dict]],
    slice_bytes: int = 4_000_000,
) -> DataFrame:
    """Apply `work` to slices of Arrow batches of about so many bytes, at least one row.

    `work` gets a RecordBatch and yields dicts of columns (arrays or lists). Memory
    is bounded by the slice and by the longest row.
    """
    types = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(types)

    def run(batches):
        try:
            for batch in batches:
                rows = max(1, batch.num_rows * slice_bytes // max(batch.nbytes, 1))
                for start in range(0, batch.num_rows, rows):
                    for out in work(batch.slice(start, rows)):
                        yield pa.RecordBatch.from_arrays(
                            [
                                c if isinstance(c := out[f.name], pa.Array) else pa.array(c, f.type)
                                for f in arrow
                            ],
                            schema=arrow,
                        )
        finally:
            forget()

    return df.mapInArrow(run, types)


def with_columns_by_slice(
    df: DataFrame, added: str, work: Callable[[pa.RecordBatch], dict], slice_bytes: int = 4_000_000
) -> DataFrame:
    """All columns of `df` and those of `added`, which `work` makes from a slice."""
    extra = df.sparkSession.createDataFrame([], added).schema

    def run(batch):
        yield dict(zip(batch.schema.names, batch.columns, strict=True)) | work(batch)

    return in_slices(df, StructType([*df.schema.fields, *extra.fields]), run, slice_bytes)
