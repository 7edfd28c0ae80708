"""Running sums over a whole table: slices by range, and the sums of the slices before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices whose sums are added up in one place.
BLOCK = 1024


def ordered_slices(df: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """`df` with `__slice`: rows of a slice come before those of the next one in `order`.

    The slice of a row is fixed only once the result is written.
    """
    return df.repartitionByRange(slices, *order).withColumn("__slice", F.spark_partition_id())


def upto_within(value: str, order: Sequence[str]) -> Column:
    """The sum of `value` in a row's slice up to and with the row."""
    return F.sum(value).over(
        Window.partitionBy("__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def starts_of_slices(sliced: DataFrame, value: str) -> DataFrame:
    """(__slice, __start): the sum of `value` in all slices before, on two levels: no task
    sees more sums than a block has slices, or there are blocks."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy("__slice").agg(F.sum(value).alias("__held")).withColumn(
        "__block", F.floor(F.col("__slice") / BLOCK)
    )
    blocks = (
        sums.groupBy("__block")
        .agg(F.sum("__held").alias("__held"))
        .select(
            "__block",
            F.coalesce(F.sum("__held").over(before.orderBy("__block")), F.lit(0)).alias("__block_start"),
        )
    )
    inside = F.sum("__held").over(before.partitionBy("__block").orderBy("__slice"))
    return sums.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(blocks, "__block").select(
        "__slice", (F.col("__block_start") + F.col("__inside")).alias("__start")
    )
