"""Copies of rows: number them, keep one, list the rest.

A group of copies may hold a large share of the table, so nothing here sends
such a group to one task. Keeping one row uses a window with a group limit,
which Spark applies before the shuffle. Numbering and listing set aside the rows
which have no copy, count equal rows among the others, with partial counts before
the shuffle, and write the copies out again only at the end, in pieces spread
over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txclean.shared import shared_table

PIECE = 100_000


def deduplicate(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row by `tiebreak` of each group equal on `keys`.

    Null keys group together. Rows which `tiebreak` leaves equal are ordered by all
    columns, as in `duplicates`, so the two always make up `df`.
    """
    # The window sorts by its keys in turn. A hash in front settles nearly every
    # comparison with one number, however wide the keys; the keys still decide.
    window = Window.partitionBy("__hash", *keys).orderBy(*_order_within(df, keys, tiebreak))
    return (
        df.withColumn("__hash", F.xxhash64(*keys))
        .withColumn("__row_num", F.row_number().over(window))
        .where(F.col("__row_num") == 1)
        .drop("__hash", "__row_num")
    )


def _order_within(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]) -> list[str]:
    """The total order of the rows of a group."""
    rest = [c for c in df.columns if c not in keys]
    return list(dict.fromkeys([*tiebreak, *rest])) or list(keys)


def with_row_num(
    df: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str] = (),
    out: str = "row_num",
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each group equal on `keys` from 1, in `tiebreak` order.

    `key_rows` is as in `duplicates`.
    """
    hashed = with_key_hash(df, keys)
    repeated = repeated_hashes(df if key_rows is None else key_rows, keys)
    single = hashed.join(repeated, "__hash", "left_anti").select(
        *df.columns, F.lit(1).cast("long").alias(out)
    )
    others = hashed.join(repeated, "__hash", "left_semi").select(*df.columns)
    runs = _numbered_runs(others, keys, tiebreak)
    first = F.col("__last") - F.col("__copies") + 1
    return single.unionByName(_write_out(runs, first, df.columns, out))


def duplicates(
    df: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str] = (),
    out: str = "row_num",
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """The rows `deduplicate` removes, with their number (2 and up).

    `key_rows`, if given, is a frame which takes less work than `df` and has the same
    keys in as many rows.
    """
    hashed = with_key_hash(df, keys)
    repeated = repeated_hashes(df if key_rows is None else key_rows, keys)
    others = hashed.join(repeated, "__hash", "left_semi").select(*df.columns)
    runs = _numbered_runs(others, keys, tiebreak).where("__last > 1")
    first = F.greatest(F.col("__last") - F.col("__copies") + 1, F.lit(2))
    return _write_out(runs, first, df.columns, out)


def repeat_rows(df: DataFrame, times: Column, number: str | None = None) -> DataFrame:
    """Each row as often as `times` says; `number` counts its copies from 0.

    Rows with more than `PIECE` copies are cut into pieces which are spread before
    they are written out, so that they are shared by many tasks; the others are
    written out where they stand.
    """
    counted = df.withColumn("__times", times.cast("long")).where("__times > 0")
    few = counted.where(f"__times <= {PIECE}").withColumn("__from", F.lit(0).cast("long"))
    many = (
        counted.where(f"__times > {PIECE}")
        .withColumn("__from", F.explode(F.expr(f"sequence(0L, __times - 1, {PIECE}L)")))
        .repartition(*_hashable(df), "__from")
    )
    pieces = few.unionByName(many)
    copies = pieces.select(
        *df.columns,
        F.explode(
            F.expr(f"sequence(__from, least(__from + {PIECE}, __times) - 1)")
        ).alias("__number"),
    )
    return copies.withColumnRenamed("__number", number) if number else copies.drop("__number")


def _hashable(df: DataFrame) -> list[str]:
    """Columns that rows can be spread by: those without a map."""
    return [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]


def with_key_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("__hash", F.xxhash64(*keys))


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values of `__hash` which more than one row has, as a shared table.

    Equal keys have equal hashes, so a row whose hash is its own has no copy, and
    need not be moved however wide it is. Rows which share a hash are not taken for
    copies; that is left to the keys themselves.
    """
    return shared_table(
        with_key_hash(df, keys)
        .groupBy("__hash")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select("__hash"),
        "hashes",
    )


def _numbered_runs(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """Distinct rows with `__copies` and the number `__last` of their last copy.

    Rows which differ only outside `keys` may be many as well. They are put in
    order by a range partitioning over keys and tie-break, numbered within each
    slice of it, and shifted by what the earlier slices hold of the same group.
    """
    columns = df.columns
    order = list(dict.fromkeys([*keys, *_order_within(df, keys, tiebreak)]))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    runs = shared_table(
        counted.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id()),
        "runs",
    )

    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shift = (
        runs.groupBy("__slice", *keys)
        .agg(F.sum("__copies").alias("__held"))
        .withColumn("__shift", F.sum("__held").over(before))
        .where("__shift is not null")
        .select(
            F.col("__slice").alias("__at"),
            *(F.col(key).alias(f"__key_{key}") for key in keys),
            "__shift",
        )
    )
    same_group = F.col("__slice") == F.col("__at")
    for key in keys:
        same_group &= F.col(key).eqNullSafe(F.col(f"__key_{key}"))

    inside = (
        Window.partitionBy("__slice", *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        runs.withColumn("__last", F.sum("__copies").over(inside))
        .join(shift, same_group, "left")
        .withColumn("__last", F.col("__last") + F.coalesce("__shift", F.lit(0)))
        .select(*columns, "__copies", "__last")
    )


def _write_out(
    runs: DataFrame, first: Column, columns: Sequence[str], out: str
) -> DataFrame:
    numbered = runs.withColumn("__first", first)
    copies = repeat_rows(
        numbered, F.col("__last") - F.col("__first") + 1, number="__number"
    )
    return copies.select(
        *columns, (F.col("__first") + F.col("__number")).alias(out)
    )
