"""What changed between two stages, as a log and as counts.

A log is a bag of entries. Its rows carry the column `entries`, the number of
times the entry occurs: stages are joined on a key which need not be unique, so
a changed row with r exact copies stands for r x r equal entries, and those are
counted instead of written out. `repeat_rows(log, F.col("entries"))` gives one
row per entry.

The `count_*` operators give the number of entries of the matching `audit_*`
operator without joining anything. Their work is linear in the rows of both
stages even if one key holds a large share of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

from txclean.operators.dedup import repeated_hashes, with_key_hash
from txclean.operators.numbering import ordered_slices, starts_of_slices, upto_within
from txclean.shared import shared_table

SUMMARY_KEYS = ("column_changed", "change_stage", "change_reason")
# Products of two row counts outgrow 64 bits.
COUNT = "decimal(38,0)"


class Note(NamedTuple):
    """How a change is described in the log."""

    column: str
    stage: str
    reason: str


# Per column: the column with the old value, the one with the new value, the note.
Changes = Sequence[tuple[str, str, Note]]


def _product(left: str, right: str) -> Column:
    return (
        F.col(left).cast("decimal(19,0)") * F.col(right).cast("decimal(19,0)")
    ).cast(COUNT)


def _entry(df: DataFrame, key: str, note: Note, old: Column, new: Column, entries: Column) -> DataFrame:
    return df.select(
        F.col(key).alias("transaction_id"),
        F.lit(note.column).alias("column_changed"),
        old.cast("string").alias("old_value"),
        new.cast("string").alias("new_value"),
        F.lit(note.stage).alias("change_stage"),
        F.lit(note.reason).alias("change_reason"),
        entries.cast(COUNT).alias("entries"),
    )


# Values of several columns are held as text in one column. Both stages are cast to the
# wider of their types first, so that 1.5 and 1.50 are one value; what is logged is the
# value in its own type again.


class _Kinds(NamedTuple):
    both: DataType
    old: DataType
    new: DataType


def _kinds(df: DataFrame, changes: Changes) -> list[_Kinds]:
    """The types of each change's columns; a type is only looked up, nothing is read."""
    types = {f.name: f.dataType for f in df.schema}
    wider = df.select(
        *(F.coalesce(F.col(old), F.col(new)).alias(str(i)) for i, (old, new, _) in enumerate(changes))
    ).schema
    return [
        _Kinds(wider[i].dataType, types[old], types[new]) for i, (old, new, _) in enumerate(changes)
    ]


def _as_text(value: Column, kind: DataType) -> Column:
    """Texts which are equal exactly where the values are."""
    value = value.cast(kind)
    if isinstance(kind, TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, BinaryType):
        value = F.hex(value)
    elif isinstance(kind, (DoubleType, FloatType)):
        value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return value.cast("string")


def _shown(value: Column, kind: DataType, own: DataType) -> Column:
    """The text of a value of `_as_text` in the type of its column."""
    if isinstance(kind, (StringType, ArrayType, MapType, StructType)):
        return value
    if isinstance(kind, TimestampType):
        value = F.timestamp_micros(value.cast("long"))
    elif isinstance(kind, BinaryType):
        value = F.unhex(value)
    return value.cast(kind).cast(own).cast("string")


def _shown_of(kinds: Sequence[_Kinds], column: str, side: str) -> Column:
    """The same where `change` tells which of the columns it is."""
    if all(isinstance(k.both, StringType) for k in kinds):
        return F.col(column)
    return F.coalesce(
        *(
            F.when(F.col("change") == i, _shown(F.col(column), k.both, getattr(k, side)))
            for i, k in enumerate(kinds)
        )
    )


# What changed is told from counts (by, value, before, after): how many rows hold
# the value before and how many after, for each value of the `by` columns.


def _counts_of_stages(
    before: DataFrame, after: DataFrame, key: str, col: str
) -> DataFrame:
    def side(df: DataFrame, in_before: int) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(
            F.col(key).alias("key"),
            F.col(col).alias("value"),
            F.lit(in_before).cast("long").alias("before"),
            F.lit(1 - in_before).cast("long").alias("after"),
        )

    return (
        side(before, 1)
        .unionByName(side(after, 0))
        .groupBy("key", "value")
        .agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    )


def _with_shared_flag(df: DataFrame, key: str, key_rows: DataFrame | None) -> DataFrame:
    """Rows with a key; `__shared` tells whether another row may have the same one."""
    present = F.col(key).isNotNull()
    repeated = repeated_hashes((df if key_rows is None else key_rows).where(present), [key])
    return (
        with_key_hash(df.where(present), [key])
        .join(repeated.withColumn("__shared", F.lit(True)), "__hash", "left")
        .withColumn("__shared", F.coalesce("__shared", F.lit(False)))
    )


def _counts_of_rows(
    flagged: DataFrame, key: str, changes: Changes, kinds: Sequence[_Kinds]
) -> DataFrame:
    """Both stages of all columns in one scan; `change` is the place in `changes`.

    Rows which do not share their key are told by themselves whether they changed.
    They are counted in `alone` under a null key, and so go to almost nothing before
    the shuffle.
    """
    shared = F.col("__shared")

    def value(change: int, col: str, before: Column, after: Column, alone: Column) -> Column:
        return F.struct(
            F.lit(change).alias("change"),
            F.when(shared, F.col(key)).alias("key"),
            F.when(shared, _as_text(F.col(col), kinds[change].both)).alias("value"),
            (shared & before).cast("long").alias("before"),
            (shared & after).cast("long").alias("after"),
            (~shared & alone).cast("long").alias("alone"),
        )

    yes, no = F.lit(True), F.lit(False)
    values = []
    for change, (old, new, _) in enumerate(changes):
        same = F.col(old).eqNullSafe(F.col(new))
        values += [
            value(change, old, yes, same, ~same),
            value(change, new, no, ~same, no),
        ]
    return (
        flagged.select(F.inline(F.array(*values)))
        .where("before + after + alone > 0")
        .groupBy("change", "key", "value")
        .agg(*(F.sum(name).alias(name) for name in ("before", "after", "alone")))
    )


def _changed_pairs(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Pairs of different values under one key, each pair once.

    Each side names both counts, so that the sides have one grouping in common.
    """
    old = counts.where("before > 0 AND after >= 0").select(*by, F.col("value").alias("old"), "before")
    new = counts.where("after > 0 AND before >= 0").select(*by, F.col("value").alias("new"), "after")
    return old.join(new, list(by)).where(~F.col("old").eqNullSafe(F.col("new")))


def _changes_per_key(counts: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    """How many pairs of rows differ: all pairs less the equal ones."""
    return (
        counts.groupBy(*by)
        .agg(
            F.sum("before").alias("before"),
            F.sum("after").alias("after"),
            F.sum(_product("before", "after")).alias("equal"),
            *more,
        )
        .withColumn("changes", _product("before", "after") - F.col("equal"))
    )


def _notes(changes: Changes, field: str) -> Column:
    return F.get(F.array(*(F.lit(getattr(note, field)) for _, _, note in changes)), F.col("change"))


def audit_changes(
    before: DataFrame, after: DataFrame, key: str, col: str, note: Note
) -> DataFrame:
    """Entries for every pair of rows with equal key and different value."""
    changed = _changed_pairs(_counts_of_stages(before, after, key, col), ["key"])
    old, new = (F.col(side).cast(df.schema[col].dataType) for side, df in (("old", before), ("new", after)))
    return _entry(changed, "key", note, old, new, _product("before", "after"))


def count_changes(
    before: DataFrame, after: DataFrame, key: str, col: str, note: Note
) -> DataFrame:
    """Number of entries of `audit_changes`."""
    per_key = _changes_per_key(_counts_of_stages(before, after, key, col), ["key"])
    return count_totals(per_key, [(F.sum("changes"), note)])


def audit_changes_within(
    df: DataFrame, key: str, changes: Changes, key_rows: DataFrame | None = None
) -> DataFrame:
    """`audit_changes` of several columns at once, where one stage comes from the
    other row by row and `df` holds the values of both.

    Only rows which share their key are joined. `key_rows`, if given, is a frame
    which takes less work than `df` and has the same keys in as many rows.
    """
    kinds = _kinds(df, changes)
    flagged = _with_shared_flag(df, key, key_rows)
    alone = audit_row_changes(flagged.where(~F.col("__shared")), key, changes)
    counts = _counts_of_rows(flagged.where("__shared"), key, changes, kinds)
    changed = _changed_pairs(counts, ["change", "key"]).select(
        F.col("key").alias("transaction_id"),
        _notes(changes, "column").alias("column_changed"),
        _shown_of(kinds, "old", "old").alias("old_value"),
        _shown_of(kinds, "new", "new").alias("new_value"),
        _notes(changes, "stage").alias("change_stage"),
        _notes(changes, "reason").alias("change_reason"),
        _product("before", "after").alias("entries"),
    )
    return alone.unionByName(changed)


def count_changes_within(
    df: DataFrame, key: str, changes: Changes, key_rows: DataFrame | None = None
) -> DataFrame:
    """Number of entries of `audit_changes_within` per column."""
    counts = _counts_of_rows(
        _with_shared_flag(df, key, key_rows), key, changes, _kinds(df, changes)
    )
    per_key = _changes_per_key(counts, ["change", "key"], F.sum("alone").alias("alone"))
    return (
        per_key.groupBy("change")
        .agg(F.sum(F.col("changes") + F.col("alone")).cast(COUNT).alias("number_of_changes"))
        .where("number_of_changes > 0")
        .select(
            _notes(changes, "column").alias("column_changed"),
            _notes(changes, "stage").alias("change_stage"),
            _notes(changes, "reason").alias("change_reason"),
            "number_of_changes",
        )
    )


FACTOR_OF = ("transaction_id", "column_changed", "change_stage", "change_reason")


def audit_factors(
    df: DataFrame, key: str, changes: Changes, key_rows: DataFrame | None = None
) -> DataFrame:
    """The log of `audit_changes_within` by its factors: for each key and column with a
    change one row per value, `rows_before` and `rows_after` telling how many rows of the
    key hold it. A key that n rows share has 2n rows at most, and not n x n.

    `value` is the value in a form in which both stages can be compared; `old_value` and
    `new_value` are what the log shows, null in a stage that doesn't hold it.
    `expand_factors` writes the pairs, `count_factors` counts them.
    """
    kinds = _kinds(df, changes)
    flagged = _with_shared_flag(df, key, key_rows)
    counts = _counts_of_rows(flagged.where("__shared"), key, changes, kinds)
    by = ["change", "key"]
    changed_keys = _changes_per_key(counts, by).where("changes > 0").select(*by)
    shared = counts.join(changed_keys, by).select(*by, "value", "before", "after")
    rows = []
    for change, (old, new, _) in enumerate(changes):
        differs = ~F.col(old).eqNullSafe(F.col(new))
        rows += [
            F.when(
                differs,
                F.struct(
                    F.lit(change).alias("change"),
                    F.col(key).alias("key"),
                    _as_text(F.col(col), kinds[change].both).alias("value"),
                    F.lit(before).cast("long").alias("before"),
                    F.lit(1 - before).cast("long").alias("after"),
                ),
            )
            for col, before in ((old, 1), (new, 0))
        ]
    alone = flagged.where(~F.col("__shared")).select(F.inline(F.array_compact(F.array(*rows))))
    return shared.unionByName(alone).select(
        F.col("key").alias("transaction_id"),
        _notes(changes, "column").alias("column_changed"),
        _notes(changes, "stage").alias("change_stage"),
        _notes(changes, "reason").alias("change_reason"),
        "value",
        F.when(F.col("before") > 0, _shown_of(kinds, "value", "old")).alias("old_value"),
        F.when(F.col("after") > 0, _shown_of(kinds, "value", "new")).alias("new_value"),
        F.col("before").alias("rows_before"),
        F.col("after").alias("rows_after"),
    )


def expand_factors(factors: DataFrame) -> DataFrame:
    """The entries: each pair of different values of a key and column, with its number."""
    old = factors.where("rows_before > 0").select(
        *FACTOR_OF, F.col("value").alias("__old"), "old_value", "rows_before"
    )
    new = factors.where("rows_after > 0").select(
        *FACTOR_OF, F.col("value").alias("__new"), "new_value", "rows_after"
    )
    return (
        old.join(new, list(FACTOR_OF))
        .where(~F.col("__old").eqNullSafe(F.col("__new")))
        .select(
            "transaction_id", "column_changed", "old_value", "new_value", "change_stage", "change_reason",
            _product("rows_before", "rows_after").alias("entries"),
        )
    )


def count_factors(factors: DataFrame) -> DataFrame:
    """Entries per column, stage and reason, without expanding: the product of a key's
    rows before and after, less the inner product of its two lists."""
    per_key = factors.groupBy(*FACTOR_OF).agg(
        F.sum("rows_before").alias("rows_before"),
        F.sum("rows_after").alias("rows_after"),
        F.sum(_product("rows_before", "rows_after")).alias("equal"),
    )
    changes = (_product("rows_before", "rows_after") - F.col("equal")).cast(COUNT)
    return per_key.groupBy(*SUMMARY_KEYS).agg(F.sum(changes).cast(COUNT).alias("number_of_changes"))


def audit_fills(
    before: DataFrame, after: DataFrame, key: str, col: str, note: Note
) -> DataFrame:
    """Entries for every pair of rows with equal key, null before and filled after."""
    empty = (
        before.where(F.col(col).isNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("before"))
    )
    filled = (
        after.where(F.col(col).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"), F.col(col).alias("new"))
        .agg(F.count(F.lit(1)).alias("after"))
    )
    return _entry(
        empty.join(filled, "key"),
        "key",
        note,
        F.lit(None),
        F.col("new"),
        _product("before", "after"),
    )


def count_fills(
    before: DataFrame, after: DataFrame, key: str, col: str, note: Note
) -> DataFrame:
    def side(df: DataFrame, kept: Column, in_before: int) -> DataFrame:
        return df.where(kept & F.col(key).isNotNull()).select(
            F.col(key).alias("key"),
            F.lit(in_before).cast("long").alias("before"),
            F.lit(1 - in_before).cast("long").alias("after"),
        )

    per_key = (
        side(before, F.col(col).isNull(), 1)
        .unionByName(side(after, F.col(col).isNotNull(), 0))
        .groupBy("key")
        .agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    )
    return count_totals(per_key, [(F.sum(_product("before", "after")), note)])


def count_fills_within(
    groups: DataFrame, key: str, old: str, new: str, copies: str, note: Note
) -> DataFrame:
    """`count_fills` from groups of equal rows: `copies` of each are in the stage
    before, with `old`, and one in the stage after, with `new`."""
    per_key = groups.groupBy(key).agg(
        F.sum(F.when(F.col(old).isNull(), F.col(copies)).otherwise(0)).alias("before"),
        F.count(new).alias("after"),
    )
    # A condition inside the sum, not a filter, which would be pushed below the
    # groups and keep other counts of the same groups from sharing their shuffle.
    fills = F.when(F.col(key).isNotNull(), _product("before", "after"))
    return count_totals(per_key, [(F.sum(fills), note)])


def audit_fills_within(
    groups: DataFrame, key: str, old: str, new: str, copies: str, note: Note
) -> DataFrame:
    """`audit_fills` from groups as in `count_fills_within`."""
    # Conditions stand inside the sums and the key inside a struct: filters would be
    # pushed below the groups and keep them from being shared.
    counted = groups.groupBy(F.struct(F.col(key).alias("key")).alias("of"), F.col(new).alias("new")).agg(
        F.sum(F.when(F.col(key).isNotNull() & F.col(old).isNull(), F.col(copies)).otherwise(0)).alias("before"),
        F.count(new).alias("after"),
    )
    empty = counted.groupBy("of").agg(F.sum("before").alias("before"), F.sum("after").alias("all_after"))
    filled = counted.where("after > 0 AND before >= 0").select("of", "new", "after")
    return _entry(
        empty.where("before > 0 AND all_after >= 0").join(filled, "of"),
        "of.key",
        note,
        F.lit(None),
        F.col("new"),
        _product("before", "after"),
    )


class Told(NamedTuple):
    """An entry which a row makes by itself, if `when` holds."""

    note: Note
    when: Column
    old: Column
    new: Column
    entries: Column


def audit_told(df: DataFrame, key: str, told: Sequence[Told]) -> DataFrame:
    """Entries of several kinds in one pass over the rows."""
    entries = F.array(
        *(
            F.struct(
                F.lit(t.note.column).alias("column_changed"),
                t.old.cast("string").alias("old_value"),
                t.new.cast("string").alias("new_value"),
                F.lit(t.note.stage).alias("change_stage"),
                F.lit(t.note.reason).alias("change_reason"),
                F.when(t.when, t.entries.cast(COUNT)).alias("entries"),
            )
            for t in told
        )
    )
    return df.select(F.col(key).alias("transaction_id"), F.inline(entries)).where("entries > 0")


def audit_duplicates(
    df: DataFrame, keys: Sequence[str], key: str, old: str, new: str, note: Note
) -> DataFrame:
    """One entry per row `deduplicate` removes, counted per transaction id."""
    removed = (
        row_groups(df, keys)
        .where("copies > 1")
        .groupBy(key)
        .agg(F.sum(F.col("copies") - 1).alias("removed"))
    )
    return _entry(removed, key, note, F.lit(old), F.lit(new), F.col("removed"))


def count_duplicates(df: DataFrame, keys: Sequence[str], note: Note) -> DataFrame:
    return count_totals(row_groups(df, keys), [(F.sum(F.col("copies") - 1), note)])


def row_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct values of the keys with their number of rows in `copies`."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def audit_predicate(
    df: DataFrame, predicate: Column, key: str, old: Column, new: Column, note: Note
) -> DataFrame:
    """One entry per row for which the predicate is true."""
    return _entry(df.where(predicate), key, note, old, new, F.lit(1))


def count_totals(df: DataFrame, totals: Sequence[tuple[Column, Note]]) -> DataFrame:
    """Several counts over the same rows, in one scan; zero and null drop out."""
    counts = df.agg(*(total.cast(COUNT).alias(f"c{i}") for i, (total, _) in enumerate(totals)))
    rows = F.array(
        *(
            F.struct(
                F.lit(note.column).alias("column_changed"),
                F.lit(note.stage).alias("change_stage"),
                F.lit(note.reason).alias("change_reason"),
                F.col(f"c{i}").alias("number_of_changes"),
            )
            for i, (_, note) in enumerate(totals)
        )
    )
    return counts.select(F.inline(rows)).where("number_of_changes > 0")


def audit_row_changes(df: DataFrame, key: str, changes: Changes) -> DataFrame:
    """One entry per row and changed column, from rows which hold both values.

    Nothing is joined or shuffled, and copies do not multiply entries.
    """
    entries = F.array(
        *(
            F.struct(
                F.lit(note.column).alias("column_changed"),
                F.col(old).cast("string").alias("old_value"),
                F.col(new).cast("string").alias("new_value"),
                F.lit(note.stage).alias("change_stage"),
                F.lit(note.reason).alias("change_reason"),
                # Compared as they are: 1.5 and 1.50 are one value, though not one text.
                (~F.col(old).eqNullSafe(F.col(new))).alias("changed"),
            )
            for old, new, note in changes
        )
    )
    return (
        df.select(F.col(key).alias("transaction_id"), F.explode(entries).alias("entry"))
        .where("entry.changed")
        .select("transaction_id", "entry.*", F.lit(1).cast(COUNT).alias("entries"))
        .drop("changed")
    )


def audit_log(*branches: DataFrame) -> DataFrame:
    """All entries of several audit operators."""
    return reduce(DataFrame.unionByName, branches)


def number_entries(
    log: DataFrame, slices: int | None = None, first_id: int = 1, rows_per_slice: int = 500_000
) -> DataFrame:
    """Give entries ids from `first_id` without gaps, and the time of the run.

    `log_id` is the id of the first of `entries` equal entries; the others follow
    it. Ids go in the order of the columns. Different entries are cut into slices of
    about `rows_per_slice` rows by range, numbered within each, and shifted by what the
    slices before it hold. The different entries are written to the shared folder first,
    which tells how many slices there are; `slices` sets their number instead.
    """
    columns = [name for name in log.columns if name != "entries"]
    entries = shared_table(
        log.groupBy(*columns).agg(F.sum("entries").cast(COUNT).alias("entries")), "entries"
    )
    if slices is None:
        slices = -(-entries.count() // rows_per_slice) or 1
    sliced = shared_table(ordered_slices(entries, columns, slices), "slices")
    starts = starts_of_slices(sliced, "entries")
    return (
        sliced.withColumn("__upto", upto_within("entries", columns))
        .join(starts, "__slice")
        .select(
            (F.lit(first_id).cast(COUNT) + F.col("__start") + F.col("__upto") - F.col("entries"))
            .cast(COUNT)
            .alias("log_id"),
            *columns,
            "entries",
            F.current_timestamp().alias("changed_at"),
        )
    )


def summarise_audit(log: DataFrame) -> DataFrame:
    """Number of entries per column, stage and reason."""
    return log.groupBy(*SUMMARY_KEYS).agg(
        F.sum("entries").cast(COUNT).alias("number_of_changes")
    )


def cleaning_report(summary: DataFrame) -> DataFrame:
    """The summary under display names, largest number first."""
    return summary.select(
        F.col("change_stage").alias("Cleaning Stage"),
        F.col("change_reason").alias("Reason For Change"),
        F.col("number_of_changes").alias("Total Rows Changed"),
    ).orderBy(F.desc("Total Rows Changed"), "Cleaning Stage", "Reason For Change")
