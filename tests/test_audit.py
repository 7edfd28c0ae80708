from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from txclean.operators import audit
from txclean.operators import (
    audit_changes,
    audit_changes_within,
    audit_duplicates,
    audit_fills,
    audit_predicate,
    audit_row_changes,
    cleaning_report,
    count_changes,
    count_changes_within,
    count_duplicates,
    count_fills,
    number_entries,
    repeat_rows,
    summarise_audit,
)
from txclean.operators.audit import Note

NOTE = Note("name", "Stage", "Reason")

# (id, old, new): exact copies, one id with different rows, nulls on both sides.
ROWS = [
    ("t1", " a", "A"),
    ("t1", " a", "A"),
    ("t2", "b", "B"),
    ("t2", "c", "c"),
    ("t3", "d", "d"),
    ("t4", None, None),
    ("t5", None, "E"),
    ("t6", "f", None),
    (None, "g", "G"),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id string, old string, new string")


def stages(rows):
    return rows.selectExpr("id", "old as name"), rows.selectExpr("id", "new as name")


def entries(log):
    return Counter(
        {
            (r.transaction_id, r.old_value, r.new_value): int(r.entries)
            for r in log.collect()
        }
    )


def joined(data):
    """The definition: pairs of rows with equal, known ids and distinct values."""
    return Counter(
        (i, old, new)
        for i, old, _ in data
        for j, _, new in data
        if i is not None and i == j and old != new
    )


def test_changes_count_the_fan_out(rows):
    log = audit_changes(*stages(rows), "id", "name", NOTE)
    assert entries(log) == joined(ROWS)
    assert entries(log)[("t1", " a", "A")] == 4


def test_changes_within_equal_changes_of_stages(rows):
    changes = [("old", "new", NOTE)]
    assert entries(audit_changes_within(rows, "id", changes)) == joined(ROWS)


def test_row_changes_have_one_entry_per_row(rows):
    log = audit_row_changes(rows, "id", [("old", "new", NOTE)])
    assert log.count() == sum(old != new for _, old, new in ROWS)


def total(counts):
    rows = counts.collect()
    assert len(rows) == 1
    return int(rows[0].number_of_changes)


def test_counts_need_no_pairs(rows):
    expected = joined(ROWS).total()
    assert total(count_changes(*stages(rows), "id", "name", NOTE)) == expected
    assert total(count_changes_within(rows, "id", [("old", "new", NOTE)])) == expected


def test_counts_with_a_hot_id(spark):
    """A third of the rows under one id, all values different, and 40,000 copies of
    one row: about 10^9 pairs, counted only."""
    spread = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("id"),
        F.concat(F.lit("v"), F.col("id")).alias("old"),
        F.concat(F.lit("V"), F.col("id")).alias("new"),
    )
    copies = spark.range(40_000).selectExpr("'copy' as id", "'x' as old", "'X' as new")
    df = spread.unionByName(copies)
    expected = 20_000**2 + 40_000 + 40_000**2
    assert total(count_changes_within(df, "id", [("old", "new", NOTE)])) == expected
    log = audit_changes_within(copies, "id", [("old", "new", NOTE)])
    assert [int(r.entries) for r in log.collect()] == [40_000**2]


def test_counts_beyond_64_bits(spark):
    from txclean.operators.audit import _changes_per_key

    counts = spark.createDataFrame(
        [("k", "x", 5_000_000_000, 0), ("k", "X", 0, 5_000_000_000)],
        "key string, value string, before long, after long",
    )
    assert int(_changes_per_key(counts, ["key"]).first().changes) == 25 * 10**18


def test_fills(spark):
    before = spark.createDataFrame(
        [("a", None), ("a", None), ("b", 1), ("c", None), (None, None)], "id string, n int"
    )
    after = spark.createDataFrame([("a", 5), ("b", 1), ("c", None), (None, 2)], "id string, n int")
    assert entries(audit_fills(before, after, "id", "n", NOTE)) == {("a", None, "5"): 2}
    assert total(count_fills(before, after, "id", "n", NOTE)) == 2


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("a", 2)] * 2 + [("b", None)] * 2 + [("c", 1)], "id string, n int")
    log = audit_duplicates(df, ["id", "n"], "id", "found", "gone", NOTE)
    assert entries(log) == {("a", "found", "gone"): 3, ("b", "found", "gone"): 1}
    assert total(count_duplicates(df, ["id", "n"], NOTE)) == 4


def test_predicate_is_literal(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "id string, n int")
    log = audit_predicate(df, F.col("n") > 2, "id", F.col("n"), F.lit(None), NOTE)
    assert entries(log) == {("c", "3", None): 1}


@pytest.mark.parametrize("slices", [1, 7, 4096])
def test_ids_are_dense_and_in_runs(rows, slices):
    log = audit_changes(*stages(rows), "id", "name", NOTE)
    numbered = number_entries(log.unionByName(log), slices)
    each = repeat_rows(numbered, F.col("entries"), number="i")
    ids = sorted(int(r.log_id) + r.i for r in each.collect())
    assert ids == list(range(1, 2 * joined(ROWS).total() + 1))
    assert numbered.where("changed_at is null").count() == 0
    assert numbered.select("changed_at").distinct().count() == 1


def test_summary_and_report(rows):
    log = audit_changes(*stages(rows), "id", "name", NOTE)
    report = cleaning_report(summarise_audit(log)).collect()
    assert [tuple(r) for r in report] == [("Stage", "Reason", joined(ROWS).total())]


def test_row_changes_compare_values_not_their_texts(spark):
    df = spark.sql(
        "SELECT 1 AS id, CAST(1.5 AS DECIMAL(12,1)) AS old, CAST(1.50 AS DECIMAL(12,2)) AS new "
        "UNION ALL SELECT 2, CAST(NULL AS DECIMAL(12,1)), CAST(2 AS DECIMAL(12,2)) UNION ALL SELECT 3, NULL, NULL"
    )
    note = audit.Note("amount", "stage", "reason")
    assert [r.transaction_id for r in audit.audit_row_changes(df, "id", [("old", "new", note)]).collect()] == [2]
