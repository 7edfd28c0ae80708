"""What is kept from load to load: the ledger of entries, and the index of keys."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from txclean.operators import (
    AuditLedger,
    KeyIndex,
    apply_constraints,
    audit_changes_within,
    audit_factors,
    check_unique,
    count_changes_within,
    count_factors,
    expand_factors,
    number_entries,
    repeat_rows,
)
from txclean.operators import numbering
from txclean.operators.audit import Note
from txclean.shared import exists, release, shared_table

NOTE = Note("name", "Stage", "Reason")
ENTRY = (
    "transaction_id string, column_changed string, old_value string, new_value string, "
    "change_stage string, change_reason string, entries decimal(38,0)"
)


def entries(spark, *rows):
    data = [(i, "c", old, None, "s", "r", n) for i, old, n in rows]
    return spark.createDataFrame(data, ENTRY.replace("decimal(38,0)", "int")).withColumn(
        "entries", F.col("entries").cast("decimal(38,0)")
    )


def ids(log):
    each = repeat_rows(log, F.col("entries"), number="i")
    return sorted(int(r.log_id) + r.i for r in each.collect())


# Ledger


def test_appends_go_on_without_gaps_and_replays_add_nothing(spark, tmp_path):
    ledger = AuditLedger(spark, str(tmp_path / "ledger"))
    assert ledger.read().count() == 0 and ledger.last_id() == 0
    first = entries(spark, ("b", "x", 3), ("a", None, 1), ("b", "x", 2), (None, "y", 4))
    assert ledger.append(first, "one")
    assert not ledger.append(first, "one") and not ledger.append(entries(spark, ("z", "z", 9)), "one")
    assert ledger.append(entries(spark), "nothing") and not ledger.append(first, "nothing")
    assert ledger.append(first, "two")
    assert ids(ledger.read()) == list(range(1, 21)) and ledger.last_id() == 20
    by_batch = {b: ids(ledger.read().where(F.col("batch") == b)) for b in ("one", "two")}
    assert by_batch == {"one": list(range(1, 11)), "two": list(range(11, 21))}
    marks = [(r.sequence, r.batch, int(r.first_id), int(r.last_id), r.rows) for r in ledger.batches().orderBy("sequence").collect()]
    assert marks == [(1, "one", 1, 10, 3), (2, "nothing", 11, 10, 0), (3, "two", 11, 20, 3)]
    # Another ledger on the folder goes on from there.
    again = AuditLedger(spark, str(tmp_path / "ledger"))
    assert again.append(entries(spark, ("c", "q", 1)), "three") and again.last_id() == 21


def test_a_batch_that_broke_off_is_not_seen(spark, tmp_path):
    ledger = AuditLedger(spark, str(tmp_path / "ledger"))
    ledger.append(entries(spark, ("a", "x", 2)), "one")
    # Entries without a mark, and a mark that was begun.
    number_entries(entries(spark, ("b", "x", 5)), first_id=3).write.parquet(str(tmp_path / "ledger/entries/lost"))
    (tmp_path / "ledger/marks/000000000002/_temporary").mkdir(parents=True)
    assert ids(ledger.read()) == [1, 2]
    assert ledger.append(entries(spark, ("b", "x", 5)), "two")
    assert ids(ledger.read()) == list(range(1, 8))


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    ledger = AuditLedger(spark, str(tmp_path / "ledger"))
    ledger.append(entries(spark, ("a", "x", 2)), "one")
    stale = ledger.batches().where("false")
    other = AuditLedger(spark, str(tmp_path / "ledger"))
    monkeypatch.setattr(other, "batches", lambda: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        other.append(entries(spark, ("b", "x", 1)), "two")
    assert ids(ledger.read()) == [1, 2]


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_ids_over_many_slices(spark, monkeypatch, block):
    monkeypatch.setattr(numbering, "BLOCK", block)
    log = spark.range(500).select(
        (F.col("id") % 170).cast("string").alias("transaction_id"), F.lit("c").alias("column_changed"),
        F.col("id").cast("string").alias("old_value"), (F.col("id") % 3 + 1).cast("decimal(38,0)").alias("entries"),
    )
    numbered = number_entries(log, first_id=1000, rows_per_slice=40)
    total = sum(i % 3 + 1 for i in range(500))
    assert ids(numbered) == list(range(1000, 1000 + total))
    rows = numbered.orderBy("log_id").collect()
    assert [(r.transaction_id, r.old_value) for r in rows] == sorted((r.transaction_id, r.old_value) for r in rows)


# Factors


def pairs(log):
    return sorted(
        ((r.transaction_id, r.column_changed, r.old_value, r.new_value, int(r.entries)) for r in log.collect()), key=str
    )


def test_values_on_shared_ids_are_compared_by_value(spark):
    df = spark.sql(
        "SELECT id, CAST(o AS DECIMAL(12,1)) AS old, CAST(n AS DECIMAL(12,2)) AS new, "
        "CAST(d AS DOUBLE) AS d_old, CAST(e AS FLOAT) AS d_new, CAST(t AS TIMESTAMP) AS t_old, CAST(u AS TIMESTAMP) AS t_new "
        "FROM VALUES ('x', 1.5, 1.50, 0.5, 0.5, '2024-01-01', '2024-01-01 00:00:00'), "
        "('x', 2.0, 1.50, -0.0, 0.0, '2024-01-02', '2024-01-01') AS v(id, o, n, d, e, t, u)"
    )
    changes = [("old", "new", NOTE), ("d_old", "d_new", Note("d", "S", "R")), ("t_old", "t_new", Note("t", "S", "R"))]
    expected = [
        ("x", "d", "-0.0", "0.5", 1), ("x", "d", "0.0", "0.5", 1), ("x", "d", "0.5", "0.0", 1),
        ("x", "name", "2.0", "1.50", 2), ("x", "t", "2024-01-02 00:00:00", "2024-01-01 00:00:00", 2),
    ]
    log = audit_changes_within(df, "id", changes)
    assert pairs(log) == [e for e in expected if e[2] != "-0.0"]
    counted = {r.column_changed: int(r.number_of_changes) for r in count_changes_within(df, "id", changes).collect()}
    assert counted == {"name": 2, "d": 2, "t": 2}
    factors = audit_factors(df, "id", changes)
    assert pairs(expand_factors(factors)) == pairs(log)
    assert {r.column_changed: int(r.number_of_changes) for r in count_factors(factors).collect()} == counted


def test_factors_give_the_pairs_of_the_definition(spark):
    rng = random.Random(2)
    rows = [
        (rng.choice(["a", "b", "c", None, f"own{n}"]), rng.choice(["x", "y", None]), rng.choice(["x", "z", None]), rng.randint(1, 3))
        for n in range(80)
    ]
    df = spark.createDataFrame(rows, "id string, old string, new string, extra int")
    changes = [("old", "new", NOTE), ("extra", "extra", Note("extra", "S", "R"))]
    log = audit_changes_within(df, "id", changes)
    factors = audit_factors(df, "id", changes)
    assert pairs(expand_factors(factors)) == pairs(log)
    key = lambda r: (r.column_changed, int(r.number_of_changes))
    assert sorted(map(key, count_factors(factors).collect())) == sorted(map(key, count_changes_within(df, "id", changes).collect()))
    assert audit_factors(df.where("false"), "id", changes).count() == 0


def test_a_hot_id_has_linearly_many_factors(spark):
    many = 100_000
    df = spark.range(many).selectExpr("'hot' AS id", "concat('v', id) AS old", "concat('V', id) AS new")
    factors = shared_table(audit_factors(df, "id", [("old", "new", NOTE)]), "factors")
    assert factors.count() == 2 * many
    assert int(count_factors(factors).first().number_of_changes) == many * many


# Key index


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_only_touched_ranges_are_read(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "index"), ["k"], rows_per_range=100)
    assert index.matching(spark.createDataFrame([(1,)], "k long")).count() == 0
    assert index.merge(spark.range(0, 2000, 2).withColumnRenamed("id", "k"), "one")
    ranges = {r.folder: (r.low.k, r.rows) for r in index.ranges().collect()}
    assert len(ranges) >= 8 and sum(n for _, n in ranges.values()) == 1000
    wanted = spark.createDataFrame([(500,), (501,), (504,), (None,)], "k long")
    found = index.matching(wanted)
    assert as_set(found) == {(500,), (504,)}
    touched = {f.split("/keys/")[1].rsplit("/", 1)[0] for f in found.inputFiles()}
    low = max(k for k, _ in ranges.values() if k <= 500)
    high = max(k for k, _ in ranges.values() if k <= 504)
    assert {f for f in touched if f in ranges} == {f for f, (k, _) in ranges.items() if k in (low, high)}
    # A load at the end leaves all but the last range as they are.
    assert index.merge(spark.range(5000, 5400).withColumnRenamed("id", "k"), "two")
    assert not index.merge(spark.range(9).withColumnRenamed("id", "k"), "two")
    later = {r.folder for r in index.ranges().collect()}
    assert len(set(ranges) - later) == 1 and max(r.rows for r in index.ranges().collect()) <= 250
    assert index.vacuum() == 1
    assert index.matching(spark.range(6000).withColumnRenamed("id", "k")).count() == 1400


@pytest.mark.parametrize("seed", range(3))
def test_index_over_loads_equals_a_set(spark, tmp_path, seed):
    rng = random.Random(seed)
    index = KeyIndex(spark, str(tmp_path / "index"), ["a", "b"], rows_per_range=20)
    held: set = set()
    for load in range(4):
        low = rng.randint(0, 60)
        rows = [(rng.choice("pqé"), rng.randint(low, low + 30), "x") for _ in range(50)] + [(None, 1, "x"), ("p", None, "x")]
        table = spark.createDataFrame(rows, "a string, b int, folder string")
        keys = {(a, b) for a, b, _ in rows if a is not None and b is not None}
        assert as_set(index.matching(table)) == keys & held
        index.merge(table, f"load {load}")
        held |= keys
        assert sum(r.rows for r in index.ranges().collect()) == len(held)
    every = spark.createDataFrame([(a, b) for a in "opqéz" for b in range(-5, 100)], "a string, b int")
    assert as_set(index.matching(every)) == held
    index.merge(every.where("false"), "empty")
    assert as_set(index.matching(every)) == held


def test_constraints_by_index(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "index"), ["k"], rows_per_range=3)
    first = spark.createDataFrame([(n,) for n in range(10)], "k int")
    index.merge(first, "one")
    load = spark.createDataFrame([(3,), (11,), (12,), (12,), (None,)], "k int")
    rule = [check_unique(["k"])]
    for existing in (first, index):
        got = apply_constraints(load, rule, "quarantine", existing=existing)
        assert sorted(r.k for r in got.quarantined.collect()) == [3, 12, 12]
        assert sorted(str(r.k) for r in got.valid.collect()) == ["11", "None"]
    with pytest.raises(ValueError, match="index holds"):
        apply_constraints(load.withColumn("k2", F.lit(1)), [check_unique(["k", "k2"])], existing=index)


def test_release_removes_the_tables_of_the_run(spark):
    table = shared_table(spark.range(3), "released")
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    assert exists(spark, path)
    assert release(spark) > 0 and not exists(spark, path) and release(spark) == 0
