from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txclean.operators import (
    ConstraintViolation,
    apply_constraints,
    check,
    check_in_set,
    check_length,
    check_not_null,
    check_unique,
    primary_key,
    violation_counts,
)

def rate_rule():
    same = F.col("cur") == F.col("orig")
    return (same & F.col("rate").isNull()) | (~same & F.col("rate").isNotNull())


def test_a_check_is_broken_only_where_false(spark):
    rows = [
        ("G", "G", None),
        ("G", "G", 1),  # broken
        ("G", "U", 1),
        ("G", "U", None),  # broken
        (None, "U", 1),  # unknown
        (None, "U", None),  # unknown
    ]
    df = spark.createDataFrame(rows, "cur string, orig string, rate int")
    broken = check("rate", rate_rule()).violations(df).collect()
    assert {tuple(r) for r in broken} == {rows[1], rows[3]}


def test_length_ignores_trailing_spaces(spark):
    df = spark.createDataFrame([("abc",), ("abc   ",), ("abcd",), (None,)], "x string")
    assert [r.x for r in check_length("x", 3).violations(df).collect()] == ["abcd"]


@pytest.fixture
def rows(spark):
    data = [("a", 1), ("a", 2), ("b", 0), ("c", None), (None, 5), (None, 0), ("d", 3)]
    return spark.createDataFrame(data, "id string, n int")


@pytest.fixture
def rules(spark):
    return [*primary_key(["id"]), check("nonzero", F.col("n") != 0)]


def pairs(df):
    return {(r.id, r.n) for r in df.collect()}


def test_unique_lets_nulls_pass(rows):
    assert [tuple(r) for r in check_unique(["id"]).violations(rows).collect()] == [("a", 2)]
    assert check_not_null(["id"]).violations(rows).count() == 2


def test_quarantine(rows, rules):
    result = apply_constraints(rows, rules)
    assert pairs(result.valid) == {("c", None), ("d", 3)}
    failed = {(r.id, r.n): r.failed_rules for r in result.quarantined.collect()}
    assert failed == {
        ("a", 1): ["unique(id)"],
        ("a", 2): ["unique(id)"],
        ("b", 0): ["nonzero"],
        (None, 5): ["not_null(id)"],
        (None, 0): ["not_null(id)", "nonzero"],
    }


def test_drop_and_flag(rows, rules):
    assert pairs(apply_constraints(rows, rules, "drop").valid) == {("c", None), ("d", 3)}
    flagged = apply_constraints(rows, rules, "flag").valid
    assert flagged.count() == 7
    assert flagged.where(F.size("failed_rules") == 0).count() == 2


def test_fail(rows, rules):
    with pytest.raises(ConstraintViolation) as error:
        apply_constraints(rows, rules, "fail")
    assert error.value.counts == {"not_null(id)": 2, "unique(id)": 2, "nonzero": 2}
    good = rows.where("id = 'd'")
    assert pairs(apply_constraints(good, rules, "fail").valid) == {("d", 3)}


def test_later_load_is_held_against_the_table(rows, rules):
    existing = rows.where("n = 3")
    batch = rows.sparkSession.createDataFrame([("d", 9), ("e", 1)], "id string, n int")
    result = apply_constraints(batch, rules, existing=existing)
    assert pairs(result.valid) == {("e", 1)}
    with pytest.raises(ConstraintViolation):
        apply_constraints(batch, rules, "fail", existing=existing)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_hot_key(spark, rules, threshold):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit(1).alias("n"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        result = apply_constraints(df, rules)
        assert (result.valid.count(), result.quarantined.count()) == (2000, 1000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_violation_counts(rows, rules):
    counts = {r.rule: r.violations for r in violation_counts(rows, rules).collect()}
    assert counts == {"not_null(id)": 2, "unique(id)": 1, "nonzero": 2}


def test_in_set(rows):
    assert pairs(check_in_set("n", [1, 2, 3]).violations(rows)) == {("b", 0), (None, 5), (None, 0)}


def test_unknown_policy(rows, rules):
    with pytest.raises(ValueError):
        apply_constraints(rows, rules, "ignore")
