"""Keyword rules as a table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from txclean.operators import classify_by_table, classify_keywords, keyword_matches, rule_use, rules_table
from txclean.plans import presets


@pytest.mark.parametrize("seed", range(3))
def test_table_and_expression_agree(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcé", k=rng.randint(1, 5))) for _ in range(30)]
    rules = [(words[n : n + 2], f"label {n}") for n in range(0, 30, 2)]
    texts = ["".join(rng.choices("abcdéAB ", k=rng.randint(0, 9))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(t, n, "x") for n, t in enumerate(texts)], "t string, text int, label string")
    table = rules_table(spark, rules)
    expected = {(r.text, r.out) for r in classify_keywords(df, "t", rules, out="out").collect()}
    got = classify_by_table(df, "t", table, out="out")
    assert got.columns == [*df.columns, "out"]
    assert {(r.text, r.out) for r in got.collect()} == expected
    pairs = {(r.text, r.rank) for r in keyword_matches(df, "t", table).collect()}
    assert pairs == {(t.lower(), n) for t in texts if t is not None for n, w in enumerate(words, 1) if w in t.lower()}


def test_empty_tables_and_odd_keywords(spark):
    df = spark.createDataFrame([("Ab", 1), (None, 2)], "t string, n int")
    none = rules_table(spark, [])
    assert [r.t for r in classify_by_table(df, "t", none).orderBy("n").collect()] == ["Ab", None]
    assert rule_use(df.where("false"), "t", rules_table(spark, [(["x"], "X")])).first().matched == 0
    every = rules_table(spark, [(["zzz"], "Z"), ([""], "all")])
    assert [r.t for r in classify_by_table(df, "t", every).orderBy("n").collect()] == ["all", None]


def test_hidden_rules_are_told(spark):
    df = spark.createDataFrame([("rent",), ("Rent and care",), ("rental",), ("else",)], "t string")
    rules = rules_table(spark, [(["rent"], "Rent"), (["care"], "Care"), (["rental"], "Rental"), (["none"], "None")])
    use = {r.keyword: (r.matched, r["first"]) for r in rule_use(df, "t", rules).collect()}
    assert use == {"rent": (3, 3), "care": (1, 0), "rental": (1, 0), "none": (0, 0)}


def test_many_rules_stay_out_of_the_plan(spark):
    rules = [([f"keyword{n}x"], f"label {n}") for n in range(10_000)]
    df = spark.range(0, 10_000, 7).select(F.concat(F.lit("a KEYWORD"), F.col("id").cast("string"), F.lit("x b")).alias("t"))
    labelled = classify_by_table(df, "t", rules_table(spark, rules), out="out")
    assert len(plan(labelled)) < 10_000
    wrong = labelled.where(F.col("out") != F.concat(F.lit("label "), F.regexp_extract("t", r"(\d+)", 1)))
    assert wrong.count() == 0 and labelled.count() == len(range(0, 10_000, 7))
    assert len(presets.CATEGORY_RULES) < 20
