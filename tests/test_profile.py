from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from txclean.operators import (
    enrich,
    explode_labels,
    functional_dependency,
    inclusion_dependencies,
    inject_copies,
    label_profile,
    row_counts,
    sample_rows,
    unmatched,
)


@pytest.mark.parametrize("fraction, expected", [(0.05, 50), (0.5, 500), (1.0, 1000), (0.0, 0), (0.0004, 0)])
def test_sample_size_is_exact(spark, fraction, expected):
    df = spark.range(1000)
    sample = sample_rows(df, fraction, by=["id"])
    assert sample.count() == sample.distinct().count() == expected


def test_sample_does_not_depend_on_partitions_but_on_seed(spark):
    df = spark.range(1000)
    one = set(sample_rows(df.repartition(7), 0.1).collect())
    assert one == set(sample_rows(df.coalesce(1), 0.1).collect())
    assert one != set(sample_rows(df, 0.1, seed=2).collect())


def test_sample_takes_part_of_a_group_of_copies(spark):
    df = spark.range(1000).select(F.lit("same").alias("x"))
    assert sample_rows(df, 0.3).count() == 300


def test_inject_copies(spark):
    counts = Counter(r.id for r in inject_copies(spark.range(200), 0.05).collect())
    assert len(counts) == 200 and Counter(counts.values()) == {1: 190, 2: 10}


def test_labels(spark):
    df = spark.createDataFrame([("a;b",), ("a",), ("",), (None,), ("b;a",)], "errors string")
    assert explode_labels(df, "errors").count() == 5
    assert {r.label: r.rows for r in label_profile(df, "errors").collect()} == {"a": 3, "b": 2}


def test_lookups(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "name string, code int")
    ref = spark.createDataFrame([("x", 1, "one"), ("y", 3, "two")], "name string, code int, label string")
    rows = enrich(df, ref.drop("code"), "name").collect()
    assert {(r["name"], r.label) for r in rows} == {("x", "one"), ("y", "two"), (None, None)}
    assert {r.code for r in unmatched(df, ref, ["name", "code"]).collect()} == {2, 3}


def test_row_counts(spark):
    counts = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {r.stage: r.rows for r in counts.collect()} == {"a": 3, "b": 0}


@pytest.mark.parametrize("small", [0, 3, 50_000])
def test_selection_at_the_edge(spark, small):
    """One value of `by` on all rows, copies among them, and a map column."""
    df = spark.range(3000).selectExpr(
        "1 AS by", "id % 700 AS n", "map('k', id % 700, 'j', 1) AS m", "CAST(NULL AS STRING) AS empty"
    )
    sample = sample_rows(df, 0.3, by=["by"], small=small)
    counts = Counter(r.n for r in sample.collect())
    every = Counter(i % 700 for i in range(3000))
    assert sample.columns == df.columns and sum(counts.values()) == 900
    # Whole groups of copies, but for the one at the edge.
    assert sum(counts[n] not in (0, every[n]) for n in every) <= 1
    other = sample_rows(df.repartition(5).withColumn("m", F.expr("map_from_entries(reverse(map_entries(m)))")), 0.3, by=["by"], small=small)
    assert Counter(r.n for r in other.collect()) == counts


def test_copies_at_the_edge_are_written_out_by_many(spark):
    df = spark.range(200_000).select(F.lit("same").alias("x"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
    sample = sample_rows(df, 0.5, small=10)
    assert sample.count() == 100_000


def test_enrich_with_repeated_keys(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "name string")
    ref = spark.createDataFrame([("x", 2), ("x", 1), ("y", None), (None, 1), (None, 2)], "name string, code int")
    with pytest.raises(Exception, match='more than once: {"name":"x"}'):
        enrich(df, ref, "name").collect()
    assert enrich(df, ref.where("code IS NULL OR code = 2"), "name").count() == 3
    assert enrich(df, ref.drop("code"), "name").count() == 3
    rows = [tuple(r) for r in enrich(df, ref, "name", repeated="first").collect()]
    assert sorted(rows, key=str) == sorted([("x", 1), ("y", None), (None, None)], key=str)
    assert enrich(df, ref, "name", repeated="all").count() == 4
    with pytest.raises(ValueError, match="unknown way"):
        enrich(df, ref, "name", repeated="any")


def test_functional_dependency(spark):
    rows = [("a", 1, "p"), ("a", 2, "q"), ("a", 2, "q"), ("b", 1, "p"), ("b", 1, "p"), (None, None, "p"), (None, 1, "p")]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    got = {r.k: (r["values"], r.rows, r.least.n, r.greatest.n) for r in functional_dependency(df, ["k"], ["n", "t"]).collect()}
    assert got == {"a": (2, 3, 1, 2), None: (2, 2, None, 1)}
    assert functional_dependency(df, ["k", "n"], ["t"]).count() == 0
    assert functional_dependency(df.where("false"), ["k"], ["n"]).count() == 0


def test_inclusion_dependencies(spark):
    one = spark.createDataFrame([(1, 1), (2, None), (2, 2), (3, None)], "a int, b int")
    two = spark.createDataFrame([("1", None), ("2", None)], "c string, d int")
    found = inclusion_dependencies({"a": (one, "a"), "b": (one, "b"), "c": (two, "c"), "d": (two, "d")})
    assert {tuple(r) for r in found.collect()} == {("b", "a", 2), ("c", "a", 2), ("b", "c", 2), ("c", "b", 2)}
