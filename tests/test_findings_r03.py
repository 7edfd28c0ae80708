"""Faults found by the review of the third round."""

from __future__ import annotations

from pyspark.sql import functions as F

from txclean.operators.profile import inclusion_dependencies


def test_inclusions_hold_columns_as_bits(spark):
    df = spark.range(6).select(*(F.when(F.col("id") <= n % 5, F.col("id")).alias(f"c{n}") for n in range(70)))
    wide = df.withColumn("none", F.lit(None).cast("string")).withColumn("same", F.lit("2"))
    columns = {c: (wide, c) for c in wide.columns}
    found = inclusion_dependencies(columns)
    held = {c: {str(r[c]) for r in wide.collect()} - {"None"} for c in columns}
    wanted = {(a, b, len(held[a])) for a in held for b in held if a != b and held[a] and held[a] <= held[b]}
    assert {tuple(r) for r in found.collect()} == wanted and len(wanted) == found.count()
    # Nothing that grows with a value's columns is gathered, and values are shuffled once.
    plan = inclusion_dependencies({c: columns[c] for c in ("c0", "c1", "c2")})._jdf.queryExecution().toString()
    assert "collect_set" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning(value") <= 2
