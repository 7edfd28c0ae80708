from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_correct import setting
from txclean.operators import deduplicate, dedup, duplicates, repeat_rows, with_row_num

ROWS = [
    ("k1", None, "b"),
    ("k1", None, "a"),
    ("k1", None, "a"),
    ("k2", 1, None),
    ("k2", 1, "z"),
    (None, None, "n"),
    (None, None, "n"),
    ("k3", 1, "only"),
] + [("hot", 7, f"v{i % 40:02d}") for i in range(400)]


@pytest.fixture(params=[3, 100_000])
def rows(request, spark, monkeypatch):
    monkeypatch.setattr(dedup, "PIECE", request.param)
    return spark.createDataFrame(ROWS, "k string, n int, v string").repartition(5)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_numbers_follow_the_tiebreak(spark, rows, coalesce):
    # Without coalescing, groups lie across the slices of the range partitioning.
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", coalesce):
        got = bag(with_row_num(rows, ["k", "n"], ["v"]))
    groups: dict = {}
    for row in sorted(ROWS, key=lambda r: (r[2] is not None, r[2] or "")):
        groups.setdefault(row[:2], []).append(row)
    expected = Counter(
        (*row, i) for group in groups.values() for i, row in enumerate(group, 1)
    )
    assert got == expected


def test_survivors_and_duplicates_make_the_input(rows):
    kept = deduplicate(rows, ["k", "n"], ["v"])
    later = duplicates(rows, ["k", "n"], ["v"])
    assert bag(kept) + bag(later.drop("row_num")) == Counter(ROWS)
    assert kept.count() == len({r[:2] for r in ROWS})
    assert bag(kept)[("k1", None, "a")] == 1
    assert later.where("row_num < 2").count() == 0


def test_deduplicate_again_changes_nothing(rows):
    once = deduplicate(rows, ["k", "n"], ["v"])
    assert bag(deduplicate(once, ["k", "n"], ["v"])) == bag(once)
    assert duplicates(once, ["k", "n"], ["v"]).count() == 0


def test_repeat_rows(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PIECE", 10)
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 1)], "x string, n int")
    out = repeat_rows(df, F.col("n"), number="i")
    assert bag(out.select("x", "i")) == Counter([("a", i) for i in range(25)] + [("c", 0)])


@pytest.mark.parametrize("tiebreak", [[], ["v"], ["w"]])
def test_survivors_and_duplicates_make_up_the_table(spark, tiebreak):
    rows = [("k", f"v{n}", n % 2) for n in range(4)] + [(None, "v", 1), (None, "v", 1), ("a", None, 0)]
    df = spark.createDataFrame(rows, "k string, v string, w int").repartition(3)
    kept = deduplicate(df, ["k"], tiebreak).collect()
    listed = duplicates(df, ["k"], tiebreak).drop("row_num").collect()
    assert len(kept) == 3
    assert sorted(map(str, kept + listed)) == sorted(str(r) for r in df.collect())
