from __future__ import annotations

import random
from contextlib import contextmanager

import pytest

from pyspark.sql import functions as F

from txclean.operators import correct_from_dictionary, correction_map, dictionary_matches
from txclean.plans import presets
from txclean.plans.pipeline import dictionary_from


@contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def random_names(alphabet: str, count: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 5))) for _ in range(count)]


def test_matches_equal_brute_force(spark):
    left = random_names("abA –", 300, 1)
    right = random_names("abB –", 60, 2)
    dictionary = dictionary_from(spark, {f"c{i}": [w] for i, w in enumerate(right)})
    got = {
        (r["name"], r.id, r.distance)
        for r in dictionary_matches(names(spark, left), "name", dictionary).collect()
    }
    expected = {
        (a, i, d)
        for a in set(left)
        for i, b in enumerate(right, 1)
        if (d := distance(a.lower(), b.lower())) <= 1
    }
    assert got == expected


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_one_winner_per_name_and_no_row_multiplied(spark, threshold):
    # "abc" is within 1 of all three entries: nearest first, then lowest id.
    dictionary = dictionary_from(spark, {"Far": ["abd"], "Near": ["abc"], "Later": ["ABC"]})
    rows = ["abc", "abc", "abe", "zzz", "", None] + ["Abc"] * 50
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", threshold):
        out = correct_from_dictionary(names(spark, rows), "name", dictionary)
        got = sorted("-" if r["name"] is None else r["name"] for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert got == sorted(["Near", "Near", "Far", "zzz", "", "-"] + ["Near"] * 50)
    assert ("BroadcastHashJoin" in plan) == (threshold != "-1")


def test_transposition_needs_an_entry(spark):
    dictionary = dictionary_from(spark, {"Target": ["target"]})
    assert correction_map(names(spark, ["targte"]), "name", dictionary).count() == 0


def test_length_guard(spark):
    dictionary = dictionary_from(spark, {"Ab": ["ab"]})
    matches = dictionary_matches(names(spark, ["abc", "ab"]), "name", dictionary, max_len_diff=0)
    assert [r["name"] for r in matches.collect()] == ["ab"]


def test_known_spellings_lead_to_their_clean_name(spark):
    dictionary = dictionary_from(spark, presets.MERCHANT_SPELLINGS)
    assert dictionary.count() == 142
    expected = {d: c for c, ds in presets.MERCHANT_SPELLINGS.items() for d in ds}
    got = correction_map(names(spark, expected), "name", dictionary).collect()
    assert {r["name"]: r.clean_name for r in got} == expected


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_matches_at_a_distance_equal_all_pairs(spark, distance):
    import random

    from txclean.operators import dictionary_matches

    rng = random.Random(distance)
    words = {"".join(rng.choices("abB", k=rng.randint(0, 9))) for _ in range(120)} | {"é", "İx", "x" * 5000}
    names, known = sorted(words)[::2], sorted(words)[1::2] + ["ab", ""]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    dictionary = spark.createDataFrame(
        [(n, "clean", w) for n, w in enumerate(known)], "id int, clean_name string, dirty_name string"
    )
    table = spark.createDataFrame([(w,) for w in names] + [(None,)], "name string")
    got = {(r.name, r.id, r.distance) for r in dictionary_matches(table, "name", dictionary, max_len_diff=2, distance=distance).collect()}
    expected = {
        (a, n, d)
        for a in names
        for n, b in enumerate(known)
        if abs(len(a) - len(b)) <= 2 and (d := edits(a.lower(), b.lower())) <= distance
    }
    assert got == expected


def test_keys_of_a_name_do_not_grow_with_it(spark):
    from txclean.functions import shifted_segment_keys

    table = spark.createDataFrame([("a" * 10,), ("a" * 100_000,)], "name string")
    sizes = [r[0] for r in table.select(F.size(shifted_segment_keys(F.col("name"), 2))).collect()]
    assert max(sizes) <= 75
