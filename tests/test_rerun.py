"""A run after few rows have changed, and the order of dates by evidence."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from txclean.catalogue import derived
from txclean.operators import date_order, parse_by_evidence
from txclean.plans.pipeline import clean
from txclean.plans.rerun import changed_keys, fingerprints, rerun
from txclean.shared import shared_table

SF_DIR = "/root/testdata/sf0.001"


def bag(df):
    return Counter(map(str, df.collect()))


def test_changed_keys(spark):
    before = [("a", 1), ("a", 1), ("b", 1), ("c", None), (None, 1), ("d", 1), ("e", 2)]
    after = [("a", 1), ("b", 1), ("c", None), (None, 2), ("e", 2), ("f", 1)]
    prints = [fingerprints(spark.createDataFrame(rows, "k string, n int"), "k") for rows in (before, after)]
    assert {r.key for r in changed_keys(*prints).collect()} == {"a", None, "d", "f"}
    assert changed_keys(prints[0], prints[0]).count() == 0


def test_a_rerun_equals_a_whole_run_and_cleans_changed_ids_only(spark):
    raw = shared_table(derived.raw_transactions(spark, SF_DIR), "raw")
    config = derived.config(spark)
    before = clean(raw, config)
    final, summary = shared_table(before.final, "final"), shared_table(before.summary(), "summary")
    number = F.substring("transaction_id", 2, 9).cast("long")
    after = shared_table(
        raw.where(number % 90 != 7)
        .withColumn("merchant_name", F.when(number % 100 == 3, "Tseco").otherwise(F.col("merchant_name")))
        .withColumn("transaction_id", F.when(number % 300 == 5, None).otherwise(F.col("transaction_id")))
        .unionByName(raw.where(number % 110 == 1)),
        "raw",
    )
    prints = shared_table(fingerprints(raw, config.id), "prints")
    again = rerun(raw, final, summary, after, config, prints_before=prints)
    whole = clean(after, config)
    assert bag(again.final) == bag(whole.final) != bag(final)
    assert bag(again.summary) == bag(whole.summary())
    touched = again.changed.count()
    assert 0 < again.part.raw.count() <= 3 * touched < raw.count() / 5
    same = rerun(raw, final, summary, raw, config)
    assert same.changed.count() == 0 and bag(same.final) == bag(final) and bag(same.summary) == bag(summary)


@pytest.mark.parametrize("low, order", [("1990-01-01", "undecided"), ("2024-06-01", "month")])
def test_order_of_dates(spark, low, order):
    rows = [
        ("day", "31/01/2025 10:00"), ("day", "02/03/2025 10:00"), ("day", "junk"), ("day", None),
        ("month", "01/31/2025 10:00"), ("month", "02/03/2025 10:00"),
        ("both", "31/01/2025 10:00"), ("both", "01/31/2025 10:00"), ("both", "02/03/2025 10:00"), ("both", "04/04/2025 10:00"),
        ("open", "12/01/2024 00:00"), ("open", "2025-02-03 10:00:00"), (None, "05-06-2025 10:00:00"),
    ]
    df = spark.createDataFrame(rows, "source string, t string")
    found = {r.source: r.order for r in date_order(df, "source", "t", low, "2040-01-01").collect()}
    assert found == {"day": "day", "month": "month", "both": "mixed", "open": order, None: "undecided"}
    parsed = {(r.source, r.t): str(r.parsed)[:10] for r in parse_by_evidence(df, "source", "t", low, "2040-01-01").collect()}
    assert len(parsed) == len(rows)
    assert parsed["day", "02/03/2025 10:00"] == "2025-03-02" and parsed["month", "02/03/2025 10:00"] == "2025-02-03"
    assert parsed["both", "02/03/2025 10:00"] == "None" and parsed["both", "01/31/2025 10:00"] == "2025-01-31"
    assert parsed["both", "04/04/2025 10:00"] == "2025-04-04" and parsed["day", "junk"] == "None"
    assert parsed["open", "12/01/2024 00:00"] == ("None" if order == "undecided" else "2024-12-01")
    assert parsed["open", "2025-02-03 10:00:00"] == "2025-02-03"
    assert date_order(df.where("false"), "source", "t", low, "2040-01-01").count() == 0
