from __future__ import annotations

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txclean.functions import parse_mixed_timestamp, pg_initcap
from txclean.operators import classify_keywords, fix_precision, standardise_text
from txclean.plans import presets


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("nando's cafe", "Nando'S Cafe"),
        ("ETF Dividend", "Etf Dividend"),
        ("a-b c_d", "A-B C_D"),
        ("overdraft  fee", "Overdraft  Fee"),
        ("****", "****"),
        ("3m co", "3m Co"),
        ("x1y", "X1y"),
        ("--a", "--A"),
        ("a\tb", "A\tB"),
        ("o'NEIL-smith/jr", "O'Neil-Smith/Jr"),
        ("straße ßa", "Straße ßa"),
        ("ŉx", "ŉx"),
        ("ﬁsh ﬀ-ﬆA", "ﬁsh ﬀ-ﬆa"),
        ("ΣΟΦΟΣ σας ςα", "Σοφοσ Σας Σα"),
        ("ΐα ᾳβ", "ΐα ᾼβ"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap(spark, text, expected):
    assert column(spark, [text]).select(pg_initcap(F.col("x"))).first()[0] == expected


def test_initcap_against_the_rule(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abXY09 -_'.\t*é", k=rng.randint(0, 12))) for _ in range(500)]
    got = [r[1] for r in column(spark, texts).select("x", pg_initcap(F.col("x"))).collect()]
    words = re.compile(r"[^\W_]+")
    expected = [words.sub(lambda m: m[0][0].upper() + m[0][1:].lower(), t) for t in texts]
    assert got == expected


def test_trim_strips_spaces_only(spark):
    df = standardise_text(column(spark, ["  a ", "\ta ", "a\n"]), trim=["x"])
    assert [r.x for r in df.collect()] == ["a", "\ta", "a\n"]


def test_precision_rounds_half_up(spark):
    df = fix_precision(column(spark, ["1.005", "-2.675", "1.5"]), {"x": "decimal(12,2)"})
    assert [r.x for r in df.collect()] == [Decimal("1.01"), Decimal("-2.68"), Decimal("1.50")]


@pytest.mark.parametrize("zone", ["UTC", "Europe/London", "America/New_York"])
def test_mixed_dates_do_not_depend_on_the_zone(spark, zone):
    texts = [
        "2025-03-30 01:30:00",  # does not exist on London clocks
        "09/03/2025 02:30",  # nor this one in New York
        "2025/12/31 23:59:59",
        "28-02-2025 06:00:01",
        "Nov 05, 2025 12:05 AM",
        "31/02/2025 10:00",
        "junk",
        "",
        None,
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = column(spark, texts).select(parse_mixed_timestamp(F.col("x")).cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in rows] == [
        "2025-03-30 01:30:00",
        "2025-03-09 02:30:00",
        "2025-12-31 23:59:59",
        "2025-02-28 06:00:01",
        "2025-11-05 00:05:00",
        None,
        None,
        None,
        None,
    ]


def classify(spark, texts):
    df = classify_keywords(column(spark, texts), "x", presets.CATEGORY_RULES)
    return [r.x for r in df.collect()]


def test_categories(spark):
    cases = {
        "Bank transfer": "Bank Fees",
        "Streaming / Subscriptions": "Subscriptions",
        "Retail": "Online Shopping",
        "Rent / Mortgage": "Rent / Mortgages",
        "Healthcare": "Personal Care",
        "department store": "Groceries",
        "Adopted": "Corrupted",
        "Pending": "Pending",
        "FINANCIAL": "FINANCIAL",
        None: None,
    }
    assert classify(spark, list(cases)) == list(cases.values())


def test_categories_are_stable(spark):
    labels = [label for _, label in presets.CATEGORY_RULES]
    assert classify(spark, labels) == labels


def test_no_rules_keep_the_text(spark):
    assert classify_keywords(column(spark, ["a"]), "x", []).first().x == "a"
