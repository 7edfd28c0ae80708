from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from txclean import bank_transactions, clean, dictionary_from
from txclean.plans import presets
from txclean.sources import (
    TRANSACTION_LENGTHS,
    TRANSACTION_SCHEMA,
    conform,
    read_transactions,
    write_relations,
)

SCHEMA = "a string, d decimal(16,2), t timestamp_ntz"


@pytest.fixture
def csv(spark, tmp_path):
    def read(text, schema=SCHEMA, **options):
        path = tmp_path / "in.csv"
        path.write_text(text, encoding="utf-8")
        return read_transactions(spark, str(path), schema, **options)

    return read


def test_fields(csv):
    text = 'x,y,z\n x ,1.2345,2025-01-02 03:04:05\n"q""z",9.995,\n"",,\n,,\n"a,b",-1,2025-01-02 00:00:00\n'
    rows = [tuple(r) for r in csv(text).collect()]
    assert rows == [
        (" x ", Decimal("1.23"), datetime.datetime(2025, 1, 2, 3, 4, 5)),
        ('q"z', Decimal("10.00"), None),
        ("", None, None),
        (None, None, None),
        ("a,b", Decimal("-1.00"), datetime.datetime(2025, 1, 2)),
    ]


def test_columns_go_by_position_not_by_name(csv):
    assert csv("d,a,q\nx,1,\n").first().a == "x"


@pytest.mark.parametrize(
    "line", ["x,zz,", "x,1,notadate", "x,1", "x,1,,extra", 'x,"",'], ids=str
)
def test_bad_rows_stop_the_load(csv, line):
    with pytest.raises(Exception, match="(?i)malformed"):
        csv(f"a,d,t\nx,1,\n{line}\n")


def test_line_breaks_in_quotes(csv):
    text = 'a,d,t\n"x\ny",1,\n'
    assert csv(text, multiline=True).first().a == "x\ny"
    with pytest.raises(Exception, match="(?i)malformed"):
        csv(text)
    # The parts of a broken line fill the columns by themselves.
    with pytest.raises(ValueError, match="leaves a quote open"):
        csv('a,b\n1,"x\n2,y"\n', schema="a int, b string")


def test_lengths(csv):
    text = "a,d,t\nabc,,\nab    ,,\n"
    assert [r.a for r in csv(text, lengths={"a": 3}).collect()] == ["abc", "ab "]
    with pytest.raises(Exception, match="value too long for a"):
        csv("a,d,t\nabcd,,\n", lengths={"a": 3})


def test_load_to_a_named_table(spark, csv, tmp_path):
    table = f"{tmp_path}/loaded"
    loaded = csv("a,d,t\nx,1,\n", table=table)
    assert loaded.collect() == spark.read.parquet(table).collect()


def test_conform(spark):
    df = spark.createDataFrame([("1.005", "x")], "MerchantAmount string, MerchantName string")
    out = conform(
        df, {"MerchantName": ("merchant_name", "string"), "MerchantAmount": ("amount", "decimal(12,2)")}
    )
    assert out.columns == ["merchant_name", "amount"]
    assert tuple(out.first()) == ("x", Decimal("1.01"))


def test_relations_come_back_as_written(spark, tmp_path):
    tables = {
        "accounts": spark.createDataFrame([("A001", "GBP")], "account_id string, currency string"),
        "codes": spark.createDataFrame([(5812, None)], "code int, name string"),
    }
    write_relations(tables, str(tmp_path))
    write_relations({"codes": tables["codes"]}, str(tmp_path), mode="append")
    assert spark.read.parquet(f"{tmp_path}/accounts").collect() == tables["accounts"].collect()
    assert spark.read.parquet(f"{tmp_path}/codes").count() == 2


def line(number, amount, merchant, category, currency="GBP", rate="", actual=None, date="2025-03-01 10:00:00"):
    return ",".join(
        [
            "A001", f"T{number:06d}", f"O{number:07d}", date, date, "",
            str(amount), str(amount) if actual is None else actual, currency, "GBP", rate,
            "Debit", "5812", "BTC123", "PBC123", f"REF{number}", "100.00", "", "", "Booked",
            merchant, category,
        ]
    )


def test_whole_run_from_csv(spark, csv, tmp_path):
    lines = [
        ",".join(TRANSACTION_SCHEMA.names),
        line(1, -5, " starbukcs ", "Food & Drink"),
        line(1, -5, " starbukcs ", "Food & Drink"),
        line(2, "-9.50", "nando's", " Retail ", actual=""),
        line(3, -100, "payroll  ltd", "Income"),
        line(4, 0, "", "FINANCIAL"),
        line(5, 7, "EE", "Utilities", currency="USD"),
        line(6, 7, "Lyft", "Transport", date="2026-01-01 00:00:00"),
    ]
    raw = csv("\n".join(lines) + "\n", schema=TRANSACTION_SCHEMA, lengths=TRANSACTION_LENGTHS)
    config = bank_transactions(dictionary_from(spark, presets.MERCHANT_SPELLINGS))
    run = clean(raw, config)
    final = {r.TransactionId: r for r in run.final.collect()}
    assert len(final) == 6
    assert len(run.final.columns) == 21 and "RawDateString" not in run.final.columns
    # One letter more than the listed spelling "Starbuks".
    assert final["T000001"].merchant_name == "Starbucks"
    assert (final["T000002"].merchant_name, final["T000002"].category) == ("Nando'S", "Online Shopping")
    assert final["T000002"].TransactionAmount == Decimal("-9.50")
    assert (final["T000003"].merchant_name, final["T000003"].category) == ("PAYROLL LTD", "Income Reversal")
    assert (final["T000004"].merchant_name, final["T000004"].category) == (None, "FINANCIAL")

    failed = {r.TransactionId: r.failed_rules for r in run.enforce().quarantined.collect()}
    assert failed == {
        "T000004": ["nonzero_amount"],
        "T000005": ["exchange_rate_logic"],
        "T000006": ["valid_booking_date", "valid_value_date"],
    }

    report = {r["Reason For Change"]: int(r["Total Rows Changed"]) for r in run.report().collect()}
    assert report == {
        presets.MERCHANT_NOTE.reason: 4 + 3,  # two copies, and T2, T3, T5 ("Ee")
        presets.CATEGORY_NOTE.reason: 1,
        presets.FILL_NOTE.reason: 1,
        presets.DUPLICATE_NOTE.reason: 1,
        presets.RATE_NOTE.reason: 5,
        presets.DATE_NOTE.reason: 1,
    }

    stored = run.materialise(str(tmp_path / "stages"))
    assert sorted(stored.report().collect()) == sorted(run.report().collect())
    assert stored.duplicates().count() == 1
    stored.publish("cleaned_data")
    assert spark.sql("select count(*) from cleaned_data").first()[0] == 6
    assert {r.stage: r.rows for r in stored.row_counts().collect()} == {
        "raw": 7, "staging": 7, "deduped": 6, "final": 6
    }


def test_keys_must_fit_the_audit(spark):
    dictionary = dictionary_from(spark, {"A": ["a"]})
    from txclean import CleaningConfig

    with pytest.raises(ValueError, match="lack"):
        CleaningConfig(keys=["TransactionId"], dictionary=dictionary)
    with pytest.raises(ValueError, match="contain"):
        CleaningConfig(keys=TRANSACTION_SCHEMA.names, dictionary=dictionary)
