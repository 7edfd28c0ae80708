"""Raw transactions derived from `orders`, with every kind of fault planted.

The rules are arithmetic on the order key (see FIXTURES.md), so the same rows can
be written in SQL, and the table grows with `orders`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txclean.plans import presets
from txclean.plans.pipeline import CleaningConfig, dictionary_from
from txclean.sources import TRANSACTION_SCHEMA

CUTOFF = "2001-01-01 00:00:00"

# Merchant names beside the clean ones of the dictionary.
OTHER_MERCHANTS = [
    "McDonalds", "Nando's", "Chipotle", "Lyft", "Walmart", "Lidl", "Whole Foods",
    "Spotify", "Apple TV", "Direct Deposit", "Upwork", "PayPal Transfer",
    "Interest Credit", "ETF Dividend", "Amazon Refund", "Expense Reimb.",
    "From Revolut", "Incoming Transfer", "RENT PAYMENT", "Water Bill", "Internet",
    "Car Insurance", "EE", "Vodafone", "Barber", "Credit Card Payment",
]

# Source categories.
CATEGORIES = [
    "Food & Drink", "Transport", "Fuel", "Groceries", "Streaming / Subscriptions",
    "Software / Subscriptions", "Fitness", "Online Shopping", "Clothing",
    "Home Furnishing", "Retail", "Income", "Rent / Mortgage", "Utilities",
    "Insurance", "Mobile / Telecom", "Personal Care", "Pending", "Reversal",
    "Bank Fees", "Financial", "Corrupted", "Missing",
]

KEYS = [
    "account_id",
    "transaction_id",
    "booking_datetime",
    "value_datetime",
    "instructed_amount",
    "transaction_amount",
    "currency",
    "original_currency",
    "exchange_rate",
]


def _variants(name: str) -> list[str]:
    """As is, lower case, and four kinds of typing error at fixed places."""
    if len(name) <= 3:
        return [name] * 6
    return [
        name,
        name.lower(),
        name[0] + name[2:],
        name[0] + name[2] + name[1] + name[3:],
        name[:2] + name[1:],
        name[0] + name[2] + name[4:],
    ]


MERCHANT_VARIANTS = [
    variant
    for name in [*presets.MERCHANT_SPELLINGS, *OTHER_MERCHANTS]
    for variant in _variants(name)
]


def swapped_spellings() -> dict[str, list[str]]:
    """Each clean name in lower case and with each two neighbours swapped."""

    def spellings(name: str) -> list[str]:
        name = name.lower()
        swaps = (
            name[:i] + name[i + 1] + name[i] + name[i + 2 :] for i in range(len(name) - 1)
        )
        return list(dict.fromkeys([name, *swaps]))

    return {name: spellings(name) for name in presets.MERCHANT_SPELLINGS}


def _pick(values: list[str], index: Column) -> Column:
    """The value at a position of a fixed list, null past its end; no join."""
    return F.get(F.split(F.lit("\n".join(values)), "\n"), index.cast("int"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered_copies(spark, sf_dir).drop("k", "copy")


def full_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 22 columns of the transaction table, with faults of its own: some ids are
    null, one row in a hundred has the same id, and some copies differ in merchant or
    category. What the raw transactions lack is told by their key columns, so that
    copies stay copies."""
    k, second = F.col("k"), F.col("copy") == 2
    instructed = F.col("instructed_amount")
    identity = F.when(k % 1511 == 0, None).when(k % 100 == 7, "T000000007").otherwise(F.col("transaction_id"))
    columns = {
        "AccountId": F.col("account_id"),
        "TransactionId": identity,
        "TransactionId_OBIE": F.concat(F.lit("O"), identity),
        "BookingDateTime": F.col("booking_datetime"),
        "ValueDateTime": F.col("value_datetime"),
        "RawDateString": F.date_format("booking_datetime", "dd/MM/yyyy HH:mm"),
        "InstructedAmount": instructed,
        "TransactionAmount": F.col("transaction_amount"),
        "Currency": F.col("currency"),
        "OriginalCurrency": F.col("original_currency"),
        "ExchangeRate": F.col("exchange_rate"),
        "TransactionType": F.when(instructed < 0, "Debit").otherwise("Credit"),
        "MerchantCategoryCode": F.when(instructed < 0, 5812),
        "BankTransactionCode": F.lit("BTC123"),
        "ProprietaryBankTransactionCode": F.lit("PBC123"),
        "Reference": F.concat(F.lit("REF"), identity),
        "Balance": instructed + 1,
        "CounterpartyName": F.lit(None),
        "CounterpartyAccount": F.lit(""),
        "Status": F.lit("Booked"),
        "merchant_name": F.when(second & (k % 40 == 0), "Other").otherwise(F.col("merchant_name")),
        "category": F.when(second & (k % 60 == 0), "Cash").otherwise(F.col("category")),
    }
    return _numbered_copies(spark, sf_dir).select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in TRANSACTION_SCHEMA)
    )


def _numbered_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    amount = (
        F.when(k % 997 == 0, F.lit(0))
        .when(k % 10 < 3, price)
        .otherwise(-price)
        .cast("decimal(12,2)")
    )
    number = F.when(k % 1999 == 1998, k - 1).otherwise(k)
    # One position past the end: no merchant.
    merchant = _pick(MERCHANT_VARIANTS, (k * 7) % (len(MERCHANT_VARIANTS) + 1))
    category = _pick(CATEGORIES, k % len(CATEGORIES))
    one_day = F.expr("INTERVAL '1' DAY")
    return (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .select(
            k.alias("k"),
            F.concat(F.lit("A00"), F.col("o_custkey") % 3 + 1).alias("account_id"),
            F.concat(F.lit("T"), F.lpad(number.cast("string"), 9, "0")).alias(
                "transaction_id"
            ),
            F.col("o_orderdate").alias("booking_datetime"),
            F.when(k % 3 == 0, F.col("o_orderdate") + one_day)
            .otherwise(F.col("o_orderdate"))
            .alias("value_datetime"),
            amount.alias("instructed_amount"),
            F.when(k % 33 != 0, amount).alias("transaction_amount"),
            F.when(k % 25 == 0, "USD").when(k % 601 != 0, "GBP").alias("currency"),
            F.lit("GBP").alias("original_currency"),
            F.when((k % 25 == 0) & (k % 500 != 0), F.lit("1.25"))
            .when(k % 701 == 0, F.lit("0.90"))
            .cast("decimal(16,2)")
            .alias("exchange_rate"),
            F.when(k % 5 == 0, F.concat(F.lit(" "), merchant, F.lit(" ")))
            .when(k % 7 == 0, F.lower(merchant))
            .otherwise(merchant)
            .alias("merchant_name"),
            F.when(k % 6 == 0, F.concat(F.lit(" "), F.upper(category), F.lit(" ")))
            .otherwise(category)
            .alias("category"),
            F.explode(
                F.when(k % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
                    F.array(F.lit(1))
                )
            ).alias("copy"),
        )
    )


def config(
    spark: SparkSession, spellings: dict[str, list[str]] | None = None
) -> CleaningConfig:
    return CleaningConfig(
        keys=KEYS,
        dictionary=dictionary_from(spark, spellings or swapped_spellings()),
        cutoff=CUTOFF,
        id="transaction_id",
        booking="booking_datetime",
        value="value_datetime",
        instructed="instructed_amount",
        amount="transaction_amount",
        currency="currency",
        original_currency="original_currency",
        rate="exchange_rate",
        merchant="merchant_name",
        category="category",
        precision={
            "instructed_amount": "decimal(12,2)",
            "transaction_amount": "decimal(12,2)",
        },
    )
