"""The bank-transaction table: columns, types and declared lengths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, types and lengths of the transaction table.
TRANSACTION_TYPES = {
    "AccountId": "string",
    "TransactionId": "string",
    "TransactionId_OBIE": "string",
    "BookingDateTime": "timestamp_ntz",
    "ValueDateTime": "timestamp_ntz",
    "RawDateString": "string",
    "InstructedAmount": "decimal(12,2)",
    "TransactionAmount": "decimal(12,2)",
    "Currency": "string",
    "OriginalCurrency": "string",
    "ExchangeRate": "decimal(16,2)",
    "TransactionType": "string",
    "MerchantCategoryCode": "integer",
    "BankTransactionCode": "string",
    "ProprietaryBankTransactionCode": "string",
    "Reference": "string",
    "Balance": "decimal(12,2)",
    "CounterpartyName": "string",
    "CounterpartyAccount": "string",
    "Status": "string",
    "merchant_name": "string",
    "category": "string",
}
TRANSACTION_LENGTHS = {
    "AccountId": 4,
    "TransactionId": 7,
    "TransactionId_OBIE": 8,
    "RawDateString": 100,
    "Currency": 3,
    "OriginalCurrency": 3,
    "TransactionType": 15,
    "BankTransactionCode": 6,
    "ProprietaryBankTransactionCode": 6,
    "Reference": 50,
    "CounterpartyName": 50,
    "CounterpartyAccount": 50,
    "Status": 50,
    "merchant_name": 50,
    "category": 50,
}
TRANSACTION_SCHEMA = T.StructType()
for _name, _type in TRANSACTION_TYPES.items():
    TRANSACTION_SCHEMA.add(_name, _type)


def fit_lengths(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Hold text columns to their declared lengths, as a VARCHAR(n) column does.

    Excess trailing spaces are cut; longer text stops the job.
    """

    def fitted(name: str, limit: int):
        text = F.col(name)
        return (
            F.when(F.length(F.rtrim(text)) > limit, F.raise_error(
                F.concat(F.lit(f"value too long for {name} ({limit}): "), text)
            ))
            .when(F.length(text) > limit, F.substring(text, 1, limit))
            .otherwise(text)
        )

    return df.withColumns({name: fitted(name, limit) for name, limit in lengths.items()})
