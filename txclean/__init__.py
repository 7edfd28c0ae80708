"""Cleaning of bank-transaction tables on Spark."""

from txclean.plans.pipeline import (
    CleaningConfig,
    CleaningResult,
    bank_transactions,
    clean,
    dictionary_from,
)

__all__ = [
    "CleaningConfig",
    "CleaningResult",
    "bank_transactions",
    "clean",
    "dictionary_from",
]
