"""Reading and writing relations."""

from txclean.sources.files import conform, read_transactions, write_relations
from txclean.sources.schemas import (
    TRANSACTION_LENGTHS,
    TRANSACTION_SCHEMA,
    fit_lengths,
)

__all__ = [
    "TRANSACTION_LENGTHS",
    "TRANSACTION_SCHEMA",
    "conform",
    "fit_lengths",
    "read_transactions",
    "write_relations",
]
