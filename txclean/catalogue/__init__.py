"""Queries over the test tables, with equal SQL for checking."""

from txclean.catalogue.checks import oracle_sql
from txclean.catalogue.queries import queries

__all__ = ["oracle_sql", "queries"]
