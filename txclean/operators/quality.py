"""Constraints with SQL null semantics: a check is broken only where it is false."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txclean.operators.key_index import KeyIndex
from txclean.shared import shared_table


@dataclass(frozen=True)
class Check:
    """A condition on single rows; null counts as passed."""

    name: str
    predicate: Column

    def violations(self, df: DataFrame) -> DataFrame:
        return df.where(~self.predicate)


@dataclass(frozen=True)
class Unique:
    """No two rows share the columns; rows with a null among them do not count."""

    name: str
    columns: tuple[str, ...]

    def violations(self, df: DataFrame) -> DataFrame:
        """Repeated keys with the number of their rows in `copies`."""
        return (
            df.where(_all_present(self.columns))
            .groupBy(*self.columns)
            .agg(F.count(F.lit(1)).alias("copies"))
            .where("copies > 1")
        )


Constraint = Check | Unique


@dataclass(frozen=True)
class Enforced:
    valid: DataFrame
    quarantined: DataFrame | None = None


class ConstraintViolation(Exception):
    """Raised by policy `fail`; `counts` maps each broken rule to its violations."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__(", ".join(f"{rule}: {n}" for rule, n in counts.items()))


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in columns))


def check(name: str, predicate: Column) -> Check:
    return Check(name, predicate)


def check_not_null(columns: Sequence[str], name: str | None = None) -> Check:
    return Check(name or f"not_null({', '.join(columns)})", _all_present(columns))


def check_length(col: str, limit: int, name: str | None = None) -> Check:
    """At most `limit` characters, trailing spaces aside."""
    return Check(name or f"length({col})", F.length(F.rtrim(col)) <= limit)


def check_in_set(col: str, values: Sequence, name: str | None = None) -> Check:
    return Check(name or f"in_set({col})", F.col(col).isin(*values))


def check_unique(columns: Sequence[str], name: str | None = None) -> Unique:
    return Unique(name or f"unique({', '.join(columns)})", tuple(columns))


def primary_key(columns: Sequence[str]) -> list[Constraint]:
    return [check_not_null(columns), check_unique(columns)]


def violation_counts(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Rows (rule, violations): broken rows of a check, repeated keys of a unique."""
    parts = []
    checks = [c for c in constraints if isinstance(c, Check)]
    if checks:
        # All checks share one pass over the rows.
        counts = df.agg(
            *(F.count_if(~c.predicate).alias(f"c{i}") for i, c in enumerate(checks))
        )
        pairs = F.array(
            *(
                F.struct(F.lit(c.name).alias("rule"), F.col(f"c{i}").alias("violations"))
                for i, c in enumerate(checks)
            )
        )
        parts.append(counts.select(F.inline(pairs)))
    parts += [
        c.violations(df).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(c.name).alias("rule"), "violations"
        )
        for c in constraints
        if isinstance(c, Unique)
    ]
    return reduce(DataFrame.unionByName, parts)


def _flag_repeats(
    df: DataFrame,
    rule: Unique,
    flag: str,
    existing: DataFrame | KeyIndex | None,
    key_rows: DataFrame | None,
) -> DataFrame:
    """Add a boolean column: does the row's key occur more than once?

    Only the repeated keys meet the rows again, as a shared table of known size.
    """
    keys = (df if key_rows is None else key_rows).select(*rule.columns)
    if existing is not None:
        wanted = keys.where(_all_present(rule.columns)).distinct()
        if isinstance(existing, KeyIndex):
            if existing.columns != rule.columns:
                raise ValueError(f"the index holds {existing.columns}, not {rule.columns}")
            found = existing.matching(wanted)
        else:
            found = existing.select(*rule.columns).join(wanted, list(rule.columns), "left_semi")
        keys = keys.unionByName(found)
    repeated = shared_table(
        rule.violations(keys).select(
            *(F.col(name).alias(f"__repeated_{name}") for name in rule.columns)
        ),
        "repeats",
    )
    same = reduce(
        and_, (F.col(name) == F.col(f"__repeated_{name}") for name in rule.columns)
    )
    return df.join(repeated, same, "left").select(
        *df.columns, F.col(f"__repeated_{rule.columns[0]}").isNotNull().alias(flag)
    )


def apply_constraints(
    df: DataFrame,
    constraints: Sequence[Constraint],
    policy: str = "quarantine",
    existing: DataFrame | KeyIndex | None = None,
    key_rows: DataFrame | None = None,
) -> Enforced:
    """Hold rows against constraints.

    policy `flag` keeps all rows and adds `failed_rules`, `drop` keeps the valid
    ones, `quarantine` also returns the others with their `failed_rules`, and
    `fail` raises `ConstraintViolation` if any row is broken. With `existing`, the
    rows are a later load into that table: their keys must not occur there either. It is
    the table, all of whose keys are read, or its `KeyIndex`, of which only the ranges
    that the load's keys fall into are.
    `key_rows`, if given, is a frame which takes less work than `df` and has the
    same unique columns in as many rows.
    """
    if policy not in ("flag", "drop", "quarantine", "fail"):
        raise ValueError(f"unknown policy {policy!r}")

    columns = df.columns
    failed = []
    for index, rule in enumerate(constraints):
        if isinstance(rule, Check):
            failed.append((rule.name, ~rule.predicate))
        else:
            flag = f"__repeats_{index}"
            df = _flag_repeats(df, rule, flag, existing, key_rows)
            failed.append((rule.name, F.col(flag)))

    if policy == "fail":
        counts = df.agg(*(F.count_if(broken).alias(name) for name, broken in failed)).first()
        broken = {name: n for name, n in counts.asDict().items() if n}
        if broken:
            raise ConstraintViolation(broken)
        return Enforced(df.select(*columns))

    rules = F.array_compact(F.array(*(F.when(broken, F.lit(name)) for name, broken in failed)))
    passes = reduce(and_, (~F.coalesce(broken, F.lit(False)) for _, broken in failed))
    if policy == "flag":
        return Enforced(df.select(*columns, rules.alias("failed_rules")))
    valid = df.where(passes).select(*columns)
    if policy == "drop":
        return Enforced(valid)
    return Enforced(
        valid, df.where(~passes).select(*columns, rules.alias("failed_rules"))
    )
