"""A run over rows of which few have changed since the last one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.operators.audit import COUNT, SUMMARY_KEYS
from txclean.plans.pipeline import CleaningConfig, CleaningResult, clean
from txclean.shared import shared_table


def fingerprints(raw: DataFrame, key: str) -> DataFrame:
    """(key, print, rows): how many rows of a key have the same values in all columns, as 128
    bits of a hash. To be written with a run, so that the next one need not read its rows."""
    columns = raw.columns
    return raw.select(
        F.col(key).alias("key"),
        F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(17), *columns).alias("b")).alias("print"),
    ).groupBy("key", "print").agg(F.count(F.lit(1)).alias("rows"))


def changed_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys whose rows differ between two tables of `fingerprints`, null among them."""
    both = before.unionByName(after.withColumn("rows", -F.col("rows")))
    differing = both.groupBy("key", "print").agg(F.sum("rows").alias("rows")).where("rows <> 0")
    return differing.select("key").distinct()


@dataclass(frozen=True)
class Rerun:
    """`changed` holds the ids whose rows have changed, `part` is the run over the rows that
    have them now; `final` and `summary` are those of a whole run."""

    changed: DataFrame
    part: CleaningResult
    final: DataFrame
    summary: DataFrame


def rerun(
    raw_before: DataFrame,
    final_before: DataFrame,
    summary_before: DataFrame,
    raw: DataFrame,
    config: CleaningConfig,
    prints_before: DataFrame | None = None,
) -> Rerun:
    """What a run over `raw` gives, from the run before and the rows that have changed.

    Rows are cleaned by themselves, copies have an id in common, and each entry of the
    summary is of one id, so ids none of whose rows has changed keep their final rows and
    their entries. Only rows of the other ids are cleaned: as they are now for the final
    rows, and as they were to take their entries from the summary. `prints_before`, the
    `fingerprints` of `raw_before`, spares a pass over it. The changed ids are found when this
    is called; the rest is lazy. The configuration must be that of the run before.
    """
    if prints_before is None:
        prints_before = fingerprints(raw_before, config.id)
    changed = shared_table(
        changed_keys(prints_before, fingerprints(raw, config.id)).withColumnRenamed("key", "__changed"), "changed"
    )

    def of_changed(df: DataFrame, how: str) -> DataFrame:
        return df.join(changed, df[config.id].eqNullSafe(changed["__changed"]), how)

    part = clean(of_changed(raw, "left_semi"), config)
    was = clean(of_changed(raw_before, "left_semi"), config)
    final = of_changed(final_before, "left_anti").unionByName(part.final)
    totals = (
        summary_before.unionByName(part.summary())
        .unionByName(was.summary().withColumn("number_of_changes", -F.col("number_of_changes")))
        .groupBy(*SUMMARY_KEYS)
        .agg(F.sum("number_of_changes").cast(COUNT).alias("number_of_changes"))
        .where("number_of_changes <> 0")
    )
    return Rerun(changed.withColumnRenamed("__changed", config.id), part, final, totals)
