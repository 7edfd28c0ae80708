"""Correction of names from a dictionary of known misspellings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.functions.text import segment_keys, shifted_segment_keys
from txclean.shared import shared_table


def dictionary_matches(
    df: DataFrame, col: str, dictionary: DataFrame, max_len_diff: int = 2, distance: int = 1
) -> DataFrame:
    """Every (distinct name, dictionary entry) pair within so many edits.

    Case is ignored for the distance. `dictionary` has the columns `id`,
    `clean_name` and `dirty_name`. The work is one narrow pass over the data to
    find the distinct names, combined before the shuffle; copies of a name, however
    many, cost nothing after it. An entry is cut into one segment more than there may be
    edits, so one of them stands unchanged in every name within the distance, shifted by
    that many places at most: names and entries meet in an equi-join on these segments and
    the distance is checked on those candidates alone. A name has the same number of keys
    however long it is.
    """
    names = df.select(F.col(col).alias("name")).where("name is not null").distinct()
    name_keys = names.withColumn("key", F.explode(shifted_segment_keys(F.lower("name"), distance)))
    entry_keys = dictionary.select("id", "clean_name", "dirty_name").withColumn(
        "key", F.explode(segment_keys(F.lower("dirty_name"), distance))
    )
    return (
        name_keys.join(entry_keys, "key")
        .withColumn(
            "distance", F.levenshtein(F.lower("name"), F.lower("dirty_name"), distance)
        )
        .where(F.col("distance") >= 0)
        .where(F.abs(F.length("name") - F.length("dirty_name")) <= max_len_diff)
        .select("name", "id", "clean_name", "dirty_name", "distance")
        .distinct()
    )


def correction_map(
    df: DataFrame, col: str, dictionary: DataFrame, max_len_diff: int = 2, distance: int = 1
) -> DataFrame:
    """One clean name per matched distinct name: nearest entry, then lowest id."""
    return (
        dictionary_matches(df, col, dictionary, max_len_diff, distance)
        .groupBy("name")
        .agg(F.min(F.struct("distance", "id", "clean_name")).alias("best"))
        .select("name", "best.clean_name")
    )


def correct_from_dictionary(
    df: DataFrame,
    col: str,
    dictionary: DataFrame,
    max_len_diff: int = 2,
    names: DataFrame | None = None,
    distance: int = 1,
) -> DataFrame:
    """Replace names by their dictionary entry; rows are never multiplied.

    The map of changed names is worked out first and kept as a shared table, so
    that its size is known when the join with the full data is planned and no
    later use of the result repeats the matching. `names`, if given, is a shorter
    frame in which `col` has all the names of `df`.
    """
    changes = shared_table(
        correction_map(df if names is None else names, col, dictionary, max_len_diff, distance)
        .where("name <> clean_name")
        .withColumnsRenamed({"name": "__name", "clean_name": "__clean_name"}),
        "corrections",
    )
    return (
        df.join(changes, F.col(col) == F.col("__name"), "left")
        .withColumn(col, F.coalesce("__clean_name", col))
        .drop("__name", "__clean_name")
    )
