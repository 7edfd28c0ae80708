"""Exact duplicates through an extendible-hash index kept on shared files.

An entry of the index is one distinct text: its 64-bit key, its digest, its size, and
what is known of its copies. Entries are counted up from the rows with partial counts
before the shuffle, so a text with millions of copies is one entry. The directory
starts with one bucket and doubles while a bucket holds more entries than allowed, so
a bucket is a range of keys; entries whose keys agree in every bit can't be split and
are chained. Each bucket, a key range, is written by the task that owns it. Last,
bytes are compared: within an entry the smallest and largest text must be the same.
Only DataFrame functions run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txclean.llm.common import SPACES, narrow, text_of
from txclean.shared import shared_table

#: Bits of a key that the directory may use at most.
MAX_DEPTH = 24


@dataclass(frozen=True)
class ExactIndex:
    """`rows`: doc_id, key, digest, n_points per document. `directory`: bucket, depth,
    entries. `entries`: bucket, key, digest, chain, group_size, keep_id, same_bytes
    per distinct text."""

    rows: DataFrame
    directory: DataFrame
    entries: DataFrame


def _prefix(depth):
    """The first `depth` bits of the key, counted from its top."""
    return F.expr(f"shiftrightunsigned(shiftrightunsigned(key, 1), 63 - ({depth}))")


def _directory(entries: DataFrame, capacity: int) -> DataFrame:
    """Double the directory while some bucket is overfull.

    A round looks at the buckets of its depth only and keeps a row per bucket, so the
    work of a round is one count of the index.
    """
    depth = 0
    while depth < MAX_DEPTH:
        largest = (
            entries.groupBy(_prefix(depth)).count().agg(F.max("count")).first()[0] or 0
        )
        if largest <= capacity:
            break
        # A doubling halves a bucket at best, so these can be taken at once.
        depth = min(MAX_DEPTH, depth + max(1, (largest // capacity).bit_length() - 1))
    finest = entries.groupBy(_prefix(depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    # Local depth: the shallowest at which the bucket over a slot fits.
    over = (
        finest.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
        .groupBy(F.expr(f"shiftright(slot, {depth} - depth)").alias("bucket"), "depth")
        .agg(F.sum("n").alias("entries"))
    )
    fits = over.where((F.col("entries") <= capacity) | (F.col("depth") == depth))
    parents = over.where((F.col("entries") > capacity)).select(
        F.col("depth").alias("p_depth"), F.col("bucket").alias("p_bucket")
    )
    # A bucket stands if its parent is overfull.
    return fits.join(
        parents,
        (F.col("p_depth") == F.col("depth") - 1)
        & (F.col("p_bucket") == F.expr("shiftright(bucket, 1)")),
        "left",
    ).where((F.col("depth") == 0) | F.col("p_depth").isNotNull()).select(
        "bucket", "depth", "entries"
    )


def build_index(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 100_000,
    key_bits: int = 64,
) -> ExactIndex:
    """Index the texts, white space set aside.

    `capacity`: entries of a bucket before it is split. `key_bits`: bits of the key in
    use; few make collisions, for tests. Rows with a null id are indexed like others.
    Runs when called, as the index is a set of shared files.
    """
    docs = narrow(df, doc_id=id_col, text=text_col).select(
        "doc_id",
        F.translate(text_of(), SPACES, "").alias("norm"),
        F.char_length(text_of()).cast("long").alias("n_points"),
    )
    key = F.xxhash64("norm")
    if key_bits < 64:
        key = F.shiftleft(key, 64 - key_bits)
    keyed = docs.select("doc_id", "n_points", "norm", key.alias("key"), F.sha2("norm", 256).alias("digest"))
    rows = shared_table(keyed.select("doc_id", "key", "digest", "n_points"), "exact-rows")
    # The longest original stays, then the smallest id; a null id comes last.
    best = F.min_by(
        F.col("doc_id"),
        F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id")),
    )
    counted = shared_table(
        rows.groupBy("key", "digest").agg(
            F.count(F.lit(1)).alias("group_size"), best.alias("keep_id")
        ),
        "exact-entries",
    )
    copied = counted.where("group_size > 1").select("key", "digest")
    # Bytes are compared where there is something to compare. Each task first folds
    # what it has of an entry into two texts.
    compared = (
        keyed.select("key", "digest", "norm")
        .join(copied, ["key", "digest"], "left_semi")
        .groupBy("key", "digest")
        .agg((F.min("norm") == F.max("norm")).alias("same_bytes"))
    )
    directory = shared_table(_directory(counted, capacity), "exact-directory")
    depths = directory.select("bucket", "depth")
    chained = counted.join(
        counted.groupBy("key").count().where("count > 1").select("key"), "key", "left_semi"
    ).withColumn("chain", F.row_number().over(Window.partitionBy("key").orderBy("digest")))
    entries = counted.join(
        chained.select("key", "digest", "chain"), ["key", "digest"], "left"
    ).join(compared, ["key", "digest"], "left")
    used = [r[0] for r in depths.select("depth").distinct().limit(MAX_DEPTH + 1).collect()]
    placed = entries.withColumn(
        "places",
        F.array(*(F.struct(F.lit(d).cast("int").alias("depth"), _prefix(d).alias("bucket")) for d in used))
        if used
        else F.expr("CAST(array() AS ARRAY<STRUCT<depth: INT, bucket: BIGINT>>)"),
    ).select("*", F.inline("places"))
    owned = placed.join(
        depths, ["depth", "bucket"]
    ).select(
        "bucket",
        "depth",
        "key",
        "digest",
        F.coalesce("chain", F.lit(1)).alias("chain"),
        "group_size",
        "keep_id",
        F.coalesce("same_bytes", F.lit(True)).alias("same_bytes"),
    )
    index = shared_table(
        owned.repartitionByRange("key").sortWithinPartitions("key", "chain"), "exact-index"
    )
    return ExactIndex(rows, directory, index)


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are so without white space; a null text counts as empty,
    so all empty texts are one group. Of a group the text with the most code points
    stays, then the smallest id; if one id stands in several rows, each row of it with
    that text is marked kept. An empty table gives none. Should two texts with one key
    and one SHA-256 digest ever differ in their bytes, the job stops with an error.
    """
    index = build_index(df, id_col, text_col, **options)
    entries = index.entries.select("key", "digest", "keep_id", "group_size", "same_bytes")
    checked = F.when(F.col("same_bytes"), F.col("keep_id")).otherwise(
        F.raise_error(F.lit("two texts with equal SHA-256 differ"))
    )
    return index.rows.join(entries, ["key", "digest"]).select(
        "doc_id",
        checked.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
