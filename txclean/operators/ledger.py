"""An audit log that is added to batch by batch, as a folder of tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txclean.operators.audit import COUNT, number_entries
from txclean.shared import exists, remove

MARKS = f"sequence long, batch string, folder string, first_id {COUNT}, last_id {COUNT}, rows long"
ENTRIES = (
    f"log_id {COUNT}, transaction_id string, column_changed string, old_value string, new_value string, "
    f"change_stage string, change_reason string, entries {COUNT}, changed_at timestamp"
)


class AuditLedger:
    """A log whose ids go on over all batches without gaps.

    A batch is a table of its own, and in the log only once its mark is written, which
    comes last: its name, where it is, and its first and last id. The highest last id of
    the marks is where the next batch goes on, so no entry is read for it. A batch that
    breaks off leaves no mark and nothing to be seen; one whose name has a mark is not
    added again. There is one writer at a time; a second one that has got in between is
    noticed by the mark and refused.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> DataFrame:
        """One row per batch: sequence, batch, folder, first_id, last_id, rows."""
        folder = f"{self.path}/marks"
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], MARKS)
        # Marks stand in folders of their own; those without a file are of a broken write.
        return self.spark.read.schema(MARKS).option("recursiveFileLookup", True).parquet(folder)

    def last_id(self) -> int:
        return int(self.batches().agg(F.max("last_id")).first()[0] or 0)

    def append(self, entries: DataFrame, batch: str) -> bool:
        """Add the entries, which have the columns of an audit operator, under the name
        `batch`; False if that batch is in the log already. An empty batch is marked too."""
        marks = self.batches()
        if marks.where(F.col("batch") == batch).limit(1).count():
            return False
        last = marks.agg(F.max("sequence"), F.max("last_id")).first()
        sequence, first = (last[0] or 0) + 1, int(last[1] or 0) + 1
        folder = f"{self.path}/entries/{uuid.uuid4().hex}"
        number_entries(entries, first_id=first).select(
            *(F.col(f.name).cast(f.dataType) for f in self._schema())
        ).write.parquet(folder)
        written = self.spark.read.schema(ENTRIES).parquet(folder)
        mark = written.agg(
            F.lit(sequence).cast("long").alias("sequence"),
            F.lit(batch).alias("batch"),
            F.lit(folder).alias("folder"),
            F.lit(first).cast(COUNT).alias("first_id"),
            (F.lit(first - 1).cast(COUNT) + F.coalesce(F.sum("entries"), F.lit(0))).cast(COUNT).alias("last_id"),
            F.count(F.lit(1)).alias("rows"),
        )
        place = f"{self.path}/marks/{sequence:012d}"
        if exists(self.spark, f"{place}/_SUCCESS"):
            remove(self.spark, folder)
            raise RuntimeError(f"another writer has added batch number {sequence} to {self.path}")
        mark.coalesce(1).write.mode("overwrite").parquet(place)
        return True

    def read(self) -> DataFrame:
        """All entries of the marked batches, with `batch`."""
        marks = self.batches()
        # One name per batch, of which Spark lists the files anyway.
        folders = [r["folder"] for r in marks.select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], f"batch string, {ENTRIES}")
        entries = self.spark.read.schema(ENTRIES).parquet(*folders)
        # The path of a file tells its batch.
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([0-9a-f]{32})/[^/]*$", 1)
        names = marks.select(F.regexp_extract("folder", r"([0-9a-f]{32})$", 1).alias("__folder"), "batch")
        return (
            entries.withColumn("__folder", folder)
            .join(names, "__folder")
            .select("batch", *(f.name for f in self._schema()))
        )

    def _schema(self):
        return self.spark.createDataFrame([], ENTRIES).schema
