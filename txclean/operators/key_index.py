"""The keys of a table over many loads, in ranges of which a load reads those it meets."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txclean.operators.numbering import ordered_slices
from txclean.shared import exists, remove, shared_table


class KeyIndex:
    """The different keys of a table, kept as a folder of sorted ranges.

    A version lists the ranges: where each is, its lowest key and its rows. A range holds
    the keys from its lowest one up to the next range's; the first also what is lower. A
    load is met with the list, which tells the ranges it touches; only those are read, and
    by `merge` written anew with the load's keys, cut again where they have outgrown
    `rows_per_range`. The others are taken over as they are. A version counts once its
    mark is written, which comes last, with the name of the load; one whose name has a
    mark is not merged again. There is one writer at a time.

    Keys with a null are left out, as no uniqueness holds for them.
    """

    def __init__(
        self, spark: SparkSession, path: str, columns: Sequence[str], rows_per_range: int = 2_000_000
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.columns, self.rows_per_range = tuple(columns), rows_per_range

    def loads(self) -> DataFrame:
        """(version, batch) of each load."""
        schema = "version long, batch string"
        if not exists(self.spark, f"{self.path}/loads"):
            return self.spark.createDataFrame([], schema)
        marks = self.spark.read.schema(schema).option("recursiveFileLookup", True)
        return marks.parquet(f"{self.path}/loads")

    def version(self) -> int:
        return self.loads().agg(F.max("version")).first()[0] or 0

    def ranges(self) -> DataFrame | None:
        """(folder, low, rows) of each range; none before the first load."""
        version = self.version()
        return self.spark.read.parquet(f"{self.path}/versions/{version}") if version else None

    def matching(self, wanted: DataFrame) -> DataFrame:
        """The keys of the index which occur in `wanted`, from the ranges that it touches."""
        keys = self._keys(wanted)
        ranges = self.ranges()
        if ranges is None:
            return keys.where("false")
        touched = self._folders(self._placed(keys, ranges))
        if not touched:
            return keys.where("false")
        return self._read(ranges, touched).drop("__of").join(keys, list(self.columns), "left_semi")

    def merge(self, rows: DataFrame, batch: str) -> bool:
        """Take in the keys of a load; False if a load of that name has been merged."""
        loads = self.loads()
        if loads.where(F.col("batch") == batch).limit(1).count():
            return False
        version, ranges = self.version() + 1, self.ranges()
        new = self._keys(rows).withColumn("__of", F.lit(None).cast("string"))
        kept = None
        if ranges is not None:
            placed = self._placed(new.drop("__of"), ranges)
            touched = self._folders(placed)
            kept = ranges.where(~F.col("folder").isin(touched)) if touched else ranges
            new = placed
            if touched:
                new = placed.unionByName(self._read(ranges, touched)).distinct()
        name = uuid.uuid4().hex
        merged = shared_table(new, "keys")
        slices = -(-merged.count() // self.rows_per_range) or 1
        # A slice that reaches over two touched ranges gives two, as others may lie between.
        cut = shared_table(ordered_slices(merged, [*self.columns, "__of"], slices), "key-slices")
        numbered = cut.withColumn(
            "range", F.concat_ws("-", F.xxhash64("__of").cast("string"), F.col("__slice").cast("string"))
        )
        numbered.select(*self.columns, "range").write.partitionBy("range").parquet(f"{self.path}/keys/{name}")
        listed = numbered.groupBy("range").agg(
            F.min(F.struct(*self.columns)).alias("low"), F.count(F.lit(1)).alias("rows")
        ).select(F.concat(F.lit(f"{name}/range="), "range").alias("folder"), "low", "rows")
        if kept is not None:
            listed = listed.unionByName(kept.select("folder", "low", "rows"))
        listed.write.mode("overwrite").parquet(f"{self.path}/versions/{version}")
        mark = self.spark.range(1).select(
            F.lit(version).cast("long").alias("version"), F.lit(batch).alias("batch")
        )
        mark.write.parquet(f"{self.path}/loads/{uuid.uuid4().hex}")
        return True

    def vacuum(self) -> int:
        """Remove ranges that earlier versions have and the last one hasn't; their number."""
        version = self.version()
        if version < 2:
            return 0
        earlier = self.spark.read.parquet(*(f"{self.path}/versions/{n}" for n in range(1, version)))
        gone = earlier.select("folder").distinct().join(self.ranges(), "folder", "left_anti").collect()
        found = [p for r in gone if exists(self.spark, p := f"{self.path}/keys/{r['folder']}")]
        for path in found:
            remove(self.spark, path)
        return len(found)

    def _keys(self, rows: DataFrame) -> DataFrame:
        present = reduce(and_, (F.col(name).isNotNull() for name in self.columns))
        return rows.where(present).select(*self.columns).distinct()

    def _read(self, ranges: DataFrame, folders: Sequence[str]) -> DataFrame:
        """The keys of ranges, with the range of each in `__of`, told by the path of its file."""
        paths = [f"{self.path}/keys/{folder}" for folder in folders]
        keys = self.spark.read.schema(ranges.schema["low"].dataType).parquet(*paths)
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([0-9a-f]{32}/range=[^/]+)/[^/]*$", 1)
        return keys.withColumn("__of", folder)

    def _folders(self, placed: DataFrame) -> list[str]:
        """Names of the touched ranges: of these Spark lists the files on the driver anyway."""
        return sorted(r["__of"] for r in placed.select("__of").distinct().collect())

    def _placed(self, keys: DataFrame, ranges: DataFrame) -> DataFrame:
        """The keys with the range of each in `__of`.

        Keys and lowest keys are put in one order, cut into slices, and each key takes the
        last range that starts in its slice before it, or in an earlier slice. So no key is
        compared with all ranges, and nothing is broadcast.
        """
        columns = list(self.columns)
        lows = ranges.select(*(F.col(f"low.{c}").alias(c) for c in columns), F.col("folder").alias("__of"))
        both = lows.withColumn("__key", F.lit(0)).unionByName(
            keys.select(*columns, F.lit(None).cast("string").alias("__of"), F.lit(1).alias("__key"))
        )
        written = shared_table(both, "placed")
        slices = -(-written.count() // self.rows_per_range) or 1
        sliced = shared_table(ordered_slices(written, [*columns, "__key"], slices), "placed")
        before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
        # One row per slice, whose first keys may belong to a range from before it.
        carried = (
            sliced.groupBy("__slice")
            .agg(F.max_by("__of", F.when(F.col("__key") == 0, F.struct(*columns))).alias("__last"))
            .withColumn("__carried", F.last("__last", ignorenulls=True).over(before))
            .select("__slice", "__carried")
        )
        lowest = ranges.agg(F.min_by("folder", "low")).first()[0]
        inside = (
            Window.partitionBy("__slice")
            .orderBy(*columns, "__key")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return (
            sliced.withColumn("__in", F.last("__of", ignorenulls=True).over(inside))
            .where("__key = 1")
            .join(carried, "__slice")
            .select(*columns, F.coalesce("__in", "__carried", F.lit(lowest)).alias("__of"))
        )
