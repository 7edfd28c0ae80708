"""Small results kept as tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


#: Paths written by each application.
_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="txclean-")


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives Catalyst the true
    size of the table: a join with it is broadcast when that size is within
    `spark.sql.autoBroadcastJoinThreshold` and shuffled, with AQE splitting hot
    keys, when it is not. No broadcast hint is needed anywhere.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, which `release` removes."""
    path = f"{shared_folder(spark).rstrip('/')}/txclean/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove the tables that this application has written to the shared folder, and give
    their number. Frames built on them can't be read any more: call it when a run's
    results are written."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)
