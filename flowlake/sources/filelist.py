"""Tables as versioned lists of files, with compaction that leaves large files alone.

Data files are never changed. A version is a small table ``_files/v=<number>`` of (path, length), put there whole by one rename; the
newest is the table. So a reader that holds a version goes on reading its files while others append or compact, and a writer
that is lost half-way leaves files that no list names. Two writers that meet take turns: the later rename fails, and the
change is applied to the newer list.

Compaction takes the files below half the target size, lets the scan pack them by size into tasks of about the target (Spark's own
bin packing of files, largest first), and writes each task's rows as one file. Nothing is shuffled and no large file is opened.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.session import settings
from flowlake.streaming.commits import STAGING, committed, move

LISTS = "_files"
LIST = "path string, length long"
TARGET = 256 * 1024 * 1024


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """Data files under a folder with their sizes; they are not opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder).select("path", "length")


def latest(spark: SparkSession, path: str) -> int:
    """Number of the newest version; 0 before the first."""
    return max(committed(spark, f"{path}/{LISTS}", "v="), default=0)


def files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(path, length) of a version's files."""
    number = latest(spark, path) if version is None else version
    return spark.read.schema(LIST).parquet(f"{path}/{LISTS}/v={number}") if number else spark.createDataFrame([], LIST)


def _publish(spark: SparkSession, path: str, change) -> int:
    """Make ``change(list)`` the next version, on top of whatever version is newest by then."""
    while True:
        number = latest(spark, path)
        staged = f"{path}/{LISTS}/{STAGING}/{uuid.uuid4().hex}"
        change(files(spark, path, number) if number else spark.createDataFrame([], LIST)).coalesce(1).write.parquet(staged)
        if move(spark, staged, f"{path}/{LISTS}/v={number + 1}"):
            return number + 1


def append(df: DataFrame, path: str) -> int:
    """Add the rows of ``df``; the version that has them."""
    folder = f"{path}/data/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    added = _listed(df.sparkSession, folder)
    return _publish(df.sparkSession, path, lambda now: now.union(added))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table, or an older version of it."""
    found = [r["path"] for r in files(spark, path, version).collect()]  # as many as the scan lists anyway
    if not found:
        raise FileNotFoundError(f"no files are listed under {path}")
    return spark.read.parquet(*found)


def _packing(spark: SparkSession, target: int):
    """The scan packs whole files into tasks of up to ``target`` bytes."""
    return settings(spark, {"spark.sql.files.maxPartitionBytes": str(target), "spark.sql.files.openCostInBytes": "0",
                            "spark.sql.files.minPartitionNum": "1", "spark.sql.files.maxPartitionNum": None})


def small_files(spark: SparkSession, path: str, target: int = TARGET, version: int | None = None) -> DataFrame:
    return files(spark, path, version).filter(F.col("length") < target // 2)


def compact(spark: SparkSession, path: str, target: int = TARGET) -> int | None:
    """Merge the small files; the new version, or None if there are fewer than two."""
    version = latest(spark, path)
    small = small_files(spark, path, target, version)
    merged = [r["path"] for r in small.collect()]
    if len(merged) < 2:
        return None
    folder = f"{path}/data/{uuid.uuid4().hex}"
    with _packing(spark, target):
        spark.read.parquet(*merged).write.parquet(folder)
    added, gone = _listed(spark, folder), small.select("path")
    done = []

    def change(now: DataFrame) -> DataFrame:
        # Another compaction may have merged some of them meanwhile; then these rows are there already.
        if now.join(gone, "path", "left_semi").count() != len(merged):
            done.append(False)
            return now
        done.append(True)
        return now.join(gone, "path", "left_anti").select("path", "length").union(added)

    number = _publish(spark, path, change)
    return number if done[-1] else None
