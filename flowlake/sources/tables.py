"""Batch tables: scans with an explicit schema, sinks, compaction."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_PARTS = ["ingestion_year", "ingestion_month", "ingestion_day"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sampling: float = 1.0) -> DataFrame:
    """CSV with a header. Without a schema, types are inferred from all rows.

    With a smaller ``sampling`` a later cell may not fit its column; reading then fails instead of making it null.
    """
    reader = spark.read.option("header", "true")
    if schema is not None:
        return reader.schema(schema).csv(path)
    if sampling < 1.0:
        reader = reader.option("mode", "FAILFAST")
    return reader.option("inferSchema", "true").option("samplingRatio", str(sampling)).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False,
               fallback: str | None = None) -> DataFrame:
    """Scan a table. If its format is not available here, or cannot make sense of the folder, that is an error, unless ``fallback``
    names another format to try; if that fails too, the first error stands.

    A fallback reads all data files without the table's own log, so it is right only for tables that were never rewritten.
    """
    def load(kind):
        return spark.read.format(kind).option("mergeSchema", str(merge_schema).lower()).load(path)

    try:
        return load(fmt)
    except Exception as error:  # a missing connector surfaces as a Java or an analysis error
        if fallback is None or fallback == fmt:
            raise
        try:
            return load(fallback)
        except Exception:
            raise error from None


def read_first(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """The first of ``paths`` that exists; list a compacted copy before its source."""
    missing = None
    for path in paths:
        try:
            return read_table(spark, path, fmt)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            missing = error
    raise missing


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> DataFrame:
    """Write and read back: later steps start from files, not from the lineage that produced them.

    A partitioned write is rebalanced first: few files per folder, and a hot folder still spreads over
    several tasks because adaptive execution splits it.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return read_table(df.sparkSession, path, fmt)


def compact_table(df: DataFrame, path: str, files: int, fmt: str = "parquet") -> DataFrame:
    """Rewrite into ``files`` even files. Round-robin keeps them even whatever the keys look like."""
    return write_table(df.repartition(files), path, fmt)


def with_date_parts(df: DataFrame, ts: str = "ingestion_time") -> DataFrame:
    """Partition columns for the raw layer."""
    return df.withColumns(dict(zip(DATE_PARTS, [F.year(ts), F.month(ts), F.dayofmonth(ts)])))


def since(df: DataFrame, day: dt.date) -> DataFrame:
    """Rows ingested on or after ``day``, phrased on the partition columns so whole folders are skipped."""
    y, m, d = (F.col(c) for c in DATE_PARTS)
    return df.filter(
        (y > day.year) | ((y == day.year) & ((m > day.month) | ((m == day.month) & (d >= day.day))))
    )
