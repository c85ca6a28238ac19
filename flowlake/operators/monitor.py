"""Size, freshness and latest content of stored tables."""

from __future__ import annotations

import contextlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.columns import prioritised
from flowlake.sources.tables import read_table

ACTIVE_SECONDS = 120

# Columns shown first.
PRIORITY = [
    "timestamp", "source_ip", "dest_ip", "attack_type", "flow_id", "Attack_label", "ingestion_time", "json_payload",
]


def latest_rows(df: DataFrame, ts: str, k: int = 20, tie: list[str] | None = None, width: int = 15) -> DataFrame:
    """The ``k`` newest rows with the most telling columns; columns are pruned before the sort if possible."""
    newest = df.orderBy(F.desc(ts), *[F.desc(c) for c in tie or []]).limit(k)
    return prioritised(newest, PRIORITY, width)


def _absent(error: AnalysisException) -> bool:
    """Whether the table is not there yet, or has no file; any other failure is one."""
    return any(reason in str(error) for reason in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of all files under ``path``; their content is not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "length", "modificationTime")
    )


@contextlib.contextmanager
def footer_reads(spark: SparkSession):
    """Within this, Parquet is read by the reader that can answer counts, minima and maxima from file footers."""
    keys = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def footer_count(spark: SparkSession, path: str) -> tuple[int, int, bool]:
    """Rows and columns of a Parquet table, and whether the scan took them from the footers (no row is read then)."""
    with footer_reads(spark):
        table = spark.read.parquet(path)
        counted = table.agg(F.count(F.lit(1)).alias("n"))
        pushed = "PushedAggregation: [COUNT(*)]" in plan_text(counted)
        return counted.first()["n"], len(table.columns), pushed


def layer_counts(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """``layer, rows, columns, exists, from_footers`` of Parquet tables; the driver gets one row per table."""
    rows = []
    for name, path in layers.items():
        try:
            n, width, pushed = footer_count(spark, path)
            rows.append((name, n, width, True, pushed))
        except AnalysisException as error:
            if not _absent(error):
                raise
            rows.append((name, None, None, False, False))
    return spark.createDataFrame(rows, "layer string, rows long, columns int, exists boolean, from_footers boolean")


def _rows(spark: SparkSession, table: DataFrame, path: str, fmt: str) -> DataFrame:
    """One row with the number of rows; from footers where the format has them."""
    if fmt == "parquet":
        return spark.range(1).select(F.lit(footer_count(spark, path)[0]).cast("long").alias("rows"))
    return table.agg(F.count(F.lit(1)).alias("rows"))


def _layer(spark: SparkSession, name: str, path: str, fmt: str) -> DataFrame:
    frame = spark.range(1).select(F.lit(name).alias("layer"))
    try:
        table = read_table(spark, path, fmt)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return frame.select(
            "layer", F.lit(None).cast("long").alias("rows"), F.lit(None).cast("int").alias("columns"),
            F.lit(0.0).alias("size_mb"), F.lit(False).alias("exists"),
        )
    size = _files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).scalar()
    return _rows(spark, table, path, fmt).select(
        F.lit(name).alias("layer"), "rows", F.lit(len(table.columns)).alias("columns"),
        F.round(size / (1024 * 1024), 2).alias("size_mb"), F.lit(True).alias("exists"),
    )


def layer_stats(spark: SparkSession, layers: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Rows, columns and size per table; a table that is not there yet has ``exists`` false."""
    frames = [_layer(spark, name, path, fmt) for name, path in layers.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def layer_freshness(spark: SparkSession, layers: dict[str, str], limit: int = ACTIVE_SECONDS) -> DataFrame:
    """Time of the newest file, its age, and whether the table counts as active."""
    result = None
    for name, path in layers.items():
        try:
            newest = _files(spark, path).agg(F.max("modificationTime").alias("last_modified"))
            exists = True
        except AnalysisException as error:
            if not _absent(error):
                raise
            newest = spark.range(1).select(F.lit(None).cast("timestamp").alias("last_modified"))
            exists = False
        age = F.round(F.current_timestamp().cast("double") - F.col("last_modified").cast("double")).cast("long")
        row = newest.select(
            F.lit(name).alias("layer"), F.lit(exists).alias("exists"), "last_modified", age.alias("age_sec"),
            F.coalesce(age < limit, F.lit(False)).alias("active"), F.col("last_modified").isNotNull().alias("has_data"),
        )
        result = row if result is None else result.unionByName(row)
    return result


def topic_totals(records: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Messages and partitions of a topic, from the span of offsets in each partition."""
    spans = records.groupBy(partition).agg((F.max(offset) - F.min(offset) + 1).alias("_n"))
    return spans.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_messages"), F.count(F.lit(1)).alias("partitions")
    )
