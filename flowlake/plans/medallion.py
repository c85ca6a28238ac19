"""The batch pipeline: raw records to the clean layer to the feature layer."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.safe import quoted
from flowlake.operators.clean import clean
from flowlake.operators.features import FEATURE_NAMES, add_features
from flowlake.operators.quality import require
from flowlake.session import SCAN as _SCAN
from flowlake.session import pieces_of, settings
from flowlake.session import size_bytes as _bytes
from flowlake.sources.tables import write_table

SCAN_BYTES = 8 * 1024 * 1024
FEATURE_SCAN_BYTES = 16 * 1024 * 1024
PART_BYTES = 32 * 1024 * 1024
TASK_ROWS = 3_000_000
DEALT_BY = 4  # columns
_PARTS, _PART = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def run_batch(raw: DataFrame, root: str, fmt: str = "parquet", keys: list[str] | None = None) -> DataFrame:
    """Write both layers under ``root`` and return the feature layer, checked for complete features.

    The feature layer is computed from the stored clean layer, so the dedup shuffle runs once. Its files are made from small pieces, as a
    scan never splits the row group of a file: what reads the layer has tasks for all cores, each with a moderate number of rows.
    """
    silver = _write_clean(raw, f"{root}/silver", fmt, keys)
    with settings(raw.sparkSession, pieces_of(raw.sparkSession, FEATURE_SCAN_BYTES)):
        gold = write_table(add_features(silver), f"{root}/gold", fmt)
    return require(gold, FEATURE_NAMES)


def _write_clean(raw: DataFrame, path: str, fmt: str, keys: list[str] | None, scan_bytes: int = SCAN_BYTES, task_rows: int = TASK_ROWS) -> DataFrame:
    """The dedup keeps the rows of a task in memory, some thirty times as large as a packed file has them. So tasks read small pieces of
    the files, and there are as many parts as pieces: nothing spills, and a task's memory does not grow with the table.

    A piece cannot be smaller than a row group of its file. Where one has more than ``task_rows`` rows, several tasks read it, each for
    its share of the rows by their hash, and there are parts enough for as many rows each."""
    spark = raw.sparkSession
    with settings(spark, {_SCAN: str(min(scan_bytes, _bytes(spark.conf.get(_SCAN)))), _PART: str(min(PART_BYTES, _bytes(spark.conf.get(_PART))))}):
        pieces = raw.select("*").rdd.getNumPartitions()  # a plan of its own, as a planned scan keeps its pieces
        most, rows = raw.groupBy(F.spark_partition_id()).count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
        with settings(spark, {_PARTS: str(max(pieces, -(-rows // task_rows), int(spark.conf.get(_PARTS))))}):
            return write_table(clean(_sliced(raw, -(-most // task_rows)), keys=keys), path, fmt)


def _sliced(raw: DataFrame, slices: int) -> DataFrame:
    """The same rows from ``slices`` times as many tasks. Every slice evaluates ``raw`` again, so it has to give the same rows each time."""
    plain = [quoted(f.name) for f in raw.schema.fields if isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType))]
    by = plain[:DEALT_BY]  # few, as all slices have to work them out for all rows
    if slices < 2 or not by or not raw._jdf.queryExecution().analyzed().deterministic():
        return raw
    share = F.pmod(F.xxhash64(*by), F.lit(slices))
    return functools.reduce(DataFrame.unionAll, [raw.filter(share == i) for i in range(slices)])
