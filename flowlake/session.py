"""Session factory and the shared scratch area."""

from __future__ import annotations

import contextlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

CHECKPOINT_DIR = "spark.checkpoint.dir"
SCAN = "spark.sql.files.maxPartitionBytes"
KEPT_SCAN_BYTES = 32 * 1024 * 1024
KEPT_BATCH_ROWS = 1000


def get_spark(app_name: str = "flowlake", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session.

    Only settings that are safe for every job are fixed here. Sizing (executors, memory, shuffle
    partitions) belongs to the submit command, so it is taken from ``extra`` or the cluster defaults.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str | None]):
    """Session settings for the jobs started inside; None unsets one."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def size_bytes(size: str) -> int:
    """Bytes of a size as Spark writes it (``128MB``, ``8388608b``, ``1g``)."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit[:1]]


def pieces_of(spark: SparkSession, most: int) -> dict[str, str]:
    """The setting for scans in pieces of at most ``most`` bytes."""
    return {SCAN: str(min(most, size_bytes(spark.conf.get(SCAN))))}


def keep(df: DataFrame) -> DataFrame:
    """Persist ``df``, which may be larger than the executors' memory, on their disks as far as need be.

    What a task holds beside the stored rows is bounded. Blocks are kept as batches of rows, which come from disk one by one; kept as bytes, a
    block would come as one array as large as itself. Java's serializer holds a hundred batches at a time, and a block that another
    executor asks for is held whole, so batches are small, and so are the pieces of files that make a block.
    """
    spark, batch = df.sparkSession, "spark.sql.inMemoryColumnarStorage.batchSize"
    with settings(spark, pieces_of(spark, KEPT_SCAN_BYTES) | {batch: str(min(KEPT_BATCH_ROWS, int(spark.conf.get(batch))))}):
        kept = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
            kept.select("*").rdd.getNumPartitions()  # plans the pieces while the settings hold; fills nothing
    return kept


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table, under the folder named by ``spark.checkpoint.dir``.

    Every executor has to reach it. Where it is unset, which is accepted in a single-process session only (tests), the
    folder lies in the warehouse.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/flowlake/{label}-{uuid.uuid4().hex}"


def materialise(df, label: str):
    """Write ``df`` to the scratch area and read it back: a cut in the lineage that survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
