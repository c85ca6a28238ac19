"""Sending a stream of messages so that a batch which runs again leaves no second copy.

Every message carries who sent it: the query's id (kept in its checkpoint), the batch, and its place in the batch. A batch counts once
its marker ``query=<id>/batch=<number>`` is in the manifest.

* A *folder topic* holds the messages themselves under those names; a batch appears by one rename, which is the marker too.
* A *broker* gets the batch first and the marker is set after, so a sender lost in between sends again. As the batch is made anew
  from the same offsets and ordered by key and value, each message gets the same place again, and ``once`` drops the second copy
  on the reading side, with state bounded by its time to live.

Messages of one key keep to one partition: a hash of the key, as brokers choose it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake.streaming.commits import commit_batch, exists, folder_names, hadoop
from flowlake.streaming.exact import recent_once

SENDER = ["sender", "batch_id", "place"]
MESSAGE = "key string, value string, partition int, sender string, batch_id long, place long"


def addressed(batch: DataFrame, sender: str, number: int, partitions: int) -> DataFrame:
    """``key, value, partition`` and the sender's columns; the place counts within the partition, in the order of key and value."""
    to = F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(partitions)).cast("int")
    # Sorted per (partition, slice of the key): a slice holds whole keys, and no task more than one slice.
    rows = batch.select("key", "value", to.alias("partition"), F.pmod(F.hash("key", "value"), F.lit(1024)).alias("_slice"))
    place = F.row_number().over(Window.partitionBy("partition", "_slice").orderBy("key", "value")) * 1024 + F.col("_slice")
    return rows.select("key", "value", "partition", F.lit(sender).alias("sender"), F.lit(number).cast("long").alias("batch_id"),
                       place.cast("long").alias("place"))


def to_folder(batch: DataFrame, topic: str, sender: str, number: int, partitions: int = 3) -> bool:
    """Append a batch to a folder topic; False if it is there already."""
    if exists(batch.sparkSession, f"{topic}/query={sender}/batch={number}"):
        return False
    return commit_batch(addressed(batch, sender, number, partitions), f"{topic}/query={sender}", number)


def to_broker(batch: DataFrame, send: Callable[[DataFrame], None], manifest: str, sender: str, number: int, partitions: int = 3) -> bool:
    """Hand a batch to ``send`` unless the manifest has it, then mark it."""
    files, marker = hadoop(batch.sparkSession, f"{manifest}/query={sender}/batch={number}")
    if files.exists(marker):
        return False
    send(addressed(batch, sender, number, partitions))
    files.mkdirs(marker)
    return True


def start_messages(messages: DataFrame, topic: str, checkpoint: str, partitions: int = 3, every: str | None = None,
                   send: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Send a stream of ``key, value``: into the folder ``topic``, or by ``send`` with the manifest in that folder."""
    spark = messages.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        sender = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint.rsplit("/", 1)[-1]
        if send is None:
            to_folder(batch, topic, sender, number, partitions)
        else:
            to_broker(batch, send, topic, sender, number, partitions)

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_topic(spark: SparkSession, topic: str) -> DataFrame:
    """All messages of a folder topic; what is still being written is not seen."""
    found = [f"{topic}/{q}" for q in folder_names(spark, topic) if q.startswith("query=")]
    paths = [f"{q}/{b}" for q in found for b in folder_names(spark, q) if b.startswith("batch=")]
    if not paths:
        return spark.createDataFrame([], MESSAGE)
    return spark.read.schema(MESSAGE).parquet(*paths)


def topic_stream(spark: SparkSession, topic: str, files_per_trigger: int | None = None) -> DataFrame:
    """The messages of a folder topic as a stream."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(f"{topic}/query=*/batch=*")


def once(messages: DataFrame, ttl: str = "1 day") -> DataFrame:
    """Messages without the copies that a sender, lost between sending and marking, sent again."""
    names = ["partition", *SENDER]
    return recent_once(messages, names, ttl).select(*messages.columns) if messages.isStreaming else messages.dropDuplicates(names)
