"""Counters over the event feed, for streams and for stored feeds alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake.functions.safe import quoted
from flowlake.streaming.commits import committed, exists, hadoop
from flowlake.streaming.exact import recent_once


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Messages per class. On a stream the state is one counter per class."""
    return df.groupBy(quoted(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))


def start_class_counts(stream: DataFrame, label: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the table of running counts current: one complete folder per batch under ``path``, see ``read_latest``."""
    spark = stream.sparkSession

    def replace(batch: DataFrame, number: int) -> None:
        # Repartitioned, not coalesced: the counters stay spread over the state's tasks.
        batch.repartition(1).write.mode("overwrite").parquet(f"{path}/batch={number}")  # one row per class
        _forget(spark, path, number - 1)

    writer = (
        class_counts(stream, label).writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint).foreachBatch(replace)
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def tick_counts(df: DataFrame, ts: str, delay: str = "1 minute", tick: str = "1 second") -> DataFrame:
    """Messages per tick; on a stream ticks close once the watermark has passed them."""
    if df.isStreaming:
        df = df.withWatermark(ts, delay)
    return df.groupBy(F.window(ts, tick).alias("_w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("_w.start").alias("tick"), "n"
    )


def message_rate(df: DataFrame, ts: str, span: int = 60, block: int = 3600, idle: bool = True) -> DataFrame:
    """The integer mean of the last ``span`` per-second counts, for every second that has a message and, with ``idle``,
    every second less than ``span`` seconds after one (later the rate is 0 until the next message).

    While fewer than ``span`` seconds have passed since the first message, the mean is over those. Rows are folded to
    seconds first. Time is then cut into blocks of ``block`` seconds that also get the tail of the block before, so the
    running sum never needs all seconds in one task. A busy second brings along the idle ones up to the next busy one, so no second is
    made twice, and the block's window serves both the look ahead and the sum. On a stream see ``rate.live_rate``.
    """
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    busy = df.select(second.alias("second")).filter("second is not null").groupBy("second").agg(F.count(F.lit(1)).alias("n"))
    ends = busy.agg(F.struct(F.min("second").alias("first"), F.max("second").alias("last")).alias("ends")).scalar()
    first, last = ends.getField("first"), ends.getField("last")
    own = F.floor(F.col("second") / block)
    later = F.floor((F.col("second") + span - 1) / block)
    spread = busy.select("second", "n", F.explode(F.sequence(own, later)).alias("_block"))
    in_block = Window.partitionBy("_block").orderBy("second")
    if idle:
        until = F.least(F.lead("second").over(in_block) - 1, F.col("second") + (span - 1), last)  # nulls are passed over
        spread = spread.withColumn("_until", until).select(
            "_block", "n", F.col("second").alias("_busy"), F.explode(F.sequence("second", "_until")).alias("second"))
        spread = spread.withColumn("n", F.when(F.col("second") == F.col("_busy"), F.col("n")).otherwise(F.lit(0)))
    recent = in_block.rangeBetween(-(span - 1), 0)
    passed = F.least(F.lit(span), F.col("second") - first + 1)
    return (
        spread.withColumn("window_count", F.sum("n").over(recent)).filter(F.col("_block") == own)
        .select("second", "n", "window_count", F.floor(F.col("window_count") / passed).alias("rate"))
    )


def recent(df: DataFrame, ts: str, k: int = 50, tie: list[str] | None = None) -> DataFrame:
    """The ``k`` newest rows, newest first; each task keeps only its own best ``k``."""
    return df.orderBy(F.desc(ts), *[F.desc(c) for c in tie or []]).limit(k)


def start_recent(stream: DataFrame, ts: str, path: str, checkpoint: str, k: int = 50, tie: list[str] | None = None,
                 every: str | None = None) -> StreamingQuery:
    """Keep the ``k`` newest rows of a stream, one folder per batch under ``path``.

    A batch merges the previous folder with its own rows and writes the next one, so a retried batch
    gives the same folder again.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch
        if number > 0:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/batch={number - 1}").unionByName(batch)
        recent(rows, ts, k, tie).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")
        _forget(spark, path, number - 2)  # a retry still needs the folder before this one

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _forget(spark, path: str, number: int) -> None:
    """Remove the folder of an older batch."""
    files, where = hadoop(spark, f"{path}/batch={number}")
    if number >= 0 and files.exists(where):
        files.delete(where, True)


def read_latest(spark, path: str) -> DataFrame:
    """The newest complete batch folder under ``path``; older ones are not opened, other folders are not ours."""
    done = [n for n in committed(spark, path) if exists(spark, f"{path}/batch={n}/_SUCCESS")]
    if not done:
        raise FileNotFoundError(f"no batch has been completed under {path}")
    return spark.read.parquet(f"{path}/batch={max(done)}")


read_recent = read_latest


def attack_share(df: DataFrame, label: str, normal: str = "Normal") -> DataFrame:
    """Messages, those of a non-normal class, and their share in percent with one digit.

    A message without a class counts as normal.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.coalesce(quoted(label), F.lit(normal)) != normal).alias("attacks"),
    )
    share = F.try_divide(F.col("attacks") * 100.0, F.col("messages").cast("double"))
    return counts.withColumn("attack_pct", F.coalesce(F.round(share, 1), F.lit(0.0)))


def feed_dedup(df: DataFrame, keys: list[str], ts: str, delay: str | None = None, ttl: str = "1 day") -> DataFrame:
    """One row per key: (time, source, target) for the feed, ``flow_id`` for flows.

    On a stream the state is bounded: a key is remembered for ``ttl`` after it arrived, and no row is late. A ``delay`` bounds it by the
    rows' own times instead; rows that come later than that are lost, see ``dropped_late``. For tables that must not hold
    a copy however late it comes, see ``exact.start_exact``.
    """
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    if delay is None:
        return recent_once(df, keys, ttl).select(*df.columns)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def dropped_late(query: StreamingQuery) -> int:
    """Rows a finished or running query discarded as late, over the progress it still remembers."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress for op in progress["stateOperators"]
    )


def label_or_normal(df: DataFrame, names: list[str], normal: str = "Normal") -> Column:
    """Class of a message: the first label field it has, else the normal one."""
    return F.coalesce(*[quoted(c) for c in names if c in df.columns], F.lit(normal))
