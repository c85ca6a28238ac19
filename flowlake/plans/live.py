"""Queries that run streams to the end of their input, and queries over the stored feed.

Each run uses a fresh folder in the shared scratch area for tables and checkpoints.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.operators import drift
from flowlake.operators.monitor import topic_totals
from flowlake.plans.catalog import query
from flowlake.plans.cleaning import _MEANS, class_means
from flowlake.plans.sql import with_clean, with_gold
from flowlake.session import scratch_path
from flowlake.sources.adapters import event_records, flow_projection, raw_projection, table
from flowlake.sources.messages import envelope_schema, payloads, table_stream, to_messages, enrich
from flowlake.streaming import live as L
from flowlake.streaming import outbox
from flowlake.streaming.commits import hadoop, make_folder
from flowlake.streaming.exact import start_exact
from flowlake.streaming.layers import Layout, run_layers, silver_rows, start_sink
from flowlake.streaming.rate import live_rate


def _stream(spark, sf, name):
    # A glob, because a supplied table may be a folder or a single file and the source takes no file.
    return table_stream(spark, f"{sf}/{name}.parque[t]", table(spark, sf, name).schema)


def _event_payload(spark, sf):
    feed = event_records(_stream(spark, sf, "events"))
    return payloads(to_messages(feed, keep=["ts"]).withColumnRenamed("ts", "timestamp"))


def _flow_payload(spark, sf):
    raw = raw_projection(flow_projection(_stream(spark, sf, "lineitem")))
    wire = enrich(raw, F.col("event_time"), id_from=raw.columns).drop("event_time")
    # The arrival time is what the watermark follows: it grows with the stream whatever the event times.
    return payloads(to_messages(wire).withColumn("timestamp", F.current_timestamp()))


def _flow_schema(spark, sf):
    raw = raw_projection(flow_projection(table(spark, sf, "lineitem"))).drop("event_time")
    return envelope_schema(T.StructType([T.StructField(f.name, f.dataType) for f in raw.schema.fields]))


def _layers(spark, sf, upto):
    layout = Layout(scratch_path(spark, "layers"))
    return run_layers(spark, _flow_payload(spark, sf), _flow_schema(spark, sf), ["flow_id"], layout, upto)


@query("stream_bronze", """
select year(ts)::int as ingestion_year, month(ts)::int as ingestion_month, day(ts)::int as ingestion_day,
  count(*) as n, sum(event_id)::bigint as sum_id
from (select * from events union all select * from events where event_id % 10 = 0) group by 1, 2, 3""")
def stream_bronze(spark, sf):
    layout = Layout(scratch_path(spark, "bronze"))
    run_layers(spark, _event_payload(spark, sf), T.StructType(), [], layout, upto="bronze")
    rows = spark.read.parquet(layout.table("bronze"))
    number = F.get_json_object("json_payload", "$.event_id").try_cast("long")
    return rows.groupBy("ingestion_year", "ingestion_month", "ingestion_day").agg(
        F.count(F.lit(1)).alias("n"), F.sum(number).alias("sum_id")
    )


@query("stream_silver", with_clean("""
select flow_key, tcp_ack, tcp_len, tcp_srcport, case when source_ip = 'unknown' then 'unknown' else source_ip end as ip_src_host,
  Attack_type, Attack_label from clean"""))
def stream_silver(spark, sf):
    layout = _layers(spark, sf, "silver")
    return silver_rows(spark, layout, _flow_schema(spark, sf)).select(
        "flow_key", "tcp_ack", "tcp_len", "tcp_srcport", "ip_src_host", "Attack_type", "Attack_label"
    )


@query("stream_gold", with_gold(_MEANS))
def stream_gold(spark, sf):
    return class_means(spark.read.parquet(_layers(spark, sf, "gold").table("gold")))


@query("stream_dedup", "select event_type as attack_type, count(*) as n, sum(event_id)::bigint as sum_id from events group by 1")
def stream_dedup(spark, sf):
    """Sent in two halves a restart apart, the second of which repeats part of the first; the state forgets a key after a second."""
    path, inbox = scratch_path(spark, "feed"), make_folder(spark, scratch_path(spark, "inbox"))
    feed = event_records(table(spark, sf, "events"))
    stream = table_stream(spark, inbox, feed.schema)
    for half in ("event_id % 2 = 0", "event_id % 2 = 1 or event_id % 10 = 0"):
        feed.filter(half).write.mode("append").parquet(inbox)
        start_exact(stream, ["event_id"], "ts", path, f"{path}-checkpoint", ttl="1 second", skew="0 seconds").awaitTermination()
    return spark.read.parquet(path).groupBy("attack_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("sum_id")
    )


@query("stream_feed_dedup", """
select count(*) as n from (select distinct ts, user_id % 250 from events)""")
def stream_feed_dedup(spark, sf):
    feed = event_records(_stream(spark, sf, "events"))
    kept = L.feed_dedup(feed, ["ts", "source_ip"], "ts")
    path = scratch_path(spark, "feed")
    start_sink(kept, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@query("stream_class_counts", """
select event_type as attack_type, count(*) + count(case when event_id % 10 = 0 then 1 end) as n from events group by 1""")
def stream_class_counts(spark, sf):
    path = scratch_path(spark, "counts")
    feed = event_records(_stream(spark, sf, "events"))
    L.start_class_counts(feed, "attack_type", path, f"{path}-checkpoint").awaitTermination()
    return L.read_latest(spark, path)


@query("stream_recent", """
select event_id, event_type as attack_type, value from (
  select * from events union all select * from events where event_id % 10 = 0) order by ts desc, event_id desc limit 50""")
def stream_recent(spark, sf):
    path = scratch_path(spark, "recent")
    feed = event_records(_stream(spark, sf, "events"))
    L.start_recent(feed, "ts", path, f"{path}-checkpoint", 50, ["event_id"]).awaitTermination()
    return L.read_recent(spark, path).select("event_id", "attack_type", "value")


@query("tick_counts", """
select epoch_us(date_trunc('minute', ts)) // 1000000 as tick, count(*) as n from events group by 1""")
def tick_counts(spark, sf):
    ticks = L.tick_counts(table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", tick="1 minute")
    return ticks.select(F.unix_seconds("tick").alias("tick"), "n")


def _ticks(span: int, idle: bool = True) -> str:
    return f"""
with s as (select epoch_us(ts) // 1000000 as "second", count(*) as n from events group by 1),
e as (select min("second") as first, max("second") as last from s),
t as (select "second", sum(n)::bigint as n from (select "second" + i as "second", case when i = 0 then n else 0 end as n
  from s, range({span if idle else 1}) r(i)), e where "second" <= last group by 1)
select "second", n, (sum(n) over w)::bigint as window_count,
  ((sum(n) over w) // least({span}, "second" - first + 1))::bigint as rate
from t, e window w as (order by "second" range between {span - 1} preceding and current row)"""


@query("rate_windows", """
""" + _ticks(60))
def rate_windows(spark, sf):
    return L.message_rate(table(spark, sf, "events"), "ts")


@query("rate_windows_hourly", """
""" + _ticks(3600, idle=False))
def rate_windows_hourly(spark, sf):
    return L.message_rate(table(spark, sf, "events"), "ts", span=3600, block=7200, idle=False)


@query("stream_rate", """
""" + _ticks(60))
def stream_rate(spark, sf):
    """The same numbers as ``rate_windows``, from a stream that is stopped and started again between thirds of the time."""
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.lit(False).alias("beat")).filter("ts is not null")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    inbox, path = make_folder(spark, scratch_path(spark, "ticks-in")), scratch_path(spark, "ticks")
    third = (last - first) / 3
    slices = [events.filter(F.col("ts") < first + third), events.filter((F.col("ts") >= first + third) & (F.col("ts") < first + 2 * third)),
              events.filter(F.col("ts") >= first + 2 * third)]
    # The last word is a heartbeat: the feed's clock two seconds after the last message, which closes that message's second.
    slices.append(events.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("interval 2 seconds")).alias("ts"), F.lit(True).alias("beat")))
    stream = table_stream(spark, inbox, events.schema)
    for part in slices:
        part.write.mode("append").parquet(inbox)
        rates = live_rate(stream, "ts", "1 second", heartbeat=F.col("beat"))
        start_sink(rates, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.parquet(path)


@query("stream_messages", """
with m as (select concat('10.1.0.', cast(user_id % 250 as varchar)) as k, * from events union all
  select concat('10.1.0.', cast(user_id % 250 as varchar)), * from events where event_id % 10 = 0)
select k as "key", count(*) as n, sum(event_id)::bigint as sum_id, round(sum("value"), 4) as sum_value, 1::bigint as partitions from m group by 1""")
def stream_messages(spark, sf):
    """Messages in a topic after the sender was lost between sending a batch and noting it, and sent it again."""
    topic = scratch_path(spark, "topic")
    checkpoint = f"{topic}-checkpoint"
    feed = event_records(_stream(spark, sf, "events"))
    outbox.start_messages(to_messages(feed), topic, checkpoint).awaitTermination()
    files, last = hadoop(spark, f"{checkpoint}/commits/0")
    files.delete(last, False)  # batch 0 counts as not done
    outbox.start_messages(to_messages(feed), topic, checkpoint).awaitTermination()
    body = F.from_json("value", "event_id long, value double")
    sent = outbox.once(outbox.read_topic(spark, topic)).select("key", "partition", body.alias("b"))
    return sent.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("b.event_id").alias("sum_id"), F.round(F.sum("b.value"), 4).alias("sum_value"),
        F.count_distinct("partition").alias("partitions"))


@query("drift_ledger", """
with k(field, "type", status, cond) as (values ('flow_id', 'STRING', 'known', 'all'), ('attack_type', 'STRING', 'known', 'all'),
  ('source_ip', 'BIGINT', 'retyped', 'all'), ('tcp.ack', 'DOUBLE', 'known', 'ack'), ('tcp.ack', 'STRING', 'retyped', 'text'),
  ('geo', 'OBJECT', 'unknown', '7'), ('retries', 'BIGINT', 'unknown', '11')),
e as (select event_id, event_id % 13 = 0 as text from events where event_id % 17 <> 0)
select field, "type", status, count(*) as n from k join e on cond = 'all' or (cond = 'ack' and not text) or (cond = 'text' and text)
  or (cond = '7' and event_id % 7 = 0) or (cond = '11' and event_id % 11 = 0) group by 1, 2, 3""")
def drift_ledger(spark, sf):
    """Fields and types of a stream's messages against the schema; one message in 17 is no object."""
    number = F.col("event_id")
    plain = {"flow_id": number.cast("string"), "attack_type": F.col("event_type"), "source_ip": F.col("user_id"),
             "geo": F.when(number % 7 == 0, F.struct(F.lit("x").alias("country"))), "retries": F.when(number % 11 == 0, number)}
    as_number = F.to_json(F.struct(*[c.alias(n) for n, c in plain.items()], (number + 0.5).alias("tcp.ack")))
    as_text = F.to_json(F.struct(*[c.alias(n) for n, c in plain.items()], F.lit("n/a").alias("tcp.ack")))
    text = F.when(number % 17 == 0, F.lit("[1]")).when(number % 13 == 0, as_text).otherwise(as_number)
    schema = envelope_schema(T.StructType([T.StructField("tcp.ack", T.DoubleType())]))
    path = scratch_path(spark, "ledger")
    payload = _stream(spark, sf, "events").select(text.alias("json_payload"))
    drift.start_ledger(payload, schema, path, f"{path}-checkpoint").awaitTermination()
    return drift.read_ledger(spark, path).select("field", "type", "status", "n")


@query("recent_k", """
select event_id, user_id, event_type, value from events order by ts desc, event_id desc limit 50""")
def recent_k(spark, sf):
    return L.recent(table(spark, sf, "events"), "ts", 50, ["event_id"]).select("event_id", "user_id", "event_type", "value")


@query("attack_pct", """
with e as (select case when event_id % 7 <> 0 then event_type end as kind from events)
select count(*) as messages, count(case when kind <> 'view' then 1 end) as attacks,
  round(count(case when kind <> 'view' then 1 end) * 100.0::double / count(*), 1) as attack_pct from e""")
def attack_pct(spark, sf):
    kinds = table(spark, sf, "events").select(F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("kind"))
    return L.attack_share(kinds, "kind", normal="view")


@query("stream_accounting", """
with e as (select event_id, case when event_id % 23 = 0 then 'unreadable' when event_id % 19 = 0 then 'no key' else 'ok' end as fate
  from events)
select count(*) + count(case when event_id % 10 = 0 then 1 end) as rows_in, count(case when fate = 'ok' then 1 end) as kept,
  count(case when fate = 'ok' and event_id % 10 = 0 then 1 end) as copies,
  count(case when fate = 'unreadable' then 1 end) + count(case when fate = 'unreadable' and event_id % 10 = 0 then 1 end) as unreadable,
  count(case when fate = 'no key' then 1 end) + count(case when fate = 'no key' and event_id % 10 = 0 then 1 end) as no_key
from e""")
def stream_accounting(spark, sf):
    """Every message ends in the clean layer, as a copy of one there, or among the dead letters; the feed's own clock
    (out of order, so that some rows come a month late) is the arrival time here."""
    feed = event_records(_stream(spark, sf, "events"))
    number = F.col("event_id")
    body = F.to_json(F.struct(F.when(number % 19 != 0, number.cast("string")).alias("flow_id"), F.col("attack_type").alias("attack_type")))
    text = F.when(number % 23 == 0, F.concat(F.lit("<"), number.cast("string"))).otherwise(body)
    payload = feed.select(text.alias("value"), F.col("ts").alias("timestamp"))
    schema = envelope_schema(T.StructType([T.StructField("flow_id", T.StringType())]))
    layout = Layout(scratch_path(spark, "accounting"))
    run_layers(spark, payloads(payload), schema, ["flow_id"], layout, upto="silver")
    count = lambda name, test="true": spark.read.parquet(layout.table(name)).agg(F.count_if(F.expr(test))).scalar()
    bad = [count("dead_letters", f"reason = '{reason}'") for reason in ("unreadable", "no key")]
    return spark.range(1).select(
        count("bronze").alias("rows_in"), count("silver").alias("kept"),
        (count("bronze") - count("silver") - bad[0] - bad[1]).alias("copies"), bad[0].alias("unreadable"), bad[1].alias("no_key"))


@query("topic_totals", """
select sum(n)::bigint as total_messages, count(*) as partitions from (
  select event_id % 3 as p, max(event_id // 3) - min(event_id // 3) + 1 as n from events group by 1)""")
def topic(spark, sf):
    records = table(spark, sf, "events").select(
        (F.col("event_id") % 3).alias("partition"), F.floor(F.col("event_id") / 3).alias("offset")
    )
    return topic_totals(records)
