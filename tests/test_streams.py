"""Messages, layers, restarts and late rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.session import scratch_path
from flowlake.sources import tables
from flowlake.sources.messages import enrich, envelope_schema, parse_payload, table_stream, to_messages, unreadable
from flowlake.streaming import layers as S
from flowlake.streaming import live as L

SCHEMA = envelope_schema(T.StructType([
    T.StructField("tcp.ack", T.DoubleType()), T.StructField("tcp.seq", T.DoubleType()),
    T.StructField("Attack_type", T.StringType()),
]))
PAYLOAD = "json_payload string, ingestion_time timestamp"


def at(second):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


def message(flow, ack=1.0):
    return json.dumps({"tcp.ack": ack, "tcp.seq": 1.0, "Attack_type": "Normal", "flow_id": flow})


def test_envelope_is_case_insensitive():
    assert [f.name for f in SCHEMA.fields] == ["tcp.ack", "tcp.seq", "Attack_type", "flow_id", "source_ip", "dest_ip", "timestamp"]


def test_parse_bad_rows(spark):
    texts = [message("a"), '{"flow_id": "b", "tcp.ack": "oops"}', "not json", "{}", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, json_payload string")
    rows = parse_payload(df, SCHEMA).withColumn("bad", unreadable(SCHEMA)).orderBy("i").collect()
    assert [r["bad"] for r in rows] == [False, False, True, True, True, True]
    assert rows[1]["flow_id"] == "b" and rows[1]["tcp.ack"] is None


def test_enrich_defaults(spark):
    df = spark.createDataFrame(
        [("1.1.1.1", "", None, "80"), (None, "2.2.2.2", "MITM", None)],
        "`ip.src_host` string, `arp.src.proto_ipv4` string, Attack_type string, `tcp.srcport` string",
    )
    rows = enrich(df, F.lit("t")).collect()
    assert rows[0]["flow_id"].startswith("1.1.1.1:80-0.0.0.0:0-t-") and rows[0]["Attack_type"] == "Normal"
    assert rows[1]["flow_id"].startswith("2.2.2.2:0-0.0.0.0:0-t-") and rows[1]["Attack_type"] == "MITM"


def test_ids_differ_unless_rows_are_copies(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("", None), (None, ""), (None, ""), ("a", "b|c")]
    df = spark.createDataFrame(rows, "x string, y string")
    for ids in (enrich(df, F.lit("t")), enrich(df, F.lit("t"), id_from=["x", "y"])):
        assert ids.select("flow_id").distinct().count() == 4


def test_guessed_types(spark):
    df = spark.createDataFrame([("7", "1.50", 'a "q"', "", None, "1.2.3.4")], "a string, b string, c string, d string, e string, f string")
    text = to_messages(df, key="a", guess=True).first()["value"]
    assert json.loads(text) == {"a": 7, "b": 1.5, "c": 'a "q"', "f": "1.2.3.4"}
    odd = spark.createDataFrame([("1.0e999", float("inf"), "5", 2.5)], "a string, b double, c string, d double")
    assert json.loads(to_messages(odd, key="c", guess=True).first()["value"]) == {"a": "1.0e999", "b": "Infinity", "c": 5, "d": 2.5}


def _write(spark, path, rows, order):
    spark.createDataFrame(rows, PAYLOAD).coalesce(1).write.mode("append").parquet(path)


def test_raw_layer_is_packed(spark):
    source, layout = scratch_path(spark, "t-in"), S.Layout(scratch_path(spark, "t-out"))
    _write(spark, source, [(message(str(i)), at(i)) for i in range(20)], 0)
    S.run_layers(spark, table_stream(spark, source, T.StructType.fromDDL(PAYLOAD)), SCHEMA, ["flow_id"], layout, upto="bronze")
    raw = spark.read.parquet(layout.table("bronze"))
    assert raw.count() == 20 and all(f.endswith(".zstd.parquet") for f in raw.inputFiles())


def test_layers_restart_and_dead_letters(spark):
    source, layout = scratch_path(spark, "t-in"), S.Layout(scratch_path(spark, "t-out"))
    payload_schema = T.StructType.fromDDL(PAYLOAD)

    def run():
        S.run_layers(spark, table_stream(spark, source, payload_schema), SCHEMA, ["flow_id"], layout)

    _write(spark, source, [(message("a"), at(0)), (message("a"), at(5)), ("junk", at(6)), ('{"tcp.ack": 2.0}', at(7))], 0)
    run()
    _write(spark, source, [(message("b", 4.0), at(20)), (message("a"), at(30))], 1)
    run()
    run()  # nothing new
    gold = spark.read.parquet(layout.table("gold"))
    assert {r["flow_id"]: r["traffic_asymmetry_ratio"] for r in gold.collect()} == {"a": 0.5, "b": 2.0}
    assert gold.count() == 2
    assert spark.read.parquet(layout.table("bronze")).count() == 6
    dead = spark.read.parquet(layout.table("dead_letters")).collect()
    assert sorted((r["reason"], r["json_payload"]) for r in dead) == [("no key", '{"tcp.ack": 2.0}'), ("unreadable", "junk")]


def test_continuous_layers(spark):
    source, layout = scratch_path(spark, "t-in"), S.Layout(scratch_path(spark, "t-out"))
    _write(spark, source, [(message("a"), at(0)), (message("a"), at(1)), ("junk", at(2))], 0)
    stream = table_stream(spark, source, T.StructType.fromDDL(PAYLOAD))
    queries = S.start_layers(spark, stream, SCHEMA, ["flow_id"], layout, every="1 second")
    try:
        queries[0].processAllAvailable()
        _write(spark, source, [(message("b"), at(3))], 1)
        for query in queries:
            query.processAllAvailable()
        assert all(q.exception() is None for q in queries)
    finally:
        for query in queries:
            query.stop()
    gold = spark.read.parquet(layout.table("gold"))
    assert sorted(r["flow_id"] for r in gold.collect()) == ["a", "b"]
    assert spark.read.parquet(layout.table("dead_letters")).count() == 1


def test_stream_equals_batch(spark):
    rows = [(message(f"f{i % 70}", float(i % 70)), at(i)) for i in range(200)] + [("junk", at(1))]
    source, layout = scratch_path(spark, "t-in"), S.Layout(scratch_path(spark, "t-out"))
    _write(spark, source, rows, 0)
    S.run_layers(spark, table_stream(spark, source, T.StructType.fromDDL(PAYLOAD)), SCHEMA, ["flow_id"], layout)
    batch = S.gold(S.silver(spark.createDataFrame(rows, PAYLOAD), SCHEMA, ["flow_id"])).drop("ingestion_time")
    stream = spark.read.parquet(layout.table("gold")).select(batch.columns)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_late_rows_are_counted(spark):
    source, out = scratch_path(spark, "t-in"), scratch_path(spark, "t-out")
    shape = T.StructType.fromDDL("k string, ts timestamp")
    for batch in [[("a", at(0)), ("b", at(90_000))], [("c", at(90_001))], [("late", at(10))]]:
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(source)
        feed = L.feed_dedup(table_stream(spark, source, shape), ["k"], "ts", "1 hour")
        query = S.start_sink(feed, out, f"{out}-c")
        query.awaitTermination()
    assert {r["k"] for r in spark.read.parquet(out).collect()} == {"a", "b", "c"}
    assert L.dropped_late(query) == 1


def test_no_row_is_late_by_default(spark):
    source, layout = scratch_path(spark, "t-in"), S.Layout(scratch_path(spark, "t-out"))
    shape = T.StructType.fromDDL(PAYLOAD)
    batches = [[(message("a"), at(0)), (message("b"), at(900_000))], [(message("late"), at(10)), (message("a"), at(11)), ("junk", at(5))]]
    for n, rows in enumerate(batches):
        _write(spark, source, rows, n)
        S.run_layers(spark, table_stream(spark, source, shape), SCHEMA, ["flow_id"], layout, upto="silver")
    assert sorted(r["flow_id"] for r in spark.read.parquet(layout.table("silver")).collect()) == ["a", "b", "late"]
    assert spark.read.parquet(layout.table("dead_letters")).count() == 1  # 5 rows in: 3 kept, 1 copy, 1 dead letter


def test_recent_over_batches(spark):
    source, out = scratch_path(spark, "t-in"), scratch_path(spark, "t-out")
    shape = T.StructType.fromDDL("k long, ts timestamp")
    for n in range(3):
        rows = [(n * 10 + i, at(n * 10 + i)) for i in range(10)]
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(source)
    stream = table_stream(spark, source, shape, files_per_trigger=1)
    L.start_recent(stream, "ts", out, f"{out}-c", 4, ["k"]).awaitTermination()
    assert sorted(r["k"] for r in L.read_recent(spark, out).collect()) == [26, 27, 28, 29]


def test_since_prunes_folders(spark):
    df = spark.createDataFrame([(at(86400 * i), i) for i in range(40)], "ingestion_time timestamp, i int")
    stored = tables.write_table(tables.with_date_parts(df), scratch_path(spark, "t-dated"), partition_by=tables.DATE_PARTS)
    recent = tables.since(stored, dt.date(2024, 1, 30))
    assert recent.count() == 11
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((ingestion_year" in plan or "PartitionFilters: [(((ingestion_year" in plan


def test_csv_types_come_from_all_rows(spark):
    path = scratch_path(spark, "t-csv")
    tables.write_csv(spark.range(3000).select(F.when(F.col("id") == 2999, "text").otherwise(F.col("id").cast("string")).alias("v")).coalesce(1), path)
    back = tables.read_csv(spark, path)
    assert dict(back.dtypes)["v"] == "string" and back.filter("v is null").count() == 0


def test_read_table_falls_back(spark):
    path = scratch_path(spark, "t-table")
    tables.write_table(spark.range(3).toDF("a"), path)
    assert tables.read_table(spark, path, "delta", fallback="parquet").count() == 3
    with pytest.raises(Exception):
        tables.read_table(spark, path, "delta")
    assert tables.read_first(spark, [path + "-none", path]).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_first(spark, [path + "-none"])
