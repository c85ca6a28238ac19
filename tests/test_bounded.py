"""Bounded state, batches that run again, files and versions, drift, folds, profiles and sketches."""

import datetime as dt
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.ordered import exact_quantiles
from flowlake.operators import drift, models, monitor, profiles, sketches
from flowlake.operators import mlprep as M
from flowlake.operators import quality as Q
from flowlake.session import scratch_path
from flowlake.sources import filelist, tables
from flowlake.sources.messages import table_stream
from flowlake.streaming import commits, exact, outbox, scoring
from flowlake.streaming import live as L
from flowlake.streaming.layers import start_sink
from flowlake.streaming.rate import live_rate

FEED = "k string, ts timestamp, v long"


def at(second):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


def add(spark, path, rows, schema=FEED):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def forget_last_commit(spark, checkpoint):
    """As if the query was lost before it noted its last batch as done."""
    files, folder = commits.hadoop(spark, f"{checkpoint}/commits")
    last = max(int(f.getPath().getName()) for f in files.listStatus(folder) if f.getPath().getName().isdigit())
    files.delete(commits.hadoop(spark, f"{checkpoint}/commits/{last}")[1], False)
    return last


# -- exact deduplication

def test_exact_dedup_with_bounded_state(spark):
    """Keys leave the state after their time to live, and copies that come later still find no way into the table."""
    inbox, out = commits.make_folder(spark, scratch_path(spark, "t-in")), scratch_path(spark, "t-out")
    stream = table_stream(spark, inbox, T.StructType.fromDDL(FEED))
    state = []
    for step in range(5):
        fresh = [(f"{step}-{i}", at(86_400 * step + i), i) for i in range(50)]
        copies = [(f"{s}-{i}", at(86_400 * s + i), 99) for s in range(step) for i in range(0, 50, 5)]
        add(spark, inbox, fresh + copies + fresh[:3])
        query = exact.start_exact(stream, ["k"], "ts", out, f"{out}-c", ttl="1 second", skew="0 seconds")
        query.awaitTermination()
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(2.2)
    rows = [r["k"] for r in spark.read.parquet(out).collect()]
    assert len(rows) == len(set(rows)) == 250
    assert max(state) < 200 and state[-1] < 150  # without forgetting it would end at 250


def test_exact_dedup_survives_a_batch_that_runs_again(spark):
    inbox, out = commits.make_folder(spark, scratch_path(spark, "t-in")), scratch_path(spark, "t-out")
    stream = table_stream(spark, inbox, T.StructType.fromDDL(FEED))
    start = lambda: exact.start_exact(stream, ["k"], "ts", out, f"{out}-c", ttl="1 hour").awaitTermination()
    add(spark, inbox, [("a", at(1), 1), ("a", at(1), 2), ("b", None, 3)])
    start()
    forget_last_commit(spark, f"{out}-c")
    add(spark, inbox, [("a", at(1), 4), ("b", None, 5), ("c", at(2), 6)])
    start()
    forget_last_commit(spark, f"{out}-c")
    start()
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_first_batch_is_read_once_and_later_ones_are_kept(spark, monkeypatch):
    """There is nothing to compare the first batch with: it is not stored, and its days are not collected."""
    inbox, out = commits.make_folder(spark, scratch_path(spark, "t-in")), scratch_path(spark, "t-out")
    stream = table_stream(spark, inbox, T.StructType.fromDDL(FEED))
    kept, kind = [], type(spark.range(1))
    persist = kind.persist
    monkeypatch.setattr(kind, "persist", lambda self, *a: kept.append(len(commits.committed(spark, out))) or persist(self, *a))
    for k in range(2):
        add(spark, inbox, [("a", at(k), 1), ("a", at(k), 2), (f"b{k}", None, 3)])
        exact.start_exact(stream, ["k"], "ts", out, f"{out}-c", ttl="1 hour").awaitTermination()
    assert kept and 0 not in kept
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["a", "b0", "b1"]


def test_layers_of_an_empty_feed(spark):
    from flowlake.sources.messages import envelope_schema
    from flowlake.streaming.layers import Layout, run_layers, silver_rows
    inbox = commits.make_folder(spark, scratch_path(spark, "t-in"))
    schema = envelope_schema(T.StructType.fromDDL("`tcp.ack` double, `tcp.seq` double, Attack_type string"))
    layout = Layout(scratch_path(spark, "t-empty"))
    run_layers(spark, table_stream(spark, inbox, T.StructType.fromDDL("json_payload string, ingestion_time timestamp")), schema, ["flow_id"], layout)
    assert silver_rows(spark, layout, schema).count() == 0


def test_late_rows_open_only_the_folders_of_their_days(spark):
    out = scratch_path(spark, "t-keys")
    for number in range(3):
        rows = spark.createDataFrame([(f"{number}-{d}", at(86_400 * d), d) for d in range(10)], FEED).withColumn("event_day", exact.event_day("ts"))
        commits.commit_batch(rows, out, number, ["event_day"])
    key = T.StructType.fromDDL(FEED).fields[0]
    found = exact.stored_keys(spark, out, [key], [dt.date(2024, 1, 3), dt.date(2030, 1, 1)], before=2)
    assert sorted(r["k"] for r in found.collect()) == ["0-2", "1-2"]
    assert all("event_day=2024-01-03" in f for f in found.inputFiles())
    assert exact.stored_keys(spark, out, [key], [dt.date(2030, 1, 1)], before=2) is None


def test_a_copy_of_the_day_before_is_found_with_spread(spark):
    inbox, out = commits.make_folder(spark, scratch_path(spark, "t-in")), scratch_path(spark, "t-out")
    stream = table_stream(spark, inbox, T.StructType.fromDDL(FEED))
    for day in (5, 6):
        add(spark, inbox, [("a", at(86_400 * day), day)])
        exact.start_exact(stream, ["k"], "ts", out, f"{out}-c", ttl="1 second", spread=1).awaitTermination()
        time.sleep(2.2)
        add(spark, inbox, [("x" + str(day), at(86_400 * day), day)])  # moves the clock of the state on
        exact.start_exact(stream, ["k"], "ts", out, f"{out}-c", ttl="1 second", spread=1).awaitTermination()
    assert Counter(r["k"] for r in spark.read.parquet(out).collect()) == {"a": 1, "x5": 1, "x6": 1}


# -- message rate

def plain_rate(seconds, span=60, upto=None):
    counts, first, last = Counter(seconds), min(seconds), upto or max(seconds)
    out = []
    for t in range(first, last + 1):
        window = sum(counts[s] for s in range(t - span + 1, t + 1))
        if window:
            out.append((t, counts[t], window, window // min(span, t - first + 1)))
    return out


def test_batch_rate(spark):
    rng = random.Random(1)
    seconds = sorted(rng.choice([1000, 1001, 1050, 1200, 1201, 1999, 2100, 3599, 3600, 7300]) + rng.randrange(3) for _ in range(200))
    df = spark.createDataFrame([(at(s),) for s in seconds], "ts timestamp")
    zero = int(at(0).replace(tzinfo=dt.timezone.utc).timestamp())
    for block in (61, 100, 3600):
        got = sorted(tuple(r) for r in L.message_rate(df, "ts", 60, block).collect())
        assert got == plain_rate([zero + s for s in seconds])


def test_stream_rate_over_restarts(spark):
    """Idle seconds are emitted, a quiet key is driven by the clock of the others, and nothing is lost between runs."""
    rng = random.Random(2)
    inbox, out = commits.make_folder(spark, scratch_path(spark, "t-in")), scratch_path(spark, "t-out")
    schema = "src string, ts timestamp, beat boolean"
    zero = int(at(0).replace(tzinfo=dt.timezone.utc).timestamp())
    sent = {"a": [], "b": []}
    for step in range(4):
        rows = [(k, step * 100 + rng.randrange(90)) for k in ("a", "b") for _ in range(rng.randrange(1, 40)) if k == "a" or step < 2]
        for k, s in rows:
            sent[k].append(zero + s)
        add(spark, inbox, [(k, at(s), False) for k, s in rows] + [("clock", at(step * 100 + 99), True)], schema)
        rates = live_rate(table_stream(spark, inbox, T.StructType.fromDDL(schema)), "ts", "1 second", keys=["src"], heartbeat=F.col("beat"))
        start_sink(rates, out, f"{out}-c").awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("src", "second", "n", "window_count", "rate").collect())
    closed = zero + 3 * 100 + 99 - 2  # the clock less the delay: seconds before that one are closed
    want = [(k, *r) for k in sent for r in plain_rate(sent[k], upto=closed)]
    assert got == sorted(want)


# -- scoring

@pytest.fixture(scope="module")
def two_models(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Bucketizer
    fit = lambda cut: Pipeline(stages=[Bucketizer(splits=[float("-inf"), cut, float("inf")], inputCol="x", outputCol="prediction")]).fit(
        spark.createDataFrame([(1.0,)], "x double"))
    return fit(0.0), fit(10.0)


def test_model_version_is_fixed_per_batch(spark, two_models):
    inbox, root, out = (scratch_path(spark, f"t-{n}") for n in ("in", "models", "out"))
    commits.make_folder(spark, inbox)
    stream = table_stream(spark, inbox, T.StructType.fromDDL("x double"))
    start = lambda: scoring.start_scoring(stream, root, out, f"{out}-c", ["low", "high"]).awaitTermination()
    add(spark, inbox, [(-1.0,), (5.0,)], "x double")
    assert scoring.publish(spark, two_models[0], root) == 1
    start()
    add(spark, inbox, [(5.0,), (20.0,)], "x double")
    assert scoring.publish(spark, two_models[1], root) == 2 and scoring.versions(spark, root) == [1, 2]
    start()
    got = sorted(tuple(r) for r in scoring.read_scored(spark, out).select("model_version", "x", "predicted_class").collect())
    assert got == [(1, -1.0, "low"), (1, 5.0, "high"), (2, 5.0, "low"), (2, 20.0, "high")]
    batch = spark.createDataFrame([(-1.0,), (5.0,)], "x double")
    from flowlake.operators.models import score
    assert sorted(r["prediction"] for r in score(batch, two_models[0]).collect()) == [0.0, 1.0]


def test_a_batch_that_runs_again_keeps_its_version(spark, two_models):
    root, notes = scratch_path(spark, "t-models"), scratch_path(spark, "t-notes")
    with pytest.raises(FileNotFoundError):
        scoring.chosen(spark, root, notes, 0)
    scoring.publish(spark, two_models[0], root)
    assert scoring.chosen(spark, root, notes, 0) == 1
    scoring.publish(spark, two_models[1], root)
    assert scoring.chosen(spark, root, notes, 0) == 1 and scoring.chosen(spark, root, notes, 1) == 2
    assert scoring.chosen(spark, root, notes, 10) == 2  # "1-" is no prefix of "10-"


# -- messages

def test_messages_are_sent_once(spark):
    inbox, topic = commits.make_folder(spark, scratch_path(spark, "t-in")), scratch_path(spark, "t-topic")
    schema = "key string, value string"
    stream = table_stream(spark, inbox, T.StructType.fromDDL(schema))
    rows = [(f"k{i % 5}", str(i % 20)) for i in range(60)] + [(None, "x")]
    add(spark, inbox, rows, schema)
    outbox.start_messages(stream, topic, f"{topic}-c").awaitTermination()
    forget_last_commit(spark, f"{topic}-c")
    outbox.start_messages(stream, topic, f"{topic}-c").awaitTermination()
    got = outbox.read_topic(spark, topic)
    assert Counter(map(tuple, got.select("key", "value").collect())) == Counter(rows)
    assert got.select("sender", "batch_id", "place", "partition").distinct().count() == len(rows)
    assert got.groupBy("key").agg(F.count_distinct("partition").alias("p")).filter("p > 1").count() == 0
    assert outbox.read_topic(spark, scratch_path(spark, "t-none")).count() == 0


def test_a_broker_that_got_a_batch_twice(spark):
    """The sender is lost after sending and before the marker; readers see each message once."""
    manifest, sent = scratch_path(spark, "t-manifest"), scratch_path(spark, "t-broker")
    rows = [(f"k{i % 3}", str(i % 4)) for i in range(20)]
    batch = spark.createDataFrame(rows, "key string, value string")
    send = lambda df: df.write.mode("append").parquet(sent)

    def lost(df):
        send(df)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        outbox.to_broker(batch, lost, manifest, "q", 0)
    assert outbox.to_broker(batch.repartition(5), send, manifest, "q", 0)
    assert not outbox.to_broker(batch, send, manifest, "q", 0)
    assert spark.read.parquet(sent).count() == 40
    assert Counter(map(tuple, outbox.once(spark.read.parquet(sent)).select("key", "value").collect())) == Counter(rows)


# -- files

def test_compaction_leaves_large_files_and_old_versions(spark):
    path = scratch_path(spark, "t-files")
    filelist.append(spark.range(200_000).select("id", F.rand(1).alias("x")).coalesce(1), path)
    large = filelist.files(spark, path).first()
    for k in range(6):
        filelist.append(spark.range(1000 * k, 1000 * (k + 1)).select("id", F.rand(k).alias("x")).coalesce(1), path)
    before, total = filelist.latest(spark, path), filelist.read(spark, path).agg(F.sum("x"), F.count("*")).first()
    opened = filelist.read(spark, path)  # a reader that goes on while files are merged
    assert filelist.compact(spark, path, target=large["length"]) == before + 1
    assert filelist.files(spark, path).count() == 2 and filelist.files(spark, path).filter(F.col("path") == large["path"]).count() == 1
    for df in (opened, filelist.read(spark, path), filelist.read(spark, path, before)):
        assert df.agg(F.round(F.sum("x"), 6), F.count("*")).first() == (round(total[0], 6), total[1])
    assert filelist.compact(spark, path, target=large["length"]) is None  # one small file is left, which is no pair


def test_compaction_packs_to_the_target(spark):
    path = scratch_path(spark, "t-files")
    for k in range(9):
        filelist.append(spark.range(1000 * k, 1000 * (k + 1)).select("id", F.rand(k).alias("x")).coalesce(1), path)
    sizes = [r["length"] for r in filelist.files(spark, path).collect()]
    filelist.compact(spark, path, target=int(3.5 * max(sizes)))
    assert filelist.files(spark, path).count() == 3
    assert filelist.read(spark, path).select("id").distinct().count() == 9000
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_a_compaction_that_is_lost_or_late(spark, monkeypatch):
    path = scratch_path(spark, "t-files")
    for k in range(4):
        filelist.append(spark.range(10 * k, 10 * (k + 1)).coalesce(1), path)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # the merged files are written, the list is not
        patch.setattr(filelist, "_publish", lost)
        with pytest.raises(RuntimeError):
            filelist.compact(spark, path)
    assert filelist.read(spark, path).count() == 40 and filelist.files(spark, path).count() == 4
    real = filelist._publish

    def beaten(spark, path, change):  # another writer appends, and another compaction comes first
        with monkeypatch.context() as patch:
            patch.setattr(filelist, "_publish", real)
            filelist.append(spark.range(40, 50).coalesce(1), path)
            filelist.compact(spark, path)
        return real(spark, path, change)

    with monkeypatch.context() as patch:
        patch.setattr(filelist, "_publish", beaten)
        assert filelist.compact(spark, path) is None
    rows = sorted(r["id"] for r in filelist.read(spark, path).collect())
    assert rows == list(range(50)) and filelist.files(spark, path).count() == 1


def test_read_latest_of_odd_folders(spark):
    path = scratch_path(spark, "t-batches")
    with pytest.raises(FileNotFoundError):
        L.read_latest(spark, path)
    spark.range(3).write.parquet(f"{path}/batch=2")
    spark.range(5).write.parquet(f"{path}/batch=old")
    assert L.read_latest(spark, path).count() == 3


def test_fallback_after_any_failure(spark):
    path = scratch_path(spark, "t-table")
    tables.write_table(spark.range(4), path)
    assert tables.read_table(spark, path, "orc", fallback="parquet").count() == 4
    with pytest.raises(Exception, match="(?i)delta"):
        tables.read_table(spark, scratch_path(spark, "t-none"), "delta", fallback="parquet")


# -- drift

def test_ledger(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": 1.5, "c": [1]}', '{"a": "oops", "b": null}', "[1]", "no json", None, "{}", '{"B": true, "d": {"e": 1}}']
    df = spark.createDataFrame([(t,) for t in texts], "json_payload string")
    got = {tuple(r) for r in drift.ledger(df, T.StructType.fromDDL("a double, b string")).collect()}
    assert got == {("a", "BIGINT", "known", 1), ("a", "DOUBLE", "known", 1), ("a", "STRING", "retyped", 1), ("b", "STRING", "known", 1), ("b", "VOID", "known", 1),
                   ("c", "ARRAY", "unknown", 1), ("B", "BOOLEAN", "unknown", 1), ("d", "OBJECT", "unknown", 1)}
    assert drift.drifted(drift.ledger(df, T.StructType.fromDDL("a double, b string"))).count() == 4
    whole = drift.merged_schema(df.filter("json_payload like '{%'")).first()["schema"]
    assert "c: ARRAY" in whole and "d: OBJECT" in whole


# -- folds

def test_folds_by_key(spark):
    """Rows of a key share a fold, on every layout; the search scores the same on each."""
    df = spark.range(900).select((F.col("id") % 150).alias("key"), (F.col("id") % 3).cast("string").alias("Attack_type"),
                                 (F.col("id") % 3 + F.rand(3)).alias("x"), (F.hash("id") % 17).cast("double").alias("y"))
    df = df.persist()
    scores = []
    for layout in (df, df.repartition(7), df.orderBy("y")):
        sets = M.training_set(layout, ["key"], features=["x", "y"], persist=False)
        rows = layout.select("key", models.fold_of(M.draw([F.col("key")], 44), 3).alias("fold")).groupBy("key").agg(F.count_distinct("fold").alias("n"))
        assert rows.filter("n > 1").count() == 0
        model = models.tune(sets.train, "decision_tree", grid={"maxDepth": [1, 2]}, folds=3)
        scores.append([round(m, 6) for m in model.avgMetrics])
    assert scores[0] == scores[1] == scores[2]


# -- profiles and sketches

def test_distinct_counts_do_not_widen_rows(spark, capsys):
    """Counts by column as the text has them, with nulls, and no plan that groups all columns once for each."""
    from flowlake.plans.profiling import exact_distinct
    df = spark.createDataFrame([(1, None, 0.0), (2, "", -0.0), (2, "a", None), (None, "b", float("nan"))], "i int, t string, x double")
    assert exact_distinct(df, ["i", "t", "x"]) == {"i": 3, "t": 3, "x": 4}
    assert exact_distinct(df.limit(0), ["i", "t"]) == {"i": 0, "t": 0}
    parts = df.withColumn("p", F.when(F.col("i") == 2, 1))
    cells = profiles._cells(parts, df.schema.fields, "p")
    assert {r["p"]: (r["_rows"], r["m1"], r["n0"]) for r in cells.collect()} == {None: (2, 1, 1), 1: (2, 1, 2)}
    cells.explain()
    mixed = [line for line in capsys.readouterr().out.splitlines() if "hllsketchagg" in line.lower() and ("min(" in line or "stddev" in line or "var_pop" in line)]
    assert not mixed


def test_profiles_grow_by_new_partitions(spark):
    rows = [(d, f"{d}", None if i % 4 == 0 else float(i * d), float("inf") if i == 7 else float("nan") if i == 9 else 1.0, "x" if i % 3 else "y")
            for d in range(1, 6) for i in range(30) for _ in range(1 + (i == 3))]
    df = spark.createDataFrame(rows, "day int, t string, v double, w double, kind string")
    source, profile = scratch_path(spark, "t-table"), scratch_path(spark, "t-profile")
    df.filter("day <= 3").write.partitionBy("day").parquet(source)
    assert sorted(profiles.update(spark, source, profile, "day", ["kind"])) == ["1", "2", "3"]
    df.filter("day > 3").write.mode("append").partitionBy("day").parquet(source)
    assert sorted(profiles.update(spark, source, profile, "day", ["kind"])) == ["4", "5"]
    assert profiles.update(spark, source, profile, "day", ["kind"]) == []
    plain = df.drop("day")
    fields = plain.schema.fields
    got = {(r["check"], r["item"], r["metric"]): r["value"] for r in profiles.report(spark, profile, fields, ["kind"], 4).collect()}
    want = {(r["check"], r["item"], r["metric"]): r["value"] for r in Q.report(plain, ["kind"], 4).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], nan_ok=True) for k in want)
    stats = {r["column_name"]: r for r in profiles.numeric_stats(spark, profile, fields).collect()}
    for r in Q.long_stats(plain, finite=True).collect():
        assert all(stats[r["column_name"]][c] == pytest.approx(r[c]) for c in ("n", "mean", "stddev", "min_value", "max_value"))
    distinct = {r["column_name"]: r["distinct_values"] for r in profiles.distinct_values(spark, profile, fields).collect()}
    assert distinct["t"] == 5 and distinct["kind"] == 2


def test_a_profile_opens_only_new_partitions(spark):
    source = scratch_path(spark, "t-table")
    spark.range(100).select((F.col("id") % 5).cast("int").alias("day"), F.col("id").cast("double").alias("v")).write.partitionBy("day").parquet(source)
    fresh = spark.read.parquet(source).filter(F.col("day").cast("int").isin([F.lit("3").cast("int")]))
    plan = monitor.plan_text(profiles._cells(fresh, [T.StructField("v", T.DoubleType())], "day"))
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan


def test_sketches_keep_their_bound(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("day"), F.exp(F.randn(5)).alias("x"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.rand(6)).alias("y"))
    df = df.persist()
    parts = sketches.per_part(df, ["x", "y"], "day")
    assert parts.count() == 8
    points = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    answers = sketches.quantiles(sketches.merged(parts), points)
    measured = sketches.rank_errors(df, answers).collect()
    assert len(measured) == 12 and all(r["rank_error"] <= sketches.rank_bound(sigmas=6) and r["n"] == 40_000 for r in measured)
    exact_box = exact_quantiles(df.select(F.lit("x").alias("feature"), F.col("x").alias("value")), ["feature"], "value", {"median": 0.5}).first()
    box = sketches.box(sketches.merged(parts)).filter("feature = 'x'").first()
    assert box["median"] == pytest.approx(exact_box["median"], rel=0.05)


def test_counts_from_footers(spark):
    path = scratch_path(spark, "t-table")
    spark.range(1000).repartition(3).write.parquet(path)
    assert monitor.footer_count(spark, path) == (1000, 1, True)
    assert spark.conf.get("spark.sql.sources.useV1SourceList").split(",").count("parquet") == 1


def test_no_task_writes_the_whole_of_an_uneven_table(spark):
    from flowlake.plans.cleaning import uneven_table
    rows = spark.range(0, 4000, 1, 4).select(F.col("id").alias("flow_key"), F.lit("Normal").alias("Attack_type"))
    path = scratch_path(spark, "uneven")
    large = uneven_table(rows, path)
    found = filelist.read(spark, path).groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).collect()
    assert len(found) == 4 * 13 and sum(r["n"] for r in found) == 4000 and found[0]["n"] <= 700
    version = filelist.compact(spark, path, target=large["length"])
    assert filelist.read(spark, path, version).count() == 4000 and filelist.files(spark, path).filter(F.col("path") == large["path"]).count() == 1


def test_the_dedup_reads_small_pieces(spark, monkeypatch):
    """Copies of a row are still folded, and the settings hold while the clean layer is written and no longer."""
    from flowlake.plans import medallion
    spark.range(0, 6000, 1, 12).selectExpr("id % 3000 as flow_key", "cast(id % 7 as string) as source_ip").write.parquet(path := scratch_path(spark, "raw"))
    seen, names, write = [], (medallion._SCAN, medallion._PARTS), medallion.write_table
    monkeypatch.setattr(medallion, "write_table", lambda *a: (seen.append([spark.conf.get(n) for n in names]), write(*a))[1])
    before = [spark.conf.get(n) for n in names]
    raw = spark.read.parquet(path)
    silver = medallion._write_clean(raw, scratch_path(spark, "silver"), "parquet", None, 1000)
    assert sorted(map(tuple, silver.collect())) == sorted({tuple(r) for r in raw.collect()})
    assert seen[0][0] == "1000" and int(seen[0][1]) >= 12 and [spark.conf.get(n) for n in names] == before
    assert [medallion._bytes(x) for x in ("128MB", "8388608b", "1g", "5")] == [128 << 20, 8 << 20, 1 << 30, 5]


def test_large_row_groups_are_read_by_several_tasks(spark, monkeypatch):
    """A row group is never split by the scan, so its rows are dealt over tasks before the dedup folds them."""
    from flowlake.plans import medallion
    null = F.lit(None).cast("double")
    spark.range(0, 9000, 1, 1).select((F.col("id") % 4000).alias("flow_key"), F.when(F.col("id") % 4 > 0, (F.col("id") % 4).cast("double")).otherwise(null).alias("tcp.len"),
                                      F.when(F.col("id") % 3 > 0, F.lit("x")).alias("source_ip")).write.parquet(path := scratch_path(spark, "raw"))
    raw, parts, clean = spark.read.parquet(path), [], medallion.clean
    monkeypatch.setattr(medallion, "clean", lambda df, **k: (parts.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), clean(df, **k))[1])
    silver = medallion._write_clean(raw, scratch_path(spark, "silver"), "parquet", None, 1000, 2000)
    assert sum(parts) == 9000 and len(parts) == 5 and max(parts) < 2500
    assert sorted(silver.collect()) == sorted(clean(raw).collect())
    unsure = raw.withColumn("r", F.rand())
    assert medallion._sliced(unsure, 5) is unsure and medallion._sliced(raw, 1) is raw
    empty = medallion._write_clean(raw.limit(0), scratch_path(spark, "silver"), "parquet", None)
    assert empty.count() == 0


def test_the_feature_layer_has_many_files(spark, monkeypatch):
    """Tasks that read it later are as many as its pieces, so it is made from small ones."""
    from flowlake.plans import medallion
    rows = spark.range(0, 3000).selectExpr("id as flow_key", *[f"cast(id % 9 as double) as {c}" for c in (
        "tcp_ack", "tcp_seq", "tcp_len", "tcp_flags", "tcp_checksum", "tcp_connection_syn", "tcp_connection_fin", "tcp_connection_rst")])
    monkeypatch.setattr(medallion, "_write_clean", lambda raw, path, fmt, keys: medallion.write_table(raw.repartition(24), path, fmt))
    monkeypatch.setattr(medallion, "FEATURE_SCAN_BYTES", 1000)
    gold = medallion.run_batch(rows, scratch_path(spark, "layers"))
    assert len(gold.inputFiles()) >= 24 and gold.count() == 3000 and sorted(r[0] for r in gold.select("flow_key").collect()) == list(range(3000))
