"""Queries over tables, messages, cleaning steps and derived features."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.columns import feature_columns, label_column, sanitize_columns
from flowlake.functions.safe import quoted, scrub
from flowlake.operators import clean as C
from flowlake.operators.features import FEATURE_NAMES, add_features, feature_summary
from flowlake.plans.catalog import query
from flowlake.plans.medallion import run_batch
from flowlake.plans.sql import FEATURES, FORMULAS, NUMERIC, guard, union, with_clean, with_flows, with_gold, with_raw
from flowlake.session import scratch_path
from flowlake.sources import filelist, tables
from flowlake.sources.adapters import event_records, flows, raw_flows, table
from flowlake.sources.messages import enrich, envelope_schema, parse_payload, to_messages


def gold(spark, sf):
    return flows(spark, sf).transform(C.clean).transform(add_features)


_STORED: dict[tuple, str] = {}


def _version(spark, path: str) -> tuple:
    """Newest change, size and number of a table's files, so that a table that changes under its path is read again."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return tuple(files.agg(F.max("modificationTime").cast("string"), F.sum("length"), F.count(F.lit(1))).first())


def stored_gold(spark, sf):
    """The feature layer as a stored table, written by the batch pipeline on first use in a session.

    Exploration, training and audits read this table, column by column, instead of cleaning again.
    """
    key = (spark.sparkContext.applicationId, sf, _version(spark, f"{sf}/lineitem.parquet"))
    if key in _STORED:
        try:
            return spark.read.parquet(_STORED[key])
        except AnalysisException:  # the scratch area was cleared meanwhile
            del _STORED[key]
    root = scratch_path(spark, "medallion")
    stored = run_batch(flows(spark, sf), root)
    _STORED[key] = f"{root}/gold"
    return stored


def class_means(df):
    """Rows and mean of every derived feature per class."""
    return df.groupBy("Attack_type").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c), 4).alias(c) for c in FEATURE_NAMES]
    )


_MEANS = "select Attack_type, count(*) as n, " + ", ".join(
    f"round(avg({c}), 4) as {c}" for c in FEATURES) + " from gold group by Attack_type"


# --- sources and sinks

@query("scan_csv", with_flows("""
select Attack_type, count(*) as n, count(tcp_len) as n_len, count(source_ip) as n_source,
  round(sum(tcp_seq), 2) as sum_seq, sum(case when isinf(tcp_ack) then 1 else 0 end)::bigint as n_inf,
  sum(epoch_us(event_time) // 1000000)::bigint as sum_time
from flows group by Attack_type"""))
def scan_csv(spark, sf):
    df = flows(spark, sf)
    path = scratch_path(spark, "csv")
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path, df.schema)
    return back.groupBy("Attack_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("tcp_len").alias("n_len"), F.count("source_ip").alias("n_source"),
        F.round(F.sum("tcp_seq"), 2).alias("sum_seq"), F.count_if(C.is_infinite(F.col("tcp_ack"))).alias("n_inf"),
        F.sum(F.unix_seconds("event_time")).alias("sum_time"),
    )


@query("medallion_batch", with_gold(_MEANS))
def medallion_batch(spark, sf):
    return class_means(run_batch(flows(spark, sf), scratch_path(spark, "medallion")))


@query("compact_table", with_flows("""
select Attack_type, count(*) as n, round(sum(tcp_seq), 2) as sum_seq, 4 as files
from flows group by Attack_type"""))
def compact_table(spark, sf):
    compact = tables.compact_table(
        flows(spark, sf).select("Attack_type", "tcp_seq"), scratch_path(spark, "compact"), 4
    )
    files = compact.select(F.col("_metadata.file_path").alias("p")).groupBy("p").agg(F.lit(1).alias("one"))
    total = files.agg(F.count(F.lit(1)).cast("int")).scalar()
    return compact.groupBy("Attack_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("tcp_seq"), 2).alias("sum_seq")
    ).withColumn("files", total)


@query("scan_fallback", with_flows("select Attack_label, count(*) as n from flows group by Attack_label"))
def scan_fallback(spark, sf):
    """Parquet files that are said to be another format: once one that is not installed, once one that cannot read them."""
    path = scratch_path(spark, "mislabelled")
    tables.write_table(flows(spark, sf).select("Attack_label", "flow_key"), path)
    half = [tables.read_table(spark, path, fmt, fallback="parquet").filter(F.col("flow_key") % 2 == k) for k, fmt in enumerate(("delta", "orc"))]
    return half[0].unionByName(half[1]).groupBy("Attack_label").agg(F.count(F.lit(1)).alias("n"))


def uneven_table(rows, path: str):
    """Write ``rows`` under ``path`` as large and small files, by the tasks that read them; (path, length) of the largest."""
    spark = rows.sparkSession
    filelist.append(rows.filter("flow_key % 40 >= 12"), path)
    large = filelist.files(spark, path).orderBy(F.desc("length"), "path").first()
    for k in range(12):
        filelist.append(rows.filter(F.col("flow_key") % 40 == k), path)
    return large


@query("compact_small_files", with_flows("""
select Attack_type, count(*) as n, sum(flow_key)::bigint as sum_key, true as large_kept, true as fewer, true as old_version_reads
from flows group by Attack_type"""))
def compact_small_files(spark, sf):
    """A table of a large file and a dozen small ones per piece of the scan, after compaction; the largest stays and the version
    before can be read."""
    path = scratch_path(spark, "listed")
    large = uneven_table(flows(spark, sf).select("flow_key", "Attack_type", "tcp_ack", "frame_time"), path)
    before = filelist.latest(spark, path)
    after = filelist.compact(spark, path, target=large["length"])
    listed = filelist.files(spark, path)
    kept = listed.filter(F.col("path") == large["path"]).count() == 1
    fewer = listed.count() < filelist.files(spark, path, before).count()
    whole = filelist.read(spark, path, before).count() == filelist.read(spark, path, after).count()
    return filelist.read(spark, path).groupBy("Attack_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("flow_key").alias("sum_key"), F.lit(kept).alias("large_kept"), F.lit(fewer).alias("fewer"),
        F.lit(whole).alias("old_version_reads"))


@query("read_first", with_flows("select Attack_label, count(*) as n from flows group by Attack_label"))
def read_first(spark, sf):
    path = scratch_path(spark, "present")
    tables.write_table(flows(spark, sf).select("Attack_label"), path)
    df = tables.read_first(spark, [scratch_path(spark, "absent"), path])
    return df.groupBy("Attack_label").agg(F.count(F.lit(1)).alias("n"))


@query("bronze_partition_counts", """
select year(ts)::int as ingestion_year, month(ts)::int as ingestion_month, day(ts)::int as ingestion_day,
  count(*) as n from events where ts >= timestamp '2024-01-10' group by 1, 2, 3""")
def bronze_partition_counts(spark, sf):
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ingestion_time"), "event_id")
    stored = tables.write_table(
        tables.with_date_parts(events), scratch_path(spark, "dated"), partition_by=tables.DATE_PARTS
    )
    return tables.since(stored, dt.date(2024, 1, 10)).groupBy(*tables.DATE_PARTS).agg(F.count(F.lit(1)).alias("n"))


_WIRE_FIELDS = T.StructType([
    T.StructField("flow_key", T.LongType()), T.StructField("tcp.ack", T.DoubleType()),
    T.StructField("tcp.seq", T.DoubleType()), T.StructField("tcp.srcport", T.StringType()),
    T.StructField("Attack_type", T.StringType()),
])

def _readable():
    """The id without the digest of the row at its end."""
    return F.regexp_replace("flow_id", "-[0-9a-f]{32}$", "")


_ENRICHED = """
enriched as (
  select *, coalesce(source_ip, arp_src, '0.0.0.0') as src, dest_ip as dst,
    concat(coalesce(source_ip, arp_src, '0.0.0.0'), ':', coalesce(tcp_srcport, '0'), '-', dest_ip, ':',
           coalesce(tcp_dstport, '0'), '-', strftime(event_time, '%Y-%m-%d %H:%M:%S')) as fid
  from raw
)"""


@query("enrich_flows", with_raw("," + _ENRICHED + """
select flow_key, src as source_ip, dst as dest_ip, Attack_type, fid as flow_id from enriched"""))
def enrich_flows(spark, sf):
    return enrich(raw_flows(spark, sf), F.col("event_time")).select(
        "flow_key", "source_ip", "dest_ip", "Attack_type", _readable().alias("flow_id")
    )


@query("flow_ids", with_raw("""
select (select count(*) from raw) as messages, count(*) as ids from (select distinct * from raw)"""))
def flow_ids(spark, sf):
    """Only exact copies share an id."""
    return enrich(raw_flows(spark, sf), F.col("event_time")).agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("flow_id").alias("ids"))


@query("to_messages", with_raw("," + _ENRICHED + """
select src as "key", flow_key, tcp_ack, tcp_seq, tcp_srcport, Attack_type, fid as flow_id, src as source_ip
from enriched"""))
def messages(spark, sf):
    wire = to_messages(enrich(raw_flows(spark, sf), F.col("event_time")))
    schema = envelope_schema(_WIRE_FIELDS)
    back = parse_payload(wire, schema, "value").transform(sanitize_columns)
    return back.select("key", "flow_key", "tcp_ack", "tcp_seq", "tcp_srcport", "Attack_type", _readable().alias("flow_id"), "source_ip")


@query("guess_types", with_raw("""
select flow_key, case when frame_time = 'n/a' then null else cast(frame_time as bigint) end as seconds,
  frame_time = 'n/a' as seconds_quoted, source_ip, tcp_seq
from raw"""))
def guess_types(spark, sf):
    wire = to_messages(raw_flows(spark, sf).drop("event_time"), key="flow_key", guess=True)
    schema = T.StructType([
        T.StructField("frame.time", T.LongType()), T.StructField("ip.src_host", T.StringType()),
        T.StructField("tcp.seq", T.DoubleType()),
    ])
    quoted_time = F.col("value").contains('"frame.time":"')
    back = parse_payload(wire.withColumn("seconds_quoted", quoted_time), schema, "value").transform(sanitize_columns)
    return back.select(
        F.col("key").cast("long").alias("flow_key"), F.col("frame_time").alias("seconds"), "seconds_quoted",
        F.col("ip_src_host").alias("source_ip"), "tcp_seq",
    )


@query("envelope_schema", with_raw("," + _ENRICHED + "," + """
counted as (select count(*) as n, count(case when tcp_ack is not null then 1 end) as a from enriched)
""" + union([
    "select 'flow_key' as field, 'bigint' as kind, n as filled from counted",
    "select 'tcp.ack', 'double', a from counted",
    "select 'tcp.seq', 'double', n from counted",
    "select 'tcp.srcport', 'string', n from counted",
    "select 'Attack_type', 'string', n from counted",
    "select 'flow_id', 'string', n from counted",
    "select 'source_ip', 'string', n from counted",
    "select 'dest_ip', 'string', n from counted",
    "select 'timestamp', 'string', n from counted",
])))
def schema_with_envelope(spark, sf):
    schema = envelope_schema(_WIRE_FIELDS)
    rows = parse_payload(to_messages(enrich(raw_flows(spark, sf), F.col("event_time"))), schema, "value").drop("key")
    wide = rows.agg(*[F.count(quoted(f.name)).alias(f"c{i}") for i, f in enumerate(schema.fields)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("kind"),
                 F.col(f"c{i}").alias("filled"))
        for i, f in enumerate(schema.fields)
    ])))


# --- projections and cleaning

@query("json_extract", """
select event_id, event_type, cast(regexp_extract(props, '"k": ([0-9]+)', 1) as integer) as k from events""")
def json_extract(spark, sf):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return parse_payload(table(spark, sf, "events").select("event_id", "event_type", "props"), schema, "props").select(
        "event_id", "event_type", "k"
    )


@query("sanitize_columns", with_raw("""
select flow_key, tcp_seq, tcp_len, tcp_connection_syn, tcp_dstport, arp_opcode, source_ip as ip_src_host from raw"""))
def sanitize(spark, sf):
    return sanitize_columns(raw_flows(spark, sf)).select(
        "flow_key", "tcp_seq", "tcp_len", "tcp_connection_syn", "tcp_dstport", "arp_opcode", "ip_src_host"
    )


@query("drop_columns", with_raw("""
select flow_key, tcp_seq, tcp_dstport, 17 as width from raw"""))
def drop_columns(spark, sf):
    kept = C.drop_columns(raw_flows(spark, sf))
    return kept.select(
        "flow_key", quoted("tcp.seq").alias("tcp_seq"), quoted("tcp.dstport").alias("tcp_dstport"),
        F.lit(len(kept.columns)).alias("width"),
    )


@query("replace_infinity", with_flows("""
select flow_key, case when isinf(tcp_ack) then null else tcp_ack end as tcp_ack, tcp_len from flows"""))
def replace_infinity(spark, sf):
    return C.replace_infinity(flows(spark, sf)).select("flow_key", "tcp_ack", "tcp_len")


@query("fill_missing", with_flows("""
select flow_key, case when tcp_ack is null or isnan(tcp_ack) then 0.0 else tcp_ack end as tcp_ack,
  coalesce(tcp_len, 0.0) as tcp_len, coalesce(source_ip, 'unknown') as source_ip from flows"""))
def fill_missing(spark, sf):
    return C.fill_missing(flows(spark, sf)).select("flow_key", "tcp_ack", "tcp_len", "source_ip")


@query("cast_types", with_flows("""
select flow_key, try_cast(tcp_srcport as integer) as tcp_srcport, Attack_label from flows"""))
def cast_types(spark, sf):
    return C.cast_types(flows(spark, sf)).select("flow_key", "tcp_srcport", "Attack_label")


@query("dedup_rows", with_flows("""
select Attack_type, count(*) as n, count(tcp_len) as n_len, round(sum(tcp_seq), 2) as sum_seq
from (select distinct * from flows) group by Attack_type"""))
def dedup_rows(spark, sf):
    return C.dedup(flows(spark, sf)).groupBy("Attack_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("tcp_len").alias("n_len"), F.round(F.sum("tcp_seq"), 2).alias("sum_seq")
    )


@query("dedup_keys", "select event_type as attack_type, count(*) as n from events group by event_type")
def dedup_keys(spark, sf):
    feed = event_records(table(spark, sf, "events"))
    return C.dedup(feed, ["event_id"]).groupBy("attack_type").agg(F.count(F.lit(1)).alias("n"))


@query("clean_pipeline", with_clean("select * exclude (event_time) from clean"))
def clean_pipeline(spark, sf):
    return C.clean(flows(spark, sf)).drop("event_time")


@query("clean_log", with_clean(", n as (select (select count(*) from flows) as a, (select count(*) from clean) as d)" + union(
    [f"select {i} as step_no, '{s}' as step, a as rows_before, a as rows_after, {b} as columns_before, "
     f"{e} as columns_after from n" for i, (s, b, e) in enumerate(
         [("drop_columns", 20, 17), ("replace_infinity", 17, 17), ("cast_types", 17, 17), ("fill_missing", 17, 17)])]
    + ["select 4, 'dedup', a, d, 17, 17 from n"])))
def clean_log(spark, sf):
    return C.clean_log(raw_flows(spark, sf))


@query("numeric_scrub", with_flows(f"""
select flow_key, case when tcp_ack is null or isnan(tcp_ack) then 0.0 else tcp_ack end as tcp_ack,
  coalesce(tcp_len, 0.0) as tcp_len, coalesce(try_cast(frame_time as double), 0.0) as frame_time from flows"""))
def numeric_scrub(spark, sf):
    return C.numeric_scrub(flows(spark, sf), ["tcp_ack", "tcp_len", "frame_time"], keep=["flow_key"])


@query("feature_columns", with_gold(union(
    f"select '{c}' as column_name, count(*) as n, round(sum({c}), 2) as total from gold"
    for c in ["flow_key", *NUMERIC])))
def chosen_columns(spark, sf):
    df = stored_gold(spark, sf)
    names = feature_columns(df)
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.sum(scrub(quoted(c))), 2).alias(c) for c in names])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("n"), F.col(c).alias("total")) for c in names
    ])))


@query("filter_positive", with_flows("""
select flow_key, Attack_type, tcp_seq from flows where Attack_label = 1"""))
def filter_positive(spark, sf):
    df = flows(spark, sf)
    return df.filter("Attack_label = 1").select("flow_key", label_column(df), "tcp_seq")


# --- derived features

def _feature(key, name):
    @query(key, with_flows(f"select flow_key, {guard(FORMULAS[name])} as {name} from flows"))
    def run(spark, sf):
        return add_features(flows(spark, sf), [name]).select("flow_key", name)
    return run


for _key, _name in zip(["feat_asymmetry", "feat_pkt_size", "feat_intensity", "feat_regularity", "feat_conn_eff"],
                       FEATURE_NAMES):
    _feature(_key, _name)


@query("gold_features", with_gold(_MEANS))
def gold_features(spark, sf):
    return class_means(gold(spark, sf))


@query("feature_summary", with_gold(union(
    f"select '{c}' as column_name, count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as stddev, "
    f"round(min({c}), 4) as min_value, round(max({c}), 4) as max_value from gold" for c in FEATURES)))
def summary(spark, sf):
    df = feature_summary(gold(spark, sf))
    return df.select("column_name", "n", *[F.round(c, 4).alias(c) for c in df.columns[2:]])
