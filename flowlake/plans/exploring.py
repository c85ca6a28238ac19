"""Queries over the exploratory aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake.operators import eda as E
from flowlake.operators import sketches as K
from flowlake.operators.features import FEATURE_NAMES
from flowlake.operators.quality import frequency
from flowlake.plans.catalog import query
from flowlake.plans.cleaning import stored_gold
from flowlake.plans.sql import FEATURES, draw, union, with_flows, with_gold
from flowlake.session import scratch_path
from flowlake.sources.adapters import CLASSES, flows, table

LOGGED = ["traffic_asymmetry_ratio", "pkt_size_cv", "flow_intensity"]
CORRELATED = [*FEATURES, "tcp_srcport", "tcp_seq", "tcp_ack", "tcp_flags", "tcp_len", "tcp_checksum"]
_HOUR = "cast(floor(try_cast(frame_time as double) / 3600) as bigint)"
_HOURLY = f"(select {_HOUR} as bucket, * from flows) where bucket is not null"


@query("eda_frequency", with_flows("""
select source_ip, count(*) as "count", round(count(*) * 100.0::double / (select count(*) from flows), 4) as percentage
from flows group by source_ip"""))
def eda_frequency(spark, sf):
    return frequency(flows(spark, sf), "source_ip", digits=4)


@query("eda_topk", with_flows("""
select Attack_type, count(*) as "count" from flows where Attack_type <> 'Normal'
group by Attack_type order by 2 desc, 1 limit 3"""))
def eda_topk(spark, sf):
    return E.top_k(flows(spark, sf), "Attack_type", 3, exclude="Normal")


@query("hourly_counts", with_flows(f"select bucket, count(*) as n from {_HOURLY} group by bucket"))
def hourly_counts(spark, sf):
    return E.bucket_counts(flows(spark, sf), E.hour_bucket(F.col("frame_time")))


@query("hourly_pivot", with_flows("select bucket, " + ", ".join(
    f'count(case when Attack_type = \'{c}\' then 1 end) as "{c}"' for c in CLASSES) + f" from {_HOURLY} group by bucket"))
def hourly_pivot(spark, sf):
    return E.bucket_pivot(flows(spark, sf), E.hour_bucket(F.col("frame_time")), F.col("Attack_type"), CLASSES)


@query("hourly_normal_vs_attack", with_flows(f"""
select bucket, count(case when Attack_type = 'Normal' then 1 end) as normal,
  count(case when Attack_type <> 'Normal' then 1 end) as attack from {_HOURLY} group by bucket"""))
def hourly_normal_vs_attack(spark, sf):
    return E.bucket_pivot(
        flows(spark, sf), E.hour_bucket(F.col("frame_time")), E.normal_or_attack(F.col("Attack_type")),
        ["normal", "attack"],
    )


@query("hourly_top5", with_flows(f"""
select Attack_type, bucket, count(*) as n from (select {_HOUR} as bucket, * from flows)
where bucket is not null and Attack_type in (
  select Attack_type from flows where Attack_type <> 'Normal' group by 1 order by count(*) desc, 1 limit 5)
group by Attack_type, bucket"""))
def hourly_top5(spark, sf):
    return E.bucket_top_classes(
        flows(spark, sf), E.hour_bucket(F.col("frame_time")), "Attack_type", 5, exclude="Normal"
    )


@query("ordinal_batches", with_flows("""
, numbered as (select Attack_type, row_number() over (order by flow_key, Attack_type) - 1 as i,
               greatest(count(*) over () // 200, 1) as size from flows)
select cast(i // size as bigint) as batch, Attack_type, count(*) as n from numbered group by 1, 2"""))
def ordinal_batches(spark, sf):
    return E.ordinal_batches(flows(spark, sf), "Attack_type", ["flow_key"])


def _histogram_sql(source: str, keys: str) -> str:
    group = f"{keys}, " if keys else ""
    return f"""
, cells as ({source}), r as (select {group}feature, min(value) as lo, max(value) as hi from cells group by all),
b as (select {group}feature, least(coalesce(cast(floor((value - lo) / nullif(hi - lo, 0) * 30) as bigint), 0), 29)::integer as bin, lo,
      (hi - lo) / 30 as w from cells join r using ({group}feature))
select {group}feature, bin, round(lo + w * bin, 6) as bin_start, count(*) as n from b group by {group}feature, bin, lo, w"""


@query("eda_histogram", with_gold(_histogram_sql(
    union(f"select '{c}' as feature, {c} as value from gold" for c in FEATURES), "")))
def eda_histogram(spark, sf):
    return E.histogram(stored_gold(spark, sf), FEATURE_NAMES, 30).withColumn("bin_start", F.round("bin_start", 6))


@query("eda_histogram_by_label", with_gold(_histogram_sql(
    union(f"select Attack_label, '{c}' as feature, {c} as value from gold" for c in FEATURES), "Attack_label")))
def eda_histogram_by_label(spark, sf):
    return E.histogram(stored_gold(spark, sf), FEATURE_NAMES, 30, by=["Attack_label"]).withColumn(
        "bin_start", F.round("bin_start", 6)
    )


@query("eda_correlation", with_gold(union(
    f"select '{a}' as feature_a, '{b}' as feature_b, "
    + ("1.0::double" if a == b else f"round(corr({a}, {b}), 4)") + " as r"
    + ("" if a == b else " from gold")
    for a in CORRELATED for b in CORRELATED)))
def eda_correlation(spark, sf):
    return E.correlation(stored_gold(spark, sf), CORRELATED, limit=1e15, digits=4)


@query("eda_mask", with_flows("""
select flow_key, case when not (isnan(tcp_ack) or isinf(tcp_ack) or abs(tcp_ack) > 50000) then tcp_ack end as tcp_ack
from flows"""))
def eda_mask(spark, sf):
    from flowlake.operators.clean import mask_outliers
    return mask_outliers(flows(spark, sf), ["tcp_ack"], 50000.0).select("flow_key", "tcp_ack")


def _cells(table_name: str) -> str:
    return union(f"select Attack_type, '{c}' as feature, {c} as value from {table_name}" for c in FEATURES)


_TRIMMED = """
bounds as (select feature, quantile_cont(value, 0.02) as lo, quantile_cont(value, 0.98) as hi from cells group by feature),
trimmed as (select c.* from cells c join bounds b using (feature) where value between lo and hi)"""


@query("eda_trim", with_gold(f"""
, cells as ({_cells('gold')}), {_TRIMMED}
select feature, Attack_type, count(*) as n, round(min(value), 6) as min_value, round(max(value), 6) as max_value,
  round(avg(value), 4) as mean from trimmed group by 1, 2"""))
def eda_trim(spark, sf):
    cells = E.trim(stored_gold(spark, sf), FEATURE_NAMES, keep=["Attack_type"])
    return cells.groupBy("feature", "Attack_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min("value"), 6).alias("min_value"),
        F.round(F.max("value"), 6).alias("max_value"), F.round(F.avg("value"), 4).alias("mean"),
    )


@query("eda_log1p", with_gold("""
select flow_key, round(ln(1 + greatest(traffic_asymmetry_ratio, 0.0)), 6) as logged from gold"""))
def eda_log1p(spark, sf):
    return stored_gold(spark, sf).select(
        "flow_key", F.round(E.log1p_clipped(F.col("traffic_asymmetry_ratio")), 6).alias("logged")
    )


@query("eda_min_class", with_flows("""
select source_ip, count(*) as n, round(sum(tcp_seq), 2) as total from flows where source_ip is not null
group by source_ip having count(*) >= 650"""))
def eda_min_class(spark, sf):
    kept = E.frequent_classes(flows(spark, sf).filter("source_ip is not null"), "source_ip", 650)
    return kept.groupBy("source_ip").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("tcp_seq"), 2).alias("total"))


@query("eda_box", with_gold(f"""
, kept as (select * from gold where Attack_type in (
    select Attack_type from gold group by 1 having count(*) >= 50)),
cells as ({_cells('kept')}), {_TRIMMED},
logged as (select Attack_type, feature, case when feature in ({', '.join(repr(c) for c in LOGGED)})
  then ln(1 + greatest(value, 0.0)) else value end as value from trimmed)
select feature, Attack_type, count(*) as n, round(quantile_cont(value, 0.25), 6) as q1,
  round(quantile_cont(value, 0.5), 6) as median, round(quantile_cont(value, 0.75), 6) as q3
from logged group by 1, 2"""))
def eda_box(spark, sf):
    df = E.box_statistics(stored_gold(spark, sf), "Attack_type", FEATURE_NAMES, LOGGED)
    return df.select("feature", "Attack_type", "n", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3"]])


@query("sample_n", """
select event_id, event_type, value from events
order by md5(concat_ws('|', cast(event_id as varchar), '42')), event_id limit 500""")
def sample_n(spark, sf):
    return E.sample_n(table(spark, sf, "events").select("event_id", "event_type", "value"), ["event_id"], 500)


@query("sample_fraction", f"""
select event_id, event_type, value from events where {draw('event_id', 42)} < {int(0.3 * (1 << 32))}""")
def sample_fraction(spark, sf):
    return E.sample_fraction(table(spark, sf, "events").select("event_id", "event_type", "value"), ["event_id"], 0.3)


_POINTS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("eda_sketch_quantiles", with_gold(union(
    f"select '{c}' as feature, {p}::double as point, count(case when not (isnan({c}) or isinf({c})) then 1 end) as n, true as within from gold"
    for c in FEATURES for p in _POINTS)))
def eda_sketch_quantiles(spark, sf):
    """Quantiles from stored sketches, one per year and feature, merged; ``within``: the rank measured is off by less than six
    standard deviations of the sketch's error."""
    gold = stored_gold(spark, sf)
    path = scratch_path(spark, "sketches")
    K.store(spark, K.per_part(gold.withColumn("year", F.year("event_time")), FEATURE_NAMES, "year"), path, "year")
    answers = K.quantiles(K.merged(spark.read.parquet(path)), _POINTS)
    measured = K.rank_errors(gold, answers)
    return measured.select("feature", "point", "n", (F.col("rank_error") <= K.rank_bound(sigmas=6)).alias("within"))
