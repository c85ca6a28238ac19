"""Queries over the data-quality profiles; the flow records are profiled before cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake.operators import profiles as P
from flowlake.operators import quality as Q
from flowlake.operators.features import FEATURE_NAMES
from flowlake.plans.catalog import query
from flowlake.plans.cleaning import stored_gold
from flowlake.plans.sql import union, with_flows, with_gold
from flowlake.session import scratch_path
from flowlake.sources.adapters import flows

FLOAT_COLUMNS = ["tcp_ack", "tcp_seq", "tcp_len", "tcp_flags", "tcp_checksum", "tcp_connection_syn",
                 "tcp_connection_fin", "tcp_connection_rst"]
TEXT_COLUMNS = ["frame_time", "tcp_srcport", "source_ip", "dest_ip", "Attack_type"]
ALL_COLUMNS = ["flow_key", "event_time", "frame_time", *FLOAT_COLUMNS, "tcp_srcport", "source_ip", "dest_ip",
               "Attack_type", "Attack_label"]


def _gap(c: str) -> str:
    if c in FLOAT_COLUMNS:
        return f"{c} is null or isnan({c})"
    if c in TEXT_COLUMNS:
        return f"{c} is null or {c} = '' or lower(trim({c})) = 'nan'"
    return f"{c} is null"


def _pct(part: str, whole: str, digits: int = 4) -> str:
    return f"coalesce(round(({part}) * 100.0::double / nullif({whole}, 0), {digits}), 0.0)"


def _count_if(cond: str) -> str:
    return f"count(case when {cond} then 1 end)"


def _finite(c: str) -> str:
    return f"case when not (isnan({c}::double) or isinf({c}::double)) then {c}::double end"


_MISSING = union(
    f"select '{c}' as column_name, {_count_if(_gap(c))} as missing_count, {_pct(_count_if(_gap(c)), 'count(*)')} as missing_pct"
    f" from flows" for c in ALL_COLUMNS)


@query("dq_basic", with_flows(union([
    "select 'total_rows' as metric, count(*) as value from flows", "select 'total_columns', 16",
    "select 'dtype:bigint', 1", "select 'dtype:double', 8", "select 'dtype:int', 1", "select 'dtype:string', 5",
    "select 'dtype:timestamp', 1"])))
def dq_basic(spark, sf):
    return Q.basic_stats(flows(spark, sf))


@query("dq_missing", with_flows(_MISSING))
def dq_missing(spark, sf):
    return Q.missing_values(flows(spark, sf), digits=4)


@query("eda_missing_top", with_flows(
    f"select * from ({_MISSING}) where missing_count > 0 order by missing_count desc, column_name limit 20"))
def eda_missing_top(spark, sf):
    return Q.missing_top(flows(spark, sf), digits=4)


@query("dq_completeness", with_flows(union(
    f"select '{c}' as column_name, {_pct(f'count({c})', 'count(*)')} as completeness_pct from flows"
    for c in ALL_COLUMNS)))
def dq_completeness(spark, sf):
    return Q.completeness(flows(spark, sf))


_DUP = """(select count(*) as total_rows, (select count(*) from (select distinct * from flows)) as distinct_rows
  from flows)"""


@query("dq_duplicates", with_flows(f"""
select total_rows, distinct_rows, total_rows - distinct_rows as duplicate_rows,
  {_pct('total_rows - distinct_rows', 'total_rows')} as duplicate_pct from {_DUP}"""))
def dq_duplicates(spark, sf):
    return Q.duplicates(flows(spark, sf), digits=4)


_CLASSES = union(
    f"""select '{c}' as column_name, {c}::varchar as class_value, count(*) as "count",
    {_pct('count(*)', '(select count(*) from flows)')} as percentage from flows group by {c}"""
    for c in ["Attack_label", "Attack_type"])


@query("dq_class_dist", with_flows(_CLASSES))
def dq_class_dist(spark, sf):
    return Q.class_distribution(flows(spark, sf), ["Attack_label", "Attack_type"], digits=4)


_NUMBERS = ["flow_key", *FLOAT_COLUMNS, "Attack_label"]


@query("dq_numeric_stats", with_flows(union(
    f"select '{c}' as column_name, count(v) as n, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as stddev, "
    f"round(min(v), 4) as min_value, round(max(v), 4) as max_value from (select {_finite(c)} as v from flows)"
    for c in _NUMBERS)))
def dq_numeric_stats(spark, sf):
    df = Q.long_stats(flows(spark, sf), finite=True)
    return df.select("column_name", "n", *[F.round(c, 4).alias(c) for c in df.columns[2:]])


@query("dq_infinity", with_flows("select * from (" + union(
    f"select '{c}' as column_name, {_count_if(f'isinf({c})')} as infinity_count from flows" for c in FLOAT_COLUMNS)
    + ") where infinity_count > 0"))
def dq_infinity(spark, sf):
    return Q.infinities(flows(spark, sf))


_REPORT = with_flows("select \"check\", item, metric, round(value, 4) as value from (" + union(
    ["select 'basic' as \"check\", 'table' as item, 'total_rows' as metric, count(*)::double as value from flows",
     "select 'basic', 'table', 'total_columns', 16"]
    + [f"select 'missing', column_name, 'missing_count', missing_count from ({_MISSING})",
       f"select 'missing', column_name, 'missing_pct', missing_pct from ({_MISSING})"]
    + [f"select 'infinity', '{c}', 'infinity_count', {_count_if(f'isinf({c})')} from flows" for c in FLOAT_COLUMNS]
    + [f"select 'numeric', '{c}', '{m}', {f}({_finite(c)}) from flows"
       for c in _NUMBERS for m, f in [("mean", "avg"), ("min_value", "min"), ("max_value", "max")]]
    + [f"select 'duplicates', 'table', '{m}', {x} from {_DUP}" for m, x in [
        ("total_rows", "total_rows"), ("distinct_rows", "distinct_rows"),
        ("duplicate_rows", "total_rows - distinct_rows"),
        ("duplicate_pct", _pct("total_rows - distinct_rows", "total_rows"))]]
    + [f"select 'classes', concat(column_name, '=', class_value), '{m}', \"{m}\" from ({_CLASSES})"
       for m in ["count", "percentage"]]) + ")")


@query("dq_report", _REPORT)
def dq_report(spark, sf):
    df = Q.report(flows(spark, sf), ["Attack_label", "Attack_type"], digits=4)
    return df.withColumn("value", F.round("value", 4))


@query("dq_gate", with_gold(union(
    f"select '{c}' as column_name, true as present, {_count_if(f'{c} is null')} as null_count, "
    f"{_count_if(f'{c} is null')} = 0 as passed from gold" for c in FEATURE_NAMES)
    + "\nunion all select 'absent_column', false, null, false"))
def dq_gate(spark, sf):
    return Q.gate(stored_gold(spark, sf), [*FEATURE_NAMES, "absent_column"])


_GAPS = " + ".join(
    f"(case when {c} is null or isnan({c}) then 1 else 0 end)" if c in FLOAT_COLUMNS
    else f"(case when {c} is null then 1 else 0 end)" for c in ALL_COLUMNS)


@query("eda_kpi", with_flows(f"""
select count(*) as total_rows, 16::bigint as total_columns, count(distinct Attack_type) as classes,
  sum({_GAPS})::bigint as missing_cells, {_pct(f'sum({_GAPS})', 'count(*) * 16')} as missing_pct from flows"""))
def eda_kpi(spark, sf):
    return Q.table_kpi(flows(spark, sf), "Attack_type")


def _profiled(spark, sf):
    """Profiles by year of a table that grew after its first profile; the second update reads the years that came."""
    source, profile = scratch_path(spark, "by-year"), scratch_path(spark, "profile")
    rows = flows(spark, sf).withColumn("ingest_year", F.year("event_time"))
    for part in ("ingest_year < 1996", "ingest_year >= 1996 or ingest_year is null"):
        rows.filter(part).write.mode("append").partitionBy("ingest_year").parquet(source)
        P.update(spark, source, profile, "ingest_year", ["Attack_label", "Attack_type"])
    return profile, rows.drop("ingest_year").schema.fields


@query("dq_report_merged", _REPORT)
def dq_report_merged(spark, sf):
    profile, fields = _profiled(spark, sf)
    return P.report(spark, profile, fields, ["Attack_label", "Attack_type"], digits=4).withColumn("value", F.round("value", 4))


@query("dq_stats_merged", with_flows(union(
    f"select '{c}' as column_name, count(v) as n, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as stddev, "
    f"round(min(v), 4) as min_value, round(max(v), 4) as max_value from (select {_finite(c)} as v from flows)"
    for c in _NUMBERS)))
def dq_stats_merged(spark, sf):
    profile, fields = _profiled(spark, sf)
    df = P.numeric_stats(spark, profile, fields)
    return df.select("column_name", "n", *[F.round(c, 4).alias(c) for c in df.columns[2:]])


def exact_distinct(df, columns):
    """Distinct values by column (as text, null as the empty one). Cells are unpivoted first: distinct counts beside each other in one
    aggregate would group by as many columns as there are, once for each."""
    cells = [F.struct(F.lit(i).alias("place"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for i, c in enumerate(columns)]
    counts = df.select(F.inline(F.array(*cells))).distinct().groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    found = {r["place"]: r["n"] for r in counts.collect()}  # one row per column
    return {c: found.get(i, 0) for i, c in enumerate(columns)}


@query("dq_distinct_merged", with_flows(union(
    f"select '{c}' as column_name, true as within from flows having count(*) > 0" for c in ALL_COLUMNS)))
def dq_distinct_merged(spark, sf):
    """Distinct counts from merged sketches, held against exact ones: all within 5 %, five standard errors."""
    profile, fields = _profiled(spark, sf)
    df = flows(spark, sf)
    exact = exact_distinct(df, [f.name for f in fields])
    true = F.create_map(*[F.lit(x) for c, n in exact.items() for x in (c, n)])
    near = F.abs(F.col("distinct_values") / true[F.col("column_name")] - 1) <= 0.05
    return P.distinct_values(spark, profile, fields).select("column_name", near.alias("within"))
