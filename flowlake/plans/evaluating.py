"""Queries over metrics of scored tables and over label audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake.operators import evaluate as V
from flowlake.plans.catalog import query
from flowlake.plans.cleaning import stored_gold
from flowlake.plans.sql import FEATURES, NUMERIC, union, with_flows, with_gold
from flowlake.sources.adapters import CLASSES, flows, predictions, table

_SCORED = """with scored as (
  select greatest(l_linenumber - 3, 0)::double as label,
    case when l_partkey % 10 < 7 then greatest(l_linenumber - 3, 0) else l_suppkey % 4 end::double as prediction
  from lineitem),
hits as (select label, prediction, count(*) as n from scored group by all),
classes as (select label from hits union select prediction from hits),
t as (select label, sum(n) as t, sum(case when label = prediction then n else 0 end) as h from hits group by 1),
p as (select prediction as label, sum(n) as p from hits group by 1),
m as (select label, coalesce(t, 0)::bigint as t, coalesce(p, 0)::bigint as p, coalesce(h, 0)::bigint as h
  from classes left join t using (label) left join p using (label)),
c as (select *, coalesce(h / nullif(p, 0)::double, 0.0) as pr, coalesce(h / nullif(t, 0)::double, 0.0) as re,
  coalesce(2 * h / nullif(t + p, 0)::double, 0.0) as f1 from m)
"""


@query("multiclass_metrics", _SCORED + """
select sum(t)::bigint as n, round(sum(h) / sum(t)::double, 6) as accuracy, round(sum(f1 * t) / sum(t)::double, 6) as f1_score,
  round(sum(pr * t) / sum(t)::double, 6) as precision, round(sum(re * t) / sum(t)::double, 6) as recall from c""")
def multiclass_metrics(spark, sf):
    result = V.multiclass_metrics(predictions(spark, sf))
    return result.select("n", *[F.round(c, 6).alias(c) for c in result.columns[1:]])


@query("per_class_metrics", _SCORED + """
select label, t as n_true, p as n_predicted, h as n_hit, round(pr, 6) as precision, round(re, 6) as recall,
  round(f1, 6) as f1_score from c
union all select 5.0, 0, 0, 0, 0.0, 0.0, 0.0""")
def per_class_metrics(spark, sf):
    result = V.per_class_metrics(predictions(spark, sf), num_classes=6)
    return result.select("label", "n_true", "n_predicted", "n_hit", *[
        F.round(c, 6).alias(c) for c in ["precision", "recall", "f1_score"]
    ])


@query("confusion_matrix", _SCORED + f"""
select label, case label {' '.join(f"when {i} then '{n}'" for i, n in enumerate(CLASSES))} end as label_name,
  {', '.join(f'coalesce(sum(case when prediction = {j} then n end), 0)::bigint as p{j}' for j in range(5))},
  coalesce(sum(case when prediction not in (0, 1, 2, 3, 4) then n end), 0)::bigint as p_other,
  sum(n)::bigint as row_total,
  round(coalesce(sum(case when prediction = label then n end), 0) / sum(n)::double, 6) as class_accuracy
from hits group by label""")
def confusion_matrix(spark, sf):
    return V.confusion_matrix(predictions(spark, sf), CLASSES).withColumn(
        "class_accuracy", F.round("class_accuracy", 6)
    )


_WILD = """with wild as (
  select case when l_partkey % 41 = 0 then 9 else greatest(l_linenumber - 3, 0) end::double as label,
    case when l_suppkey % 29 = 0 then 7 when l_suppkey % 31 = 0 then null else l_suppkey % 5 end::double as prediction from lineitem),
hits as (select case when label < 5 then label else -1 end::double as label, prediction, count(*) as n from wild group by all)
"""


@query("confusion_other", _WILD + f"""
select label, case label {' '.join(f"when {i} then '{n}'" for i, n in enumerate(CLASSES))} else 'other' end as label_name,
  {', '.join(f'coalesce(sum(case when prediction = {j} then n end), 0)::bigint as p{j}' for j in range(5))},
  coalesce(sum(case when prediction is null or prediction > 4 then n end), 0)::bigint as p_other, sum(n)::bigint as row_total,
  round(coalesce(sum(case when prediction = label then n end), 0) / sum(n)::double, 6) as class_accuracy
from hits group by label""")
def confusion_other(spark, sf):
    line = F.col("l_linenumber")
    wild = table(spark, sf, "lineitem").select(
        F.when(F.col("l_partkey") % 41 == 0, 9).otherwise(F.greatest(line - 3, F.lit(0))).cast("double").alias("label"),
        F.when(F.col("l_suppkey") % 29 == 0, 7).when(F.col("l_suppkey") % 31 == 0, None)
        .otherwise(F.col("l_suppkey") % 5).cast("double").alias("prediction"),
    )
    return V.confusion_matrix(wild, CLASSES).withColumn("class_accuracy", F.round("class_accuracy", 6))


@query("log_loss", _SCORED + """
select count(*) as n, round(avg(case when label = prediction then -ln(0.6::double) else -ln(0.1::double) end), 6) as log_loss
from scored""")
def log_loss(spark, sf):
    return V.log_loss(predictions(spark, sf)).withColumn("log_loss", F.round("log_loss", 6))


@query("confusion_binary", """
with c as (select count(case when quality = 1 and toxic = 1 then 1 end) as tp,
  count(case when quality = 0 and toxic = 0 then 1 end) as tn, count(case when quality = 0 and toxic = 1 then 1 end) as fp,
  count(case when quality = 1 and toxic = 0 then 1 end) as fn from labels)
select tp, tn, fp, fn, 0::bigint as other, round(tp / nullif(tp + fn, 0)::double, 6) as tpr, round(tn / nullif(tn + fp, 0)::double, 6) as tnr,
  round(fp / nullif(fp + tn, 0)::double, 6) as fpr, round(fn / nullif(fn + tp, 0)::double, 6) as fnr from c""")
def confusion_binary(spark, sf):
    scored = table(spark, sf, "labels").select(
        F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("prediction")
    )
    result = V.binary_confusion(scored)
    return result.select("tp", "tn", "fp", "fn", "other", *[F.round(c, 6).alias(c) for c in ["tpr", "tnr", "fpr", "fnr"]])


def _auc_cells(source: str, label: str, columns: dict[str, str]) -> str:
    return union(f"select {label} as y, '{c}' as feature, {x} as value from {source}" for c, x in columns.items())


# Mid-ranks: average position among equal values.
_AUC = """
ranked as (select feature, y, rank() over (partition by feature order by value)
    + (count(*) over (partition by feature, value) - 1) / 2.0::double as r from cells),
areas as (select feature, (sum(case when y = 1 then r end) - count(case when y = 1 then 1 end)::double
    * (count(case when y = 1 then 1 end) + 1) / 2) / (count(case when y = 1 then 1 end)::double * count(case when y = 0 then 1 end)) as a
  from ranked group by feature)"""

_LINES = {c: f"{c}::double" for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]}


@query("binary_auc", f"""
with cells as ({_auc_cells('lineitem', "case when l_returnflag = 'R' then 1 else 0 end", _LINES)}), {_AUC}
select feature, round(a, 6) as auc_roc from areas""")
def binary_auc(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("y", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return V.binary_auc(lines, "y", list(_LINES)).withColumn("auc_roc", F.round("auc_roc", 6))


_AUDITED = [c for c in NUMERIC if c not in FEATURES] + FEATURES


@query("leakage_audit", with_gold(f"""
, cells as ({_auc_cells('gold', 'Attack_label', {c: f'{c}::double' for c in _AUDITED})}), {_AUC},
v as (select feature, value, sum(y)::double as pos, sum(1 - y)::double as neg from cells group by 1, 2),
w as (select feature, value, sum(pos) over o as lp, sum(neg) over o as ln, sum(pos) over g as tp, sum(neg) over g as tn
  from v window o as (partition by feature order by value), g as (partition by feature)),
s as (select *, tp - lp as rp, tn - ln as rn from w),
gains as (select feature, value, (lp * lp + ln * ln) / (lp + ln) + coalesce((rp * rp + rn * rn) / nullif(rp + rn, 0), 0.0) as gain,
  0.5 + 0.5 * abs(lp / tp - ln / tn) as auc, (greatest(lp, ln) + greatest(rp, rn)) / (tp + tn) as acc from s),
best as (select *, row_number() over (partition by feature order by gain desc, value) as i from gains)
select feature, round(greatest(a, 1 - a), 6) as auc, round(auc, 6) as stump_auc, round(acc, 6) as stump_accuracy,
  case when greatest(a, 1 - a) > 0.99 then 'YES' when greatest(a, 1 - a) > 0.95 then 'HIGH' else '' end as flag
from areas join best using (feature) where i = 1"""))
def leakage_audit(spark, sf):
    result = V.leakage_audit(stored_gold(spark, sf), "Attack_label", _AUDITED)
    return result.select("feature", *[F.round(c, 6).alias(c) for c in ["auc", "stump_auc", "stump_accuracy"]], "flag")


@query("majority_baseline", with_flows("""
select Attack_type as majority_class, count(*) as majority_count, (select count(*) from flows) as total,
  round(count(*) / (select count(*) from flows)::double, 6) as baseline_accuracy
from flows group by 1 order by 2 desc, 1 desc limit 1"""))
def majority_baseline(spark, sf):
    return V.majority_baseline(flows(spark, sf), "Attack_type").withColumn(
        "baseline_accuracy", F.round("baseline_accuracy", 6)
    )


_NAMES = [
    "flow_key", "event_time", "frame_time", "tcp_ack", "tcp_seq", "tcp_len", "tcp_flags", "tcp_checksum",
    "tcp_connection_syn", "tcp_connection_fin", "tcp_connection_rst", "tcp_srcport", "source_ip", "dest_ip",
    "Attack_type", "Attack_label",
]


@query("suspicious_columns", with_flows(union(
    f"select '{c}' as column_name, count({c}) as filled, {str(c.startswith('Attack')).lower()} as suspicious from flows"
    for c in _NAMES)))
def suspicious_columns(spark, sf):
    df = flows(spark, sf)
    return V.suspicious_columns(df, df.columns)
