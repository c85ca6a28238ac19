"""Queries over the run log and over stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake.operators import explain as X
from flowlake.operators import monitor, registry as R
from flowlake.plans.catalog import query
from flowlake.plans.cleaning import stored_gold
from flowlake.plans.learning import _bayes, fitted
from flowlake.plans.sql import with_clean, with_gold
from flowlake.session import scratch_path
from flowlake.sources.adapters import flows, run_log, table
from flowlake.sources.tables import write_table

_KINDS = """case o_orderpriority when '1-URGENT' then 'LogisticRegression' when '2-HIGH' then 'Decision Tree'
  when '3-MEDIUM' then 'random_forest' when '4-NOT SPECIFIED' then 'GBT_OneVsRest' else 'Naive-Bayes' end"""

_METRIC_SQL = ", ".join(
    f"((o_orderkey * 31 + o_custkey * 17 + {i * 101} + 53) % 1000) / 1000.0::double as v_{m}"
    for i, m in enumerate(["accuracy", "f1_score", "precision", "recall", "log_loss", "auc_roc"]))

_LOG = f"""
base as (select *, {_KINDS} as kind, epoch_ms(o_orderdate) + o_orderkey as start_time,
  case when o_custkey % 3 = 0 then 'binary' else 'multiclass' end as task, {_METRIC_SQL} from orders),
wide as (select concat('r', o_orderkey) as run_uuid, concat(lower(kind), '_v', o_orderkey % 7) as name,
  case when o_orderkey % 11 <> 0 then kind end as model_type, task as classification_type,
  case when task = 'binary' then '2' else '5' end as num_classes,
  v_accuracy as accuracy, case when o_orderkey % 13 <> 0 then v_f1_score end as f1_score,
  v_precision as precision, v_recall as recall, case when task = 'binary' then v_auc_roc end as auc_roc,
  v_log_loss as log_loss, start_time, round(((o_custkey % 977) * 1037 + 250) / 1000.0::double, 1) as duration_sec
  from base where o_orderstatus = 'F')"""

_NORM = """case when v like '%logistic%' then 'logistic_regression'
  when v like '%decisiontree%' or v like 'dt%' then 'decision_tree'
  when v like '%randomforest%' or v like 'rf%' then 'random_forest'
  when v like '%gradient%' or v like '%gbt%' then 'gbt'
  when v like '%naive%' or v like '%bayes%' or v like 'nb%' then 'naive_bayes' end"""


def _norm(col: str) -> str:
    return "(select " + _NORM.replace("v like", f"regexp_replace(lower({col}), '[ _-]', '', 'g') like") + ")"


def _wide(spark, sf):
    log = run_log(spark, sf)
    return R.runs_wide(log["runs"], log["tags"], log["metrics"])


@query("runs_wide", f"""with {_LOG}
select run_uuid, name, model_type, classification_type, num_classes, accuracy, f1_score, precision, recall, auc_roc,
  log_loss, start_time, duration_sec from wide""")
def runs_wide(spark, sf):
    return _wide(spark, sf).select(
        "run_uuid", "name", "model_type", "classification_type", "num_classes", *R.METRIC_KEYS, "start_time", "duration_sec"
    )


@query("normalize_model", f"""with {_LOG}
select run_uuid, {_norm('coalesce(model_type, name)')} as model_key from wide""")
def normalize_model(spark, sf):
    return _wide(spark, sf).select(
        "run_uuid", R.normalize_model(F.coalesce("model_type", "name")).alias("model_key")
    )


@query("best_run", f"""with {_LOG},
keyed as (select *, coalesce({_norm('model_type')}, {_norm('name')}) as model_key from wide),
ranked as (select *, row_number() over (partition by model_key order by (classification_type = 'multiclass') desc,
  f1_score desc nulls last, accuracy desc nulls last, run_uuid) as i from keyed),
models(model_key, display) as (values {', '.join(f"('{k}', '{d}')" for k, d in R.MODEL_NAMES.items())})
select model_key, display, run_uuid as run_id, accuracy, f1_score, precision, recall, auc_roc, log_loss, duration_sec,
  num_classes, classification_type, run_uuid is not null as has_run
from models left join (select * from ranked where i = 1) using (model_key)""")
def best_run(spark, sf):
    return R.best_runs(_wide(spark, sf))


@query("best_run_auc", f"""with {_LOG},
ranked as (select *, coalesce(model_type, '?') as mt, coalesce(auc_roc, 0.0) as score,
  row_number() over (partition by coalesce(model_type, '?') order by coalesce(auc_roc, 0.0) desc, run_uuid) as i from wide)
select mt as model_type, run_uuid as run_id, name, score, accuracy, coalesce(f1_score, 0.0) as f1_score from ranked where i = 1""")
def best_run_auc(spark, sf):
    return R.best_runs_by(_wide(spark, sf), [F.col("auc_roc")])


@query("run_metrics", f"""with {_LOG}, one as (select max(run_uuid) as r from wide)
select "key", value from wide, one, lateral (values ('accuracy', accuracy), ('f1_score', f1_score), ('precision', precision),
  ('recall', recall), ('log_loss', log_loss), ('auc_roc', auc_roc)) m("key", value)
where run_uuid = r and value is not null""")
def run_metrics(spark, sf):
    log = run_log(spark, sf)
    newest = log["runs"].filter("status = 'FINISHED'").agg(F.max("run_uuid")).first()[0]
    return R.run_metrics(log["metrics"], newest)


@query("registry_roundtrip", with_gold("""
select 'FINISHED' as status, 'NaiveBayes' as model_type, count(*)::double as n_rows, 0.5::double as last_loss from gold"""))
def registry_roundtrip(spark, sf):
    root = scratch_path(spark, "registry")
    n = stored_gold(spark, sf).count()
    R.log_run(spark, root, "naive_bayes_v1", "NaiveBayes", {"smoothing": 1.0}, {"n_rows": n, "log_loss": [0.9, 0.5]})
    log = R.read_registry(spark, root)
    wide = R.runs_wide(log["runs"], log["tags"], log["metrics"], metric_keys=["n_rows", "log_loss"])
    return wide.select("status", "model_type", "n_rows", F.col("log_loss").alias("last_loss"))


@query("importance_topn", _bayes("""
select feature, round(var_pop(v), 6) as importance from theta group by feature order by var_pop(v) desc, feature limit 5"""))
def importance_topn(spark, sf):
    model, sets = fitted(spark, sf, "naive_bayes")
    root = scratch_path(spark, "registry")
    importance = X.bayes_importance(spark, model, sets.features, sets.labels)
    R.log_run(spark, root, "naive_bayes_v1", "NaiveBayes", {}, {}, importance=importance)
    stored = spark.read.schema(R.IMPORTANCE).parquet(f"{root}/importance")
    return R.importance_top(stored, "naive_bayes", 5).select("feature", F.round("importance", 6).alias("importance"))


@query("latest_rows", """
select event_id, user_id, event_type, value from events order by ts desc, event_id desc limit 20""")
def latest_rows(spark, sf):
    return monitor.latest_rows(table(spark, sf, "events"), "ts", 20, ["event_id"]).select(
        "event_id", "user_id", "event_type", "value"
    )


def _stored(spark, sf):
    gold = stored_gold(spark, sf).inputFiles()[0].rsplit("/", 2)[0]
    return {"Silver": f"{gold}/silver", "Gold": f"{gold}/gold", "Bronze": f"{gold}/bronze"}


@query("layer_rows", with_gold("""
select 'Silver' as layer, count(*) as "rows", 16 as "columns", true as "exists", true as has_size from gold
union all select 'Gold', count(*), 21, true, true from gold
union all select 'Bronze', null, null, false, false"""))
def layer_rows(spark, sf):
    stats = monitor.layer_stats(spark, _stored(spark, sf))
    return stats.select("layer", "rows", "columns", "exists", (F.col("size_mb") > 0).alias("has_size"))


@query("layer_stats")
def layer_stats(spark, sf):
    return monitor.layer_stats(spark, _stored(spark, sf))


@query("layer_counts", with_gold("""
select 'Silver' as layer, count(*) as "rows", 16 as "columns", true as "exists", true as from_footers from gold
union all select 'Gold', count(*), 21, true, true from gold
union all select 'Bronze', null, null, false, false"""))
def layer_counts(spark, sf):
    return monitor.layer_counts(spark, _stored(spark, sf))


_FIRST = ["source_ip", "dest_ip", "Attack_label", "flow_key", "event_time", "frame_time", "tcp_ack", "tcp_seq", "tcp_len", "tcp_flags",
          "tcp_checksum", "tcp_connection_syn", "tcp_connection_fin", "tcp_connection_rst", "tcp_srcport"]


@query("latest_wide", with_gold(f"""
select {", ".join(_FIRST)}, '{",".join(_FIRST)}' as column_order from gold order by event_time desc, flow_key desc limit 20"""))
def latest_wide(spark, sf):
    """The newest rows of a table of 21 columns: 15 of them, the telling ones first."""
    newest = monitor.latest_rows(stored_gold(spark, sf), "event_time", 20, ["flow_key"])
    return newest.withColumn("column_order", F.lit(",".join(newest.columns)))


@query("layer_freshness", with_clean("""
select 'Silver' as layer, count(*) > 0 as "exists", true as aged, true as active_if_fresh from clean
union all select 'Gold', true, true, true union all select 'Bronze', false, false, true"""))
def layer_freshness(spark, sf):
    fresh = monitor.layer_freshness(spark, _stored(spark, sf))
    by_age = F.coalesce(F.col("age_sec") < monitor.ACTIVE_SECONDS, F.lit(False))
    return fresh.select(
        "layer", "exists", F.coalesce(F.col("age_sec") >= 0, F.lit(False)).alias("aged"),
        (F.col("active") == by_age).alias("active_if_fresh"),
    )
