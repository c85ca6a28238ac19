"""Training runs as four long tables (runs, tags, metrics, params) and the views over them."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS = "run_uuid string, name string, status string, start_time long, end_time long, experiment_id long"
TAGS = "run_uuid string, key string, value string"
PARAMS = "run_uuid string, key string, value string"
METRICS = "run_uuid string, key string, value double, step long, logged_at long"
IMPORTANCE = "run_uuid string, model_key string, rank int, feature string, importance double"

# Tags shown per run, metrics compared, model keys and their display names.
TAG_KEYS = ["model_type", "mlflow.runName", "num_classes", "classification_type", "stage"]
METRIC_KEYS = ["accuracy", "f1_score", "precision", "recall", "auc_roc", "log_loss"]
MODEL_NAMES = {
    "logistic_regression": "Logistic Regression",
    "decision_tree": "Decision Tree",
    "random_forest": "Random Forest",
    "gbt": "Gradient Boosted Trees",
    "naive_bayes": "Naive Bayes",
}


def log_run(spark: SparkSession, root: str, name: str, model_type: str, params: dict, metrics: dict,
            tags: dict | None = None, importance: DataFrame | None = None, started_ms: int | None = None) -> str:
    """Append one finished run to the tables under ``root``; a metric may be a list (one value per step)."""
    run, now = uuid.uuid4().hex, int(time.time() * 1000)
    all_tags = {"model_type": model_type, "pipeline_stage": "training", **(tags or {})}
    steps = [
        (run, k, float(v), i, now)
        for k, series in metrics.items()
        for i, v in enumerate(series if isinstance(series, (list, tuple)) else [series])
    ]
    frames = {
        "tags": ([(run, k, str(v)) for k, v in all_tags.items()], TAGS),
        "params": ([(run, k, str(v)) for k, v in params.items()], PARAMS),
        "metrics": (steps, METRICS),
        # Last: a run is visible only when all it refers to is there.
        "runs": ([(run, name, "FINISHED", started_ms or now, now, 1)], RUNS),
    }
    if importance is not None:
        key = importance.sparkSession.range(1).select(normalize_model(F.lit(model_type))).first()[0]
        importance.select(
            F.lit(run).alias("run_uuid"), F.lit(key).alias("model_key"), "rank", "feature", "importance"
        ).coalesce(1).write.mode("append").parquet(f"{root}/importance")
    for table, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{table}")
    return run


def read_registry(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    shapes = {"runs": RUNS, "tags": TAGS, "params": PARAMS, "metrics": METRICS}
    return {name: spark.read.schema(shape).parquet(f"{root}/{name}") for name, shape in shapes.items()}


# What a model type or run name contains or begins with, per model key.
def normalize_model(text: Column) -> Column:
    """Model key from a free-form type or run name; null if it fits none."""
    v = F.regexp_replace(F.lower(text), "[ _-]", "")
    return (
        F.when(v.contains("logistic"), "logistic_regression")
        .when(v.contains("decisiontree") | v.startswith("dt"), "decision_tree")
        .when(v.contains("randomforest") | v.startswith("rf"), "random_forest")
        .when(v.contains("gradient") | v.contains("gbt"), "gbt")
        .when(v.contains("naive") | v.contains("bayes") | v.startswith("nb"), "naive_bayes")
    )


def runs_wide(runs: DataFrame, tags: DataFrame, metrics: DataFrame, tag_keys: list[str] | None = None,
              metric_keys: list[str] | None = None) -> DataFrame:
    """Finished runs with one column per tag and per metric (its last value by step, then by time).

    Without ``metric_keys`` every metric that was logged gets a column (the compared ones always do).
    All three inputs are keyed by ``run_uuid``: one shuffle each, and the joins reuse it.
    """
    tag_keys = tag_keys or TAG_KEYS
    if metric_keys is None:
        logged = [r["key"] for r in metrics.select("key").distinct().orderBy("key").collect()]  # names, not runs
        metric_keys = [*METRIC_KEYS, *[k for k in logged if k is not None and k not in METRIC_KEYS]]
    tag_cols = tags.filter(F.col("key").isin(tag_keys)).groupBy("run_uuid").agg(*[
        F.min(F.when(F.col("key") == k, F.col("value"))).alias(k.replace(".", "_")) for k in tag_keys
    ])
    latest = F.struct("step", "logged_at", "value")
    metric_cols = metrics.filter(F.col("key").isin(metric_keys)).groupBy("run_uuid").agg(*[
        F.max(F.when(F.col("key") == k, latest))["value"].alias(k) for k in metric_keys
    ])
    return (
        runs.filter("status = 'FINISHED'")
        .join(tag_cols, "run_uuid", "left").join(metric_cols, "run_uuid", "left")
        .withColumns({
            "start_dt": F.timestamp_millis("start_time"),
            "end_dt": F.timestamp_millis("end_time"),
            "duration_sec": F.round((F.col("end_time") - F.col("start_time")) / 1000, 1),
        })
    )


def best_runs(wide: DataFrame, models: dict[str, str] | None = None) -> DataFrame:
    """The best run per model (multi-class before others, then F1, then accuracy), a row for every model."""
    models = models or MODEL_NAMES
    multi = F.coalesce(F.lower("classification_type") == "multiclass", F.lit(False)).cast("int")
    key = F.coalesce(normalize_model(F.col("model_type")), normalize_model(F.col("name")))
    keyed = wide.withColumns({"model_key": key, "_multi": multi}).filter(F.col("model_key").isin(list(models)))
    # rank <= 1 lets each task discard all but its own best before the shuffle.
    order = Window.partitionBy("model_key").orderBy(
        F.desc("_multi"), F.desc_nulls_last("f1_score"), F.desc_nulls_last("accuracy"), F.col("run_uuid")
    )
    best = keyed.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").select(
        "model_key", F.col("run_uuid").alias("run_id"), *METRIC_KEYS, "duration_sec", "num_classes",
        "classification_type",
    )
    listed = wide.sparkSession.createDataFrame(list(models.items()), "model_key string, display string")
    # At most one row per listed model.
    return listed.join(F.broadcast(best), "model_key", "left").withColumn("has_run", F.col("run_id").isNotNull())


def best_runs_by(wide: DataFrame, ranking: list[Column], group: str = "model_type") -> DataFrame:
    """The best run per ``group`` by the first of ``ranking`` that a run has (e.g. AUC, else its CV value)."""
    score = F.coalesce(*ranking, F.lit(0.0))
    order = Window.partitionBy(group).orderBy(F.desc("score"), F.col("run_uuid"))
    return (
        wide.withColumns({group: F.coalesce(F.col(group), F.lit("?")), "score": score})
        .withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
        .select(group, F.col("run_uuid").alias("run_id"), "name", "score",
                F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"),
                F.coalesce("f1_score", F.lit(0.0)).alias("f1_score"))
    )


def run_metrics(metrics: DataFrame, run: str) -> DataFrame:
    """All metrics of one run, last value each."""
    latest = F.max(F.struct("step", "logged_at", "value"))["value"]
    return metrics.filter(F.col("run_uuid") == run).groupBy("key").agg(latest.alias("value"))


def importance_top(importance: DataFrame, model_key: str, n: int = 15) -> DataFrame:
    """The ``n`` most important features of a model."""
    return (
        importance.filter(F.col("model_key") == model_key)
        .orderBy(F.desc("importance"), "feature").limit(n)
    )
