"""From a feature table to a logged, reported run: split, tune, evaluate, explain, log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flowlake.operators import evaluate as V
from flowlake.operators import explain as X
from flowlake.operators import mlprep as M
from flowlake.operators import models, registry
from flowlake.session import keep
from flowlake.sources.tables import write_csv


@dataclass
class Run:
    run_id: str
    model: object
    sets: M.TrainingSet
    metrics: dict[str, float]


def importance_of(spark: SparkSession, kind: str, model, sets: M.TrainingSet) -> DataFrame:
    if kind == "logistic_regression":
        return X.linear_importance(spark, model, sets.features, sets.labels)
    if kind == "gbt":
        return X.ovr_importance(spark, model, sets.features)
    if kind == "naive_bayes":
        return X.bayes_importance(spark, model, sets.features, sets.labels)
    return X.tree_importance(spark, model, sets.features)


def train_and_log(spark: SparkSession, df: DataFrame, keys: list[str], kind: str, root: str, name: str, features: list[str] | None = None,
                  mode: str = "quick", reports: str | None = None, seed: int = 42, **options) -> Run:
    """Tune ``kind`` on the training side of ``df``, measure it on the test side, and append the run to the tables under
    ``root``. With ``reports`` the importances, the search and the named confusion are also written there as CSV.
    """
    sets = M.training_set(df, keys, features=features, seed=seed)
    model = models.tune(sets.train, kind, mode=mode, seed=seed, **options)
    sets.release()  # its rows make room for the scored ones
    scored = models.score(sets.test, model)
    scored = keep(scored.select(*[c for c in ("label", "prediction", "probability") if c in scored.columns]))
    row = V.multiclass_metrics(scored).first()
    metrics = {k: row[k] for k in ("accuracy", "f1_score", "precision", "recall")}
    loss = V.log_loss(scored).first()["log_loss"]
    if loss is not None:
        metrics["log_loss"] = loss
    importance = importance_of(spark, kind, model, sets)
    run = registry.log_run(
        spark, root, name, kind, {p.name: v for p, v in model.getEstimatorParamMaps()[_best(model)].items()}, metrics,
        {"classification_type": "multiclass", "num_classes": len(sets.labels)}, importance)
    if reports:
        write_csv(importance, f"{reports}/importance")
        write_csv(models.cv_results(sets.train, model), f"{reports}/search")
        write_csv(V.confusion_matrix(scored, sets.labels), f"{reports}/confusion")
    scored.unpersist()
    return Run(run, model, sets, metrics)


def _best(model) -> int:
    return model.avgMetrics.index(max(model.avgMetrics))
