"""The five classifiers, their search grids, and cross-validated tuning on weighted F1."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.hashing import RESOLUTION
from flowlake.operators.mlprep import FOLD_DRAW, minmax_scaler, standard_scaler
from flowlake.session import keep

WEIGHT = "classWeight"
FOLD = "fold"

# Search grids and fold counts per model and mode.
GRIDS = {
    "logistic_regression": {
        "fast": ({"regParam": [0.01], "elasticNetParam": [0.0]}, 2),
        "quick": ({"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]}, 2),
        "full": ({"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]}, 3),
    },
    "decision_tree": {
        "fast": ({"maxDepth": [5, 10], "minInstancesPerNode": [1, 5], "impurity": ["gini"]}, 2),
        "quick": ({"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 5], "impurity": ["gini", "entropy"]}, 2),
        "full": ({"maxDepth": [5, 10, 15, 20], "minInstancesPerNode": [1, 5, 10], "impurity": ["gini", "entropy"]}, 3),
    },
    "random_forest": {
        "fast": ({"numTrees": [50, 100], "maxDepth": [10, 15], "minInstancesPerNode": [1]}, 2),
        "quick": ({"numTrees": [50, 100], "maxDepth": [10, 15], "minInstancesPerNode": [1, 5]}, 3),
        "full": ({"numTrees": [50, 100, 200], "maxDepth": [10, 15, 20], "minInstancesPerNode": [1, 5]}, 5),
    },
    "gbt": {
        "fast": ({"maxIter": [20], "maxDepth": [3, 5]}, 2),
        "quick": ({"maxIter": [20, 50], "maxDepth": [3, 5]}, 2),
        "full": ({"maxIter": [20, 50], "maxDepth": [3, 5, 7]}, 3),
    },
    "naive_bayes": {
        "fast": ({"smoothing": [0.5, 1.0], "modelType": ["multinomial"]}, 2),
        "quick": ({"smoothing": [0.5, 1.0, 2.0], "modelType": ["multinomial"]}, 3),
        "full": ({"smoothing": [0.5, 1.0, 2.0], "modelType": ["multinomial", "complement"]}, 5),
    },
}

MODELS = list(GRIDS)


def estimator(kind: str, weighted: bool = True, max_iter: int = 100, seed: int = 42) -> tuple[Pipeline, object]:
    """The pipeline of a model and the stage its grid refers to."""
    weight = {"weightCol": WEIGHT} if weighted else {}
    if kind == "logistic_regression":
        stage = LogisticRegression(featuresCol="scaled_features", family="multinomial", maxIter=max_iter,
                                   regParam=0.01, **weight)
        return Pipeline(stages=[standard_scaler(), stage]), stage
    if kind == "decision_tree":
        stage = DecisionTreeClassifier(maxDepth=10, seed=seed, **weight)
        return Pipeline(stages=[stage]), stage
    if kind == "random_forest":
        # Rows keep the node they are at, a number per tree; otherwise every pass sends all trees grown so far to every task.
        stage = RandomForestClassifier(numTrees=100, maxDepth=10, seed=seed, cacheNodeIds=True, **weight)
        return Pipeline(stages=[stage]), stage
    if kind == "gbt":
        stage = GBTClassifier(maxIter=30, maxDepth=5, stepSize=0.1, seed=seed, **weight)
        return Pipeline(stages=[OneVsRest(classifier=stage, parallelism=1, **weight)]), stage
    if kind == "naive_bayes":
        stage = NaiveBayes(featuresCol="scaled_features", modelType="multinomial", smoothing=1.0, **weight)
        return Pipeline(stages=[minmax_scaler(), stage]), stage
    raise ValueError(f"unknown model {kind!r}; one of {MODELS}")


def fold_of(drawn: Column, folds: int) -> Column:
    """Fold of a row from the draw of its key."""
    return F.floor(drawn * folds / RESOLUTION).cast("int")


def fits_abreast(data: DataFrame, most: int) -> int:
    """How many fits over ``data`` run beside each other: as many as it takes to fill the cores, but no more, since each holds its own
    copy of the rows. A table in many parts fills them with one fit."""
    parts = data.select("*").rdd.getNumPartitions()  # a plan of its own
    return max(1, min(most, -(-3 * data.sparkSession.sparkContext.defaultParallelism // max(1, parts))))


def tune(train: DataFrame, kind: str, mode: str = "quick", grid: dict[str, list] | None = None, folds: int | None = None,
         parallelism: int = 2, weighted: bool | None = None, max_iter: int = 100, seed: int = 42) -> CrossValidatorModel:
    """Grid search with k-fold cross-validation on weighted F1.

    ``grid`` and ``folds`` replace those of the mode. Naive Bayes is unweighted unless asked otherwise. Rows with a ``FOLD_DRAW`` (those
    of ``mlprep.training_set``) are dealt to folds by it, so that rows of one key share a fold and the folds do not depend on
    how the table is laid out; others are dealt at random. The folds are filters over one stored table (``train``, if it is), not
    copies of it, and at most ``parallelism`` candidates are fitted at a time.
    """
    if weighted is None:
        weighted = kind != "naive_bayes" and WEIGHT in train.columns
    pipeline, stage = estimator(kind, weighted, max_iter, seed)
    preset, preset_folds = GRIDS[kind][mode]
    builder = ParamGridBuilder()
    for name, values in (grid or preset).items():
        builder = builder.addGrid(stage.getParam(name), values)
    candidates, n_folds = builder.build(), folds or preset_folds
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    by_key = FOLD_DRAW in train.columns
    stored = by_key and (train.storageLevel.useMemory or train.storageLevel.useDisk)
    held = train.withColumn(FOLD, fold_of(F.col(FOLD_DRAW), n_folds) if by_key else F.floor(F.rand(seed) * n_folds).cast("int"))
    if not stored:
        held = keep(held)
    _all_folds_filled(held, n_folds)
    abreast = fits_abreast(held, parallelism)
    runs = min(abreast, len(candidates))
    scores = []
    with ThreadPoolExecutor(runs) as pool:
        for i in range(n_folds):
            part, rest = held.filter(F.col(FOLD) != i), held.filter(F.col(FOLD) == i)
            if kind == "gbt":  # read by every class, and copied by each candidate if it is not stored
                part = keep(part)
                pipeline.getStages()[-1].setParallelism(-(-abreast // runs))
            run = inheritable_thread_target(train.sparkSession)(
                lambda params, part=part, rest=rest: evaluator.evaluate(pipeline.fit(part, params).transform(rest)))
            scores.append(list(pool.map(run, candidates)))
            part.unpersist()
    means, spreads = np.mean(scores, axis=0).tolist(), np.std(scores, axis=0).tolist()
    if kind == "gbt":
        pipeline.getStages()[-1].setParallelism(abreast)
    best = pipeline.fit(train if stored else held, candidates[means.index(max(means))])
    if not stored:
        held.unpersist()
    model = CrossValidatorModel(best, means, stdMetrics=spreads)
    for param, value in ((model.estimator, pipeline), (model.estimatorParamMaps, candidates), (model.evaluator, evaluator), (model.numFolds, n_folds),
                         (model.seed, seed)):
        model.set(param, value)
    return model


def _all_folds_filled(held: DataFrame, n_folds: int) -> None:
    sizes = {r[FOLD]: r["count"] for r in held.groupBy(FOLD).count().collect()}  # one row per fold
    for i in range(n_folds):
        if sum(sizes.values()) == sizes.get(i, 0):
            raise ValueError(f"The training data at fold {i} is empty.")
        if not sizes.get(i):
            raise ValueError(f"The validation data at fold {i} is empty.")


def cv_results(train: DataFrame, model: CrossValidatorModel) -> DataFrame:
    """One row per parameter combination: ``candidate, params, avg_f1, is_best`` (the first maximum wins)."""
    scores = list(model.avgMetrics)
    best = scores.index(max(scores))
    rows = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(score), i == best)
        for i, (params, score) in enumerate(zip(model.getEstimatorParamMaps(), scores))
    ]
    return train.sparkSession.createDataFrame(rows, "candidate int, params string, avg_f1 double, is_best boolean")


def score(df: DataFrame, model, labels: list[str] | None = None) -> DataFrame:
    """Apply a fitted model (also to a stream); with ``labels`` the predicted class gets its name."""
    best = model.bestModel if isinstance(model, CrossValidatorModel) else model
    scored = best.transform(df).drop(FOLD_DRAW)
    if labels is None:
        return scored
    names = F.array(*[F.lit(x) for x in labels])
    return scored.withColumn("predicted_class", F.get(names, F.col("prediction").cast("int")))


def save_model(model, path: str) -> None:
    best = model.bestModel if isinstance(model, CrossValidatorModel) else model
    best.write().overwrite().save(path)
