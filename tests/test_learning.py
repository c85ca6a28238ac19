"""Training, explanations and the run log on a small separable table."""

import pytest
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowlake.operators import explain as X
from flowlake.operators import mlprep as M
from flowlake.operators import models
from flowlake.operators import registry as R
from flowlake.session import scratch_path

FEATURES = ["signal", "noise"]


@pytest.fixture(scope="module")
def sets(spark):
    df = spark.range(600).select(
        "id", F.when(F.col("id") % 2 == 0, "even").when(F.col("id") % 3 == 0, "three").otherwise("rest").alias("Attack_type"),
        (F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 3 == 0, 5).otherwise(9) + (F.col("id") % 5) / 10).alias("signal"),
        (F.col("id") * 7919 % 101).cast("double").alias("noise"),
    )
    return M.training_set(df, ["id"], features=FEATURES)


GRIDS = {
    "logistic_regression": {"regParam": [0.01, 5.0]},
    "decision_tree": {"maxDepth": [1, 3]},
    "random_forest": {"numTrees": [5], "maxDepth": [3]},
    "gbt": {"maxIter": [2], "maxDepth": [2]},
    "naive_bayes": {"smoothing": [1.0]},
}


@pytest.fixture(scope="module")
def fitted(sets):
    return {kind: models.tune(sets.train, kind, grid=GRIDS[kind], folds=2) for kind in models.MODELS}


def test_every_model_scores(spark, sets, fitted):
    for kind, model in fitted.items():
        scored = models.score(sets.test, model, sets.labels)
        right = scored.filter("label = prediction").count() / scored.count()
        assert right > (0.45 if kind == "naive_bayes" else 0.95), kind
        assert {r[0] for r in scored.select("predicted_class").distinct().collect()} <= set(sets.labels)


def test_both_sides_have_the_same_columns(spark, sets):
    assert sets.train.unionByName(sets.test).count() == 600
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(40)], "id long, Attack_label int, signal double")
    two = M.training_set(df, ["id"], multiclass=False, features=["signal"], persist=False)
    assert two.train.unionByName(two.test).count() == 40


def test_forest_rows_keep_their_nodes(sets):
    pipeline, stage = models.estimator("random_forest")
    assert stage.getCacheNodeIds()
    few = {stage.numTrees: 6, stage.maxDepth: 6}
    kept, sent = (pipeline.copy({**few, stage.cacheNodeIds: on}).fit(sets.train) for on in (True, False))
    assert kept.stages[-1].toDebugString.split("\n")[1:] == sent.stages[-1].toDebugString.split("\n")[1:]


def test_cv_table(sets, fitted):
    rows = models.cv_results(sets.train, fitted["decision_tree"]).collect()
    assert [r["is_best"] for r in sorted(rows, key=lambda r: r["candidate"])] == [False, True]


def test_importances(spark, sets, fitted):
    tree = X.tree_importance(spark, fitted["random_forest"], FEATURES).collect()
    assert sum(r["importance"] for r in tree) == pytest.approx(1.0)
    assert next(r["feature"] for r in tree if r["rank"] == 1) == "signal"
    assert X.ovr_importance(spark, fitted["gbt"], FEATURES).orderBy("rank").first()["feature"] == "signal"
    assert X.linear_importance(spark, fitted["logistic_regression"], FEATURES, sets.labels).orderBy("rank").first()["feature"] == "signal"
    assert X.linear_top_per_class(spark, fitted["logistic_regression"], FEATURES, sets.labels, 1).count() == 3
    priors = X.bayes_priors(spark, fitted["naive_bayes"], sets.labels).collect()
    assert sum(r["prior"] for r in priors) == pytest.approx(1.0)


def test_structures(spark, sets, fitted):
    tree = X.tree_structure(spark, fitted["decision_tree"]).first()
    assert tree["num_leaves"] == (tree["num_nodes"] + 1) // 2 and "If" in tree["preview"]
    assert X.forest_structure(spark, fitted["random_forest"]).first()["num_trees"] == 5
    ovr = X.forest_structure(spark, fitted["gbt"], sets.labels).collect()
    assert {r["model_name"] for r in ovr} == set(sets.labels) and all(r["num_trees"] == 2 for r in ovr)
    history = X.objective_history(spark, fitted["logistic_regression"]).orderBy("iteration").collect()
    assert history[0]["objective_delta"] == 0.0 and history[-1]["objective"] <= history[0]["objective"]


def test_save_and_load(spark, sets, fitted):
    from pyspark.ml import PipelineModel
    path = scratch_path(spark, "model")
    models.save_model(fitted["decision_tree"], path)
    again = PipelineModel.load(path).transform(sets.test)
    assert again.filter("label = prediction").count() > 0


def test_registry(spark):
    root = scratch_path(spark, "registry")
    R.log_run(spark, root, "rf_v1", "RandomForest", {"numTrees": 5}, {"f1_score": [0.2, 0.7], "accuracy": 0.5}, {"classification_type": "binary"})
    best = R.log_run(spark, root, "rf_v2", "RandomForest", {}, {"f1_score": 0.6, "accuracy": 0.9}, {"classification_type": "multiclass"})
    R.log_run(spark, root, "nb", "other", {}, {"auc_roc": 0.8})
    log = R.read_registry(spark, root)
    wide = R.runs_wide(log["runs"], log["tags"], log["metrics"])
    assert {r["name"]: r["f1_score"] for r in wide.collect()} == {"rf_v1": 0.7, "rf_v2": 0.6, "nb": None}
    top = {r["model_key"]: r for r in R.best_runs(wide).collect()}
    assert len(top) == 5 and top["random_forest"]["run_id"] == best  # multi-class goes before the better F1
    assert top["naive_bayes"]["has_run"] and not top["gbt"]["has_run"]
    assert {r["key"]: r["value"] for r in R.run_metrics(log["metrics"], best).collect()} == {"f1_score": 0.6, "accuracy": 0.9}
    by_auc = R.best_runs_by(wide, [F.col("auc_roc")]).filter("model_type = 'other'").first()
    assert by_auc["score"] == 0.8


@pytest.mark.parametrize("text,key", [
    ("Logistic Regression", "logistic_regression"), ("dt_v3", "decision_tree"), ("Random-Forest", "random_forest"),
    ("GBT_OneVsRest", "gbt"), ("gradient boosted", "gbt"), ("NB", "naive_bayes"), ("multiclass", None), (None, None),
])
def test_normalize(spark, text, key):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(R.normalize_model(F.col("t"))).first()[0] == key


def test_search_equals_spark_and_stores_no_folds(spark, sets, monkeypatch):
    """The scores and the model of Spark's own search, without a stored copy of any fold beside the training set."""
    held = []
    evaluate = models.MulticlassClassificationEvaluator.evaluate
    def noted(self, df, *more):
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return evaluate(self, df, *more)
    sets.train.count()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with monkeypatch.context() as m:
        m.setattr(models.MulticlassClassificationEvaluator, "evaluate", noted)
        ours = models.tune(sets.train, "decision_tree", grid=GRIDS["decision_tree"], folds=3, parallelism=1)
    assert set(held) == {before} and len(held) == 6
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    pipeline, stage = models.estimator("decision_tree")
    folded = sets.train.withColumn("fold", models.fold_of(F.col(M.FOLD_DRAW), 3))
    theirs = CrossValidator(estimator=pipeline, estimatorParamMaps=ParamGridBuilder().addGrid(stage.maxDepth, [1, 3]).build(), numFolds=3, foldCol="fold",
                            evaluator=models.MulticlassClassificationEvaluator(metricName="f1")).fit(folded)
    assert [round(x, 9) for x in ours.avgMetrics] == [round(x, 9) for x in theirs.avgMetrics]
    assert ours.bestModel.stages[-1].toDebugString.split("\n")[1:] == theirs.bestModel.stages[-1].toDebugString.split("\n")[1:]
    assert [{p.name: v for p, v in x.items()} for x in ours.getEstimatorParamMaps()] == [{"maxDepth": 1}, {"maxDepth": 3}]
    with pytest.raises(ValueError, match="training data at fold 0 is empty"):
        models.tune(sets.train.filter(F.col(M.FOLD_DRAW) < M.RESOLUTION // 2), "decision_tree", grid=GRIDS["decision_tree"], folds=2)


def test_fits_side_by_side_only_where_cores_are_idle(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [models.fits_abreast(spark.range(0, 10, 1, n), 4) for n in (1, cores, 2 * cores, 6 * cores)] == [min(4, 3 * cores), 3, 2, 1]


def test_kept_rows_are_small_batches_of_small_pieces(spark, monkeypatch):
    """A block comes from disk batch by batch, never as one array; keeping fills nothing yet, and the settings end with it."""
    from flowlake import session
    spark.range(0, 24_000, 1, 24).selectExpr("id", "id % 7 as v").write.parquet(path := scratch_path(spark, "to-keep"))
    names = [session.SCAN, "spark.sql.inMemoryColumnarStorage.batchSize", "spark.sql.adaptive.enabled"]
    before, stored = [spark.conf.get(n) for n in names], lambda: {x.id(): x for x in spark.sparkContext._jsc.getPersistentRDDs().values()}
    monkeypatch.setattr(session, "KEPT_SCAN_BYTES", 1000)
    monkeypatch.setattr(session, "KEPT_BATCH_ROWS", 100)
    old = set(stored())
    kept = session.keep(spark.read.parquet(path).filter("v < 6"))
    (new,) = set(stored()) - old
    assert new not in {x.id() for x in spark.sparkContext._jsc.sc().getRDDStorageInfo()} and [spark.conf.get(n) for n in names] == before
    assert kept.count() == spark.range(24_000).filter("id % 7 < 6").count()
    blocks = stored()[new]
    assert blocks.getStorageLevel().deserialized() and blocks.getStorageLevel().useDisk()
    assert blocks.getNumPartitions() >= 24 and blocks.count() >= 24 * 9  # 857 rows a file
    kept.unpersist()
    sets = M.training_set(spark.range(40).selectExpr("id", "cast(id % 2 as string) as Attack_type", "cast(id as double) as x"), ["id"], features=["x"])
    assert all(side.storageLevel == StorageLevel.MEMORY_AND_DISK_DESER for side in (sets.train, sets.test))
    sets.release()
