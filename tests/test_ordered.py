"""Global order, quantiles, splits and audits against plain Python, with one hot group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.functions.ordered import exact_quantiles, running_totals, with_ordinal
from flowlake.operators import eda as E
from flowlake.operators import evaluate as V
from flowlake.operators import mlprep as M
from flowlake.streaming import live as L


@pytest.fixture(scope="module")
def skewed(spark):
    """2 000 rows; a third of them share one value and one key."""
    rng = random.Random(1)
    rows = [
        (i, "a" if i % 3 else "b", 5.0 if i % 3 == 0 else round(rng.uniform(0, 10), 2), 77 if i % 3 == 0 else i, i % 2)
        for i in range(2000)
    ]
    return spark.createDataFrame(rows, "i long, g string, v double, k long, y int").cache(), rows


def test_with_ordinal(skewed):
    df, rows = skewed
    order = sorted(range(2000), key=lambda i: (rows[i][2], i))
    got = {r["i"]: r["ordinal"] for r in with_ordinal(df, ["v", "i"]).collect()}
    assert all(got[i] == n for n, i in enumerate(order))


def test_running_totals(skewed):
    df, rows = skewed
    got = running_totals(df.withColumn("one", F.lit(1)), ["g"], ["v", "i"], ["one", "y"]).collect()
    for g in "ab":
        before = 0
        part = sorted((r for r in got if r["g"] == g), key=lambda r: (r["v"], r["i"]))
        for n, r in enumerate(part):
            assert (r["one_before"], r["y_before"], r["one_total"]) == (n, before, len(part))
            before += r["y"]


def test_exact_quantiles(skewed):
    df, rows = skewed
    points = {"lo": 0.02, "mid": 0.5, "hi": 0.98}
    for r in exact_quantiles(df, ["g"], "v", points).collect():
        want = np.quantile([x[2] for x in rows if x[1] == r["g"]], list(points.values()))
        assert [r["lo"], r["mid"], r["hi"]] == pytest.approx(list(want))
        assert r["n"] == sum(x[1] == r["g"] for x in rows)


def test_quantile_of_single_value(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", float("nan")), ("c", None)], "g string, v double")
    assert [tuple(r) for r in exact_quantiles(df, ["g"], "v", {"q": 0.25}).collect()] == [("a", 1, 3.0)]


def test_null_groups_stay(spark):
    df = spark.createDataFrame([(None, float(i), i) for i in range(10)] + [("a", 1.0, 99)], "g string, v double, i int")
    got = {r["g"]: r["q"] for r in exact_quantiles(df, ["g"], "v", {"q": 0.5}).collect()}
    assert got == {None: 4.5, "a": 1.0}
    train, test = M.split_exact(df, ["i"], "g", 0.8, cells=4)
    assert (train.count(), test.count()) == (8, 3)
    assert E.histogram(df, ["v"], 2, by=["g"]).agg(F.sum("n")).first()[0] == 11


def test_ordinal_batches(skewed):
    df, rows = skewed
    got = E.ordinal_batches(df, "g", ["i"], batches=7).collect()
    size = 2000 // 7
    want = {}
    for i, g, *_ in rows:
        want[(i // size, g)] = want.get((i // size, g), 0) + 1
    assert {(r["batch"], r["g"]): r["n"] for r in got} == want


def test_ordinal_batches_break_ties_by_class(skewed):
    """A third of the rows share one key and lie in both classes; the layout must not matter."""
    df, rows = skewed
    mixed = df.withColumn("g", F.when(F.col("i") % 2 == 0, "b").otherwise("a"))
    order = sorted((r[3], "b" if r[0] % 2 == 0 else "a") for r in rows)
    want = {}
    for n, (_, g) in enumerate(order):
        want[n // (2000 // 7), g] = want.get((n // (2000 // 7), g), 0) + 1
    for layout in (mixed, mixed.repartition(7), mixed.repartition(3, "g")):
        got = {(r["batch"], r["g"]): r["n"] for r in E.ordinal_batches(layout, "g", ["k"], batches=7).collect()}
        assert got == want


def test_split_exact_with_hot_key(skewed):
    df, rows = skewed
    train, test = M.split_exact(df, ["k"], "g", 0.8, cells=16)
    ids = sorted(r["i"] for r in train.union(test).collect())
    assert ids == list(range(2000))
    assert M.overlap(train, test, ["k", "g"]).count() == 0  # copies of the hot key stay together in their class
    for g in "ab":
        n, hot = sum(x[1] == g for x in rows), sum(x[1] == g and x[3] == 77 for x in rows)
        assert int(0.8 * n) - max(hot, 1) <= train.filter(F.col("g") == g).count() <= int(0.8 * n)


def test_split_is_layout_free(skewed):
    df, _ = skewed
    train, test = M.split(df, ["k"])
    again, _ = M.split(df.repartition(1), ["k"])
    assert sorted(r["i"] for r in train.collect()) == sorted(r["i"] for r in again.collect())
    assert M.overlap(train, test, ["k"]).count() == 0
    assert M.complement(df, train, ["k"]).count() == test.count()


def test_weights_sum_to_rows(skewed):
    df, _ = skewed
    weighted = M.add_weights(df, M.class_weights(df, "g"), "g")
    assert weighted.agg(F.sum("classWeight")).first()[0] == pytest.approx(2000)


def test_split_exact_with_many_classes(spark):
    df = spark.range(4000).select("id", (F.col("id") % 40).alias("c"))
    train, test = M.split_exact(df, ["id"], "c", 0.7)
    again, _ = M.split_exact(df.repartition(3), ["id"], "c", 0.7)
    assert {(r["c"], r["count"]) for r in train.groupBy("c").count().collect()} == {(c, 70) for c in range(40)}
    assert test.count() == 1200 and {r["id"] for r in again.collect()} == {r["id"] for r in train.collect()}


def test_decimal_and_byte_columns_count(spark):
    from flowlake.functions.columns import feature_columns
    df = spark.sql("select cast(1 as decimal(5,2)) d, cast(2 as tinyint) b, 'x' s")
    assert feature_columns(df) == ["d", "b"]


def test_confusion_counts_what_is_outside(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 7.0), (0.0, None), (9.0, 0.0), (None, 1.0)], "label double, prediction double")
    rows = {r["label_name"]: r for r in V.confusion_matrix(df, ["a", "b"]).collect()}
    assert (rows["a"]["row_total"], rows["a"]["p_other"]) == (3, 2) and rows["a"]["class_accuracy"] == pytest.approx(1 / 3)
    assert rows["other"]["row_total"] == 2 and rows["b"]["row_total"] == 0


def test_binary_metrics_of_vectors(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(1.0, 1.0, Vectors.dense(0.1, 0.9)), (0.0, 1.0, Vectors.dense(0.4, 0.6)), (0.0, 0.0, Vectors.dense(0.8, 0.2))]
    row = V.binary_metrics(spark.createDataFrame(rows, ["label", "prediction", "probability"])).first()
    assert row["auc_roc"] == 1.0 and row["accuracy"] == pytest.approx(2 / 3) and row["n"] == 3


def test_rate_while_warming_up(spark):
    df = spark.createDataFrame([(s,) for s in (0, 0, 0, 1, 1, 1, 4)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    rates = {r["second"]: (r["n"], r["rate"]) for r in L.message_rate(df, "ts", span=3, block=5).collect()}
    assert rates == {0: (3, 3), 1: (3, 3), 2: (0, 2), 3: (0, 1), 4: (1, 0)}


def test_dedup_by_order(spark):
    from flowlake.operators.clean import dedup
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = sorted(map(tuple, dedup(df, ["k"], ["t"]).collect()))
    assert got == [("a", 2, "z"), ("b", None, "q")] == sorted(map(tuple, dedup(df.repartition(3), ["k"], ["t"]).collect()))


def test_labels_follow_frequency(spark):
    df = spark.createDataFrame([("z",), ("z",), ("b",), ("a",), (None,)], "t string").withColumn("x", F.lit(1.0))
    prepared = M.prepare_multiclass(df, "t", ["x"])
    assert prepared.labels == ["z", "a", "b"]
    assert prepared.data.count() == 4
    assert {r["label"]: r["weight"] for r in prepared.classes.collect()}[0.0] == pytest.approx(4 / (3 * 2))


def _auc(pairs):
    pos, neg = [v for v, y in pairs if y], [v for v, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(skewed):
    df, rows = skewed
    got = V.binary_auc(df, "y", ["v", "i"])
    want = {"v": _auc([(r[2], r[4]) for r in rows]), "i": _auc([(r[0], r[4]) for r in rows])}
    assert {r["feature"]: r["auc_roc"] for r in got.collect()} == pytest.approx(want)


def test_auc_equals_evaluator(skewed):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df, _ = skewed
    scored = df.select(F.col("y").cast("double").alias("label"), F.col("v").alias("rawPrediction"))
    want = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    assert V.binary_auc(df, "y", ["v"]).first()["auc_roc"] == pytest.approx(want)


def test_leak_is_flagged(skewed):
    df, _ = skewed
    got = {r["feature"]: r for r in V.leakage_audit(df.withColumn("leak", -F.col("y") * 3.0), "y", ["v", "leak"]).collect()}
    assert (got["leak"]["flag"], got["leak"]["auc"], got["leak"]["stump_auc"], got["leak"]["stump_accuracy"]) == ("YES", 1.0, 1.0, 1.0)
    assert got["v"]["flag"] == ""


def test_metrics_equal_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 3), (2, 0), (2, 0)]  # 2 never predicted, 3 never true
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    got = V.multiclass_metrics(df).first()
    names = {"accuracy": "accuracy", "f1_score": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    for ours, theirs in names.items():
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))
    per = {r["label"]: r for r in V.per_class_metrics(df, 5).collect()}
    assert sorted(per) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert per[2.0]["precision"] == 0.0 and per[3.0]["recall"] == 0.0 and per[4.0]["f1_score"] == 0.0
    matrix = {r["label_name"]: r for r in V.confusion_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert [matrix["a"][f"p{j}"] for j in range(4)] == [2, 1, 0, 0] and matrix["d"]["row_total"] == 0


def test_log_loss_equals_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.linalg import Vectors
    rows = [(0.0, 0.0, Vectors.dense(0.7, 0.3)), (1.0, 0.0, Vectors.dense(1.0, 0.0)), (1.0, 1.0, Vectors.dense(0.1, 0.9))]
    df = spark.createDataFrame(rows, ["label", "prediction", "probability"])
    want = MulticlassClassificationEvaluator(metricName="logLoss").evaluate(df)
    assert V.log_loss(df).first()["log_loss"] == pytest.approx(want)
    assert V.log_loss(df.drop("probability")).first()["log_loss"] is None


def test_correlation_is_pairwise(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, 1.0), (2.0, 4.5, nan), (3.0, 5.0, 2.0), (nan, 1.0, 9.0), (5.0, float("inf"), 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in E.correlation(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5])[0, 1])
    assert got[("a", "c")] == got[("c", "a")] == pytest.approx(np.corrcoef([1, 3, 5], [1, 2, 4])[0, 1])
    assert got[("a", "a")] == 1.0 and len(got) == 9


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "x double")
    assert [(r["bin"], r["n"]) for r in E.histogram(df, ["x"], 10).collect()] == [(0, 4)]


def test_sample_n(skewed):
    df, _ = skewed
    one = {r["i"] for r in E.sample_n(df, ["i"], 50).collect()}
    assert len(one) == 50 and one == {r["i"] for r in E.sample_n(df.repartition(3), ["i"], 50).collect()}


def test_message_rate_across_blocks(spark):
    rng = random.Random(3)
    seconds = sorted(rng.choice([5, 100 + rng.randrange(400)]) for _ in range(900))
    df = spark.createDataFrame([(s,) for s in seconds], "s long").select(F.timestamp_seconds("s").alias("ts"))
    for r in L.message_rate(df, "ts", span=60, block=100).collect():
        want = sum(r["second"] - 60 < s <= r["second"] for s in seconds)
        assert (r["window_count"], r["rate"]) == (want, want // min(60, r["second"] - seconds[0] + 1))


def test_rows_of_frequent_classes_stay_where_they_are(spark):
    """A short list of classes goes to the rows; dealt out by class, a few large classes would be a few tasks."""
    df = spark.range(30_000_000).select(F.when(F.col("id") == 7, "rare").when(F.col("id") % 3 > 0, "a").when(F.col("id") % 2 == 0, "b").alias("c"))
    kept = E.frequent_classes(df, "c", 2)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(c" not in plan and "SortMergeJoin" not in plan
    assert {r["c"]: r["count"] for r in kept.groupBy("c").count().collect()} == {"a": 19_999_999, "b": 5_000_000}  # without the rare one and nulls
