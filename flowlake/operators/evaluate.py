"""Metrics of scored tables and audits of labelled ones.

All class metrics derive from one shuffle that counts (label, prediction) pairs.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.ordered import running_totals
from flowlake.functions.safe import quoted, scrub

LOG_FLOOR = 1e-15

# Words in a feature name that hint at the label.
LEAK_WORDS = ["attack", "label", "class", "target", "intrusion", "anomaly", "is_"]


def pair_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n``."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _class_totals(pairs: DataFrame) -> DataFrame:
    """Per class: true count, predicted count, hits."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p"), hit.alias("h")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p"),
                 F.lit(0).cast("long").alias("h")),
    )
    return pairs.select(F.inline(sides)).groupBy("label").agg(
        F.sum("t").alias("n_true"), F.sum("p").alias("n_predicted"), F.sum("h").alias("n_hit")
    )


def _per_class(pairs: DataFrame) -> DataFrame:
    precision = _ratio(F.col("n_hit"), F.col("n_predicted"))
    recall = _ratio(F.col("n_hit"), F.col("n_true"))
    f1 = _ratio(2 * F.col("n_hit"), F.col("n_true") + F.col("n_predicted"))
    return _class_totals(pairs).select(
        "label", "n_true", "n_predicted", "n_hit",
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"),
    )


def per_class_metrics(scored: DataFrame, num_classes: int | None = None) -> DataFrame:
    """Precision, recall and F1 per class; 0 where a class has no rows on the deciding side.

    With ``num_classes`` every class index below it is listed, also one that never occurs; other labels that do
    occur are listed as well.
    """
    found = _per_class(pair_counts(scored))
    if num_classes is None:
        return found
    grid = scored.sparkSession.range(num_classes).select(F.col("id").cast("double").alias("label"))
    return grid.join(found, "label", "full").fillna(0, [c for c in found.columns if c != "label"])


def multiclass_metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy and the weighted F1, precision and recall."""
    share = F.col("n_true")
    total = F.sum("n_true")
    return _per_class(pair_counts(scored)).agg(
        total.alias("n"),
        (F.sum("n_hit") / total).alias("accuracy"),
        (F.sum(F.col("f1_score") * share) / total).alias("f1_score"),
        (F.sum(F.col("precision") * share) / total).alias("precision"),
        (F.sum(F.col("recall") * share) / total).alias("recall"),
    )


def log_loss(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Mean negative log of the probability given to the true class; null without a probability column."""
    if probability not in scored.columns:
        return scored.agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("log_loss"))
    probs = quoted(probability)
    if isinstance(scored.schema[probability].dataType, VectorUDT):
        probs = vector_to_array(probs)
    chance = F.coalesce(F.get(probs, F.col(label).cast("int")), F.lit(0.0))
    bounded = F.least(F.greatest(chance, F.lit(LOG_FLOOR)), F.lit(1.0 - LOG_FLOOR))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(-F.log(bounded)).alias("log_loss"))


def binary_confusion(scored: DataFrame) -> DataFrame:
    """TP, TN, FP, FN, rows that are neither (a label or prediction other than 0 and 1), and the four rates (null
    where the base is empty)."""
    def cell(label, prediction):
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    cells = scored.agg(
        cell(1, 1).alias("tp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
        F.count(F.lit(1)).alias("_n"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ["tp", "tn", "fp", "fn"])
    return cells.select(
        "tp", "tn", "fp", "fn", (F.col("_n") - tp - tn - fp - fn).alias("other"),
        F.try_divide(tp, tp + fn).alias("tpr"), F.try_divide(tn, tn + fp).alias("tnr"),
        F.try_divide(fp, fp + tn).alias("fpr"), F.try_divide(fn, fn + tp).alias("fnr"),
    )


def confusion_matrix(scored: DataFrame, names: list[str]) -> DataFrame:
    """Dense N x N table: one row per true class, a column per predicted class, one for predictions outside the
    known classes, the row total and the share of hits. Rows whose own label is outside (or null) are the row ``other``.
    """
    k = len(names)
    known = F.col("label").isin([float(i) for i in range(k)])
    pairs = pair_counts(scored).withColumn("label", F.when(known, F.col("label").cast("double")).otherwise(F.lit(-1.0)))
    inside = F.coalesce(F.col("prediction").isin([float(i) for i in range(k)]), F.lit(False))
    columns = [F.coalesce(F.sum(F.when(F.col("prediction") == j, F.col("n"))), F.lit(0)).alias(f"p{j}") for j in range(k)]
    diagonal = F.coalesce(F.sum(F.when(F.col("prediction") == F.col("label"), F.col("n"))), F.lit(0))
    outside = F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("p_other")
    rows = pairs.groupBy("label").agg(*columns, outside, F.sum("n").alias("row_total"), diagonal.alias("_hit"))
    grid = scored.sparkSession.createDataFrame(
        [*((float(i), n) for i, n in enumerate(names)), (-1.0, "other")], "label double, label_name string")
    # One row per class on either side.
    return (
        grid.join(F.broadcast(rows), "label", "left").fillna(0).filter("label >= 0 or row_total > 0")
        .withColumn("class_accuracy", _ratio(F.col("_hit"), F.col("row_total"))).drop("_hit")
    )


def binary_metrics(scored: DataFrame, score: str = "probability", label: str = "label") -> DataFrame:
    """One row for a scored 0/1 table: ``n``, the exact ``auc_roc``, and accuracy and the weighted F1, precision, recall.

    ``score`` is a vector (the second entry counts, as in ``probability`` and ``rawPrediction``) or a number.
    """
    value = quoted(score)
    if isinstance(scored.schema[score].dataType, VectorUDT):
        value = F.get(vector_to_array(value), F.lit(1))
    ranked = binary_auc(scored.select(quoted(label).alias("label"), value.alias("_score")), "label", ["_score"])
    # Two one-row tables.
    return multiclass_metrics(scored).withColumn("auc_roc", ranked.select("auc_roc").scalar()).select(
        "n", "auc_roc", "accuracy", "f1_score", "precision", "recall")


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """The most frequent class and the accuracy of always predicting it."""
    counts = df.groupBy(quoted(label).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct(F.col("n"), F.col("name")))
    return counts.agg(best.alias("_b"), F.sum("n").alias("total")).select(
        F.col("_b.name").alias("majority_class"), F.col("_b.n").alias("majority_count"), "total",
        (F.col("_b.n") / F.col("total")).alias("baseline_accuracy"),
    )


def suspicious_columns(df: DataFrame, columns: list[str], words: list[str] | None = None) -> DataFrame:
    """Every column with whether its name hints at the label, and how many of its cells are filled."""
    pattern = "|".join(words or LEAK_WORDS)
    wide = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows))).withColumn(
        "suspicious", F.lower("column_name").rlike(pattern)
    )


def _walked(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Per column and distinct value: positives and negatives at, before and in total.

    Rows are folded to distinct (column, value) pairs before anything is sorted, and the running sums
    spread a column over as many tasks as its values need.
    """
    target = quoted(label).cast("int")
    cells = df.filter(quoted(label).isNotNull()).select(
        target.alias("_y"), *[scrub(quoted(c)).alias(c) for c in columns]
    ).unpivot(["_y"], columns, "feature", "value")
    folded = cells.groupBy("feature", "value").agg(
        F.sum("_y").cast("double").alias("pos"), F.sum(1 - F.col("_y")).cast("double").alias("neg")
    )
    return running_totals(folded, ["feature"], ["value"], ["pos", "neg"])


def _rank_auc() -> Column:
    """Share of (positive, negative) pairs in order, ties counting half."""
    pairs = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return F.try_divide(pairs, F.max("pos_total") * F.max("neg_total"))


def binary_auc(df: DataFrame, label: str, scores: list[str]) -> DataFrame:
    """Exact area under the ROC curve of each score column: ``feature, auc_roc``."""
    return _walked(df, label, scores).groupBy("feature").agg(_rank_auc().alias("auc_roc"))


def leakage_audit(df: DataFrame, label: str, columns: list[str], sure: float = 0.99, high: float = 0.95) -> DataFrame:
    """How well each single column separates a 0/1 label, over all rows and in one job.

    ``auc`` is the better direction of the rank AUC. ``stump_auc`` and ``stump_accuracy`` describe the
    one-threshold rule with the best gini gain. ``flag`` is YES / HIGH / empty by ``auc``.
    """
    left_pos, left_neg = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    right_pos, right_neg = F.col("pos_total") - left_pos, F.col("neg_total") - left_neg

    def purity(a, b):
        return F.coalesce(F.try_divide(a * a + b * b, a + b), F.lit(0.0))

    tpr, fpr = F.try_divide(left_pos, F.col("pos_total")), F.try_divide(left_neg, F.col("neg_total"))
    stump = F.struct(
        (purity(left_pos, left_neg) + purity(right_pos, right_neg)).alias("gain"),
        (-F.col("value")).alias("tie"),
        (0.5 + 0.5 * F.abs(tpr - fpr)).alias("auc"),
        ((F.greatest(left_pos, left_neg) + F.greatest(right_pos, right_neg))
         / (F.col("pos_total") + F.col("neg_total"))).alias("accuracy"),
    )
    raw = F.col("_auc")
    result = _walked(df, label, columns).groupBy("feature").agg(_rank_auc().alias("_auc"), F.max(stump).alias("_s"))
    auc = F.greatest(raw, 1 - raw)
    return result.select(
        "feature", auc.alias("auc"), F.col("_s.auc").alias("stump_auc"), F.col("_s.accuracy").alias("stump_accuracy"),
        F.when(auc > sure, "YES").when(auc > high, "HIGH").otherwise("").alias("flag"),
    )
