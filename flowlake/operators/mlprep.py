"""From a feature table to weighted, split training data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import MinMaxScaler, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.functions.columns import feature_columns, label_column
from flowlake.functions.hashing import RESOLUTION, draw
from flowlake.functions.ordered import with_ordinal
from flowlake.functions.safe import quoted, scrub
from flowlake.session import keep


FOLD_DRAW = "fold_draw"


def class_table(df: DataFrame, column: str) -> DataFrame:
    """One row per class: ``label`` (0 = most frequent, ties by name), ``name``, ``n`` and the balanced
    weight ``N / (K * n)``. One aggregate serves indexing and weighting."""
    counts = df.filter(quoted(column).isNotNull()).groupBy(quoted(column).alias("name")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Ranked over tasks, so a column that turns out to have very many values is slow at worst.
    ranked = with_ordinal(counts.withColumn("_down", -F.col("n")), ["_down", "name"], "_rank")
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return ranked.select(
        F.col("_rank").cast("double").alias("label"), "name", "n",
        (total / (classes * F.col("n"))).cast("double").alias("weight"),
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, n, weight`` with ``weight = N / (K * n)``."""
    return class_table(df, label).select(F.col("name").alias(label), "n", "weight")


def add_weights(df: DataFrame, weights: DataFrame, label: str = "label", name: str = "classWeight") -> DataFrame:
    """Attach the class weight; 1.0 for a class without one."""
    side = weights.select(label, F.col("weight").alias(name))
    return df.join(side, label, "left").withColumn(name, F.coalesce(F.col(name), F.lit(1.0)))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def in_train(keys: list[Column], ratio: float, seed: int) -> Column:
    """Membership of the training side, decided row by row from its key."""
    return draw(keys, seed) < F.lit(int(ratio * RESOLUTION))


def split(df: DataFrame, keys: list[str], ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Hash split. Every class keeps the ratio in expectation, copies of a key stay on one side, and no
    join is needed to get the complement."""
    side = in_train([quoted(k) for k in keys], ratio, seed)
    return df.filter(side), df.filter(~side)


def split_random(df: DataFrame, ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; reproducible for a fixed input layout only."""
    train, test = df.randomSplit([ratio, 1.0 - ratio], seed)
    return train, test


def split_exact(df: DataFrame, keys: list[str], label: str = "label", ratio: float = 0.8, seed: int = 42,
                cells: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Stratified split by whole keys: per class the longest run of keys, in the order of their draws, that has at most
    ``floor(ratio * n)`` rows.

    Copies of a key in a class are never parted, so a class has that many training rows, less at most the copies of one key; with
    unique keys it is exact. The split depends on keys and seed only, not on the layout of files.
    """
    side = _exact_side(df, keys, label, ratio, seed, cells)
    return side.filter("_train").drop("_train"), side.filter("not _train").drop("_train")


def _exact_side(df, keys, label, ratio, seed, cells):
    """A class's cut is one number: the last draw that still trains. It is found without ranking a class: counts per
    slice of the draw name the slice that holds the cut, and only that slice's draws are added up one by one."""
    drawn = df.withColumn("_draw", draw([quoted(k) for k in keys], seed))
    folded = drawn.groupBy(quoted(label).alias("_class"), "_draw").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_cell", F.floor(F.col("_draw") / (RESOLUTION // cells)))
    group = Window.partitionBy("_class")
    up_to = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most classes x cells rows; one row per class is left.
    slices = folded.groupBy("_class", "_cell").agg(F.sum("_n").alias("_in")).select(
        "_class", "_cell", F.floor(F.sum("_in").over(group) * F.lit(ratio)).alias("_want"),
        (F.sum("_in").over(up_to) - F.col("_in")).alias("_before"), F.sum("_in").over(up_to).alias("_through"))
    cut = slices.filter("_through > _want").groupBy("_class", "_want").agg(
        F.min(F.struct("_cell", "_before")).alias("_at")).select("_class", "_want", "_at.*")
    inside = folded.join(cut.withColumnsRenamed({"_class": "_c", "_cell": "_cut"}),
                         F.col("_class").eqNullSafe(F.col("_c")) & (F.col("_cell") == F.col("_cut")))
    walk = group.orderBy("_draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_out = inside.withColumn("_sum", F.col("_before") + F.sum("_n").over(walk)).filter("_sum > _want").groupBy(
        F.col("_class").alias("_c")).agg(F.min("_draw").alias("_limit"))
    # One row per class.
    placed = drawn.join(F.broadcast(first_out), drawn[label].eqNullSafe(F.col("_c")), "left")
    return placed.withColumn("_train", F.coalesce(F.col("_draw") < F.col("_limit"), F.lit(True))).drop("_draw", "_c", "_limit")


def overlap(train: DataFrame, test: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur on both sides; empty for a sound split."""
    return test.select(*keys).distinct().join(train.select(*keys).distinct(), keys, "left_semi")


def complement(df: DataFrame, train: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``train``."""
    return df.join(train.select(*keys).distinct(), keys, "left_anti")


def assemble(df: DataFrame, features: list[str], keep: list[Column]) -> DataFrame:
    """One projection to clean doubles, then the vector.

    The scrub leaves nothing for the assembler to skip, so it is told to keep every row: its skip mode
    would repeat all feature expressions in a filter.
    """
    slim = df.select(*keep, *[scrub(quoted(c)).alias(c) for c in features])
    vector = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return vector.transform(slim).drop(*features)


def prepare_binary(df: DataFrame, label: str = "Attack_label", features: list[str] | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """``features`` and a 0/1 ``label``; rows without a label are left out."""
    names = features or [c for c in feature_columns(df) if c not in (keep or [])]
    known = df.filter(quoted(label).isNotNull())
    return assemble(known, names, [*[quoted(k) for k in keep or []], quoted(label).cast("double").alias("label")])


@dataclass
class Prepared:
    """Training data and what is needed to read its labels and features."""

    data: DataFrame
    classes: DataFrame
    labels: list[str]
    features: list[str]


def prepare_multiclass(df: DataFrame, label: str | None = None, features: list[str] | None = None,
                       keep: list[str] | None = None, weighted: bool = True, max_classes: int = 10_000) -> Prepared:
    """``features``, indexed ``label`` and ``classWeight``.

    Classes, their order and their weights come from one aggregate; labels that are null are left out,
    so the model has exactly as many classes as the data.
    """
    label = label or label_column(df)
    names = features or [c for c in feature_columns(df) if c not in (keep or [])]
    found = df.select(quoted(label)).filter(quoted(label).isNotNull()).distinct().count()
    if found > max_classes:
        raise ValueError(f"{label!r} has {found} distinct values, over max_classes={max_classes}; it is no class label")
    table = class_table(df, label)
    rows = table.orderBy("label").collect()  # one row per class, counted above
    classes = df.sparkSession.createDataFrame(rows, table.schema)
    labels = [r["name"] for r in rows]
    indexer = StringIndexerModel.from_labels(labels, label, "label", handleInvalid="error")
    known = df.filter(quoted(label).isNotNull())
    data = assemble(indexer.transform(known), names, [*[quoted(k) for k in keep or []], F.col("label")])
    if weighted:
        # Labels count from 0, so the weight is found by position.
        weights = F.array(*[F.lit(r["weight"]) for r in rows])
        data = data.withColumn("classWeight", F.coalesce(F.get(weights, F.col("label").cast("int")), F.lit(1.0)))
    return Prepared(data, classes, labels, names)


@dataclass
class TrainingSet:
    train: DataFrame
    test: DataFrame
    classes: DataFrame
    labels: list[str]
    features: list[str]

    def release(self) -> None:
        self.train.unpersist()
        self.test.unpersist()


def training_set(df: DataFrame, keys: list[str], multiclass: bool = True, label: str | None = None,
                 features: list[str] | None = None, ratio: float = 0.8, seed: int = 42,
                 sample_fraction: float | None = None, persist: bool = True) -> TrainingSet:
    """Index, assemble, weight and split; both sides are persisted once for the many passes of a fit.

    ``sample_fraction`` thins the rows beforehand (hash based); by default every row is used. Rows keep a draw of their key
    (``fold_draw``, independent of the split's), from which cross-validation makes folds that no key straddles.
    """
    if sample_fraction is not None:
        df = df.filter(in_train([quoted(k) for k in keys], sample_fraction, seed + 1))
    if multiclass:
        prepared = prepare_multiclass(df, label, features, keep=keys)
    else:
        target = label or "Attack_label"
        data = prepare_binary(df, target, features, keep=keys)
        classes = class_weights(data).withColumn("name", F.col("label").cast("string"))
        names = features or [c for c in feature_columns(df) if c not in keys]
        prepared = Prepared(add_weights(data, classes), classes, ["0.0", "1.0"], names)
    train, test = split(prepared.data, keys, ratio, seed)
    folding = draw([quoted(k) for k in keys], seed + 2)
    train, test = (side.withColumn(FOLD_DRAW, folding).drop(*keys) for side in (train, test))  # alike, so they can be united
    if persist:
        train, test = keep(train), keep(test)
    return TrainingSet(train, test, prepared.classes, prepared.labels, prepared.features)


def standard_scaler(column: str = "features", out: str = "scaled_features") -> StandardScaler:
    """Unit sample deviation, no centring."""
    return StandardScaler(inputCol=column, outputCol=out, withMean=False, withStd=True)


def minmax_scaler(column: str = "features", out: str = "scaled_features") -> MinMaxScaler:
    """Linear to [0, 1]."""
    return MinMaxScaler(inputCol=column, outputCol=out, min=0.0, max=1.0)
