"""Quantiles from mergeable sketches (KLL), kept per partition of a table.

The exact path (``ordered.exact_quantiles``) sorts all distinct cells. Here a scan leaves one sketch of a few kilobytes per column
and partition; sketches of any partitions merge to one with the same error, so a question about a year reads a year's sketches
and no row. The answer's rank is off by at most ``rank_bound`` with the confidence asked for; ``rank_errors`` measures by how much
it really is, in one scan without a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.safe import finite_or_null, quoted

K = 800


def rank_bound(k: int = K, sigmas: float = 2.576) -> float:
    """Rank error of a sketch of size ``k`` as a share of the rows; the published fit is for 99 % (2.576 standard deviations)."""
    return 2.446 / k ** 0.9433 * sigmas / 2.576


def per_part(df: DataFrame, columns: list[str], part: str | None = None, k: int = K, limit: float | None = None) -> DataFrame:
    """``part`` (if any), ``feature``, ``sketch``: one aggregate over one scan; null, NaN, infinities and values above ``limit`` are left out."""
    keys = [quoted(part).alias(part)] if part else []
    wide = df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(finite_or_null(quoted(c).cast("double"), limit), F.lit(k)).alias(f"k{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"k{i}").alias("sketch")) for i, c in enumerate(columns)])
    return wide.select(*([part] if part else []), F.inline(pairs))


def store(spark: SparkSession, sketches: DataFrame, path: str, part: str) -> None:
    """Keep sketches by partition; those of the same partitions are replaced."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def merged(sketches: DataFrame) -> DataFrame:
    """``feature, sketch`` over all the rows given."""
    return sketches.groupBy("feature").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, points: list[float]) -> DataFrame:
    """``feature, point, n, value`` of merged sketches."""
    rows = F.array(*[F.struct(F.lit(float(p)).alias("point"), F.kll_sketch_get_n_double("sketch").alias("n"),
                              F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in points])
    return sketches.select("feature", F.inline(rows))


def box(sketches: DataFrame) -> DataFrame:
    """``feature, n, q1, median, q3`` and the whiskers' limits at 1.5 interquartile ranges."""
    wide = quantiles(sketches, [0.25, 0.5, 0.75]).groupBy("feature", "n").agg(
        *[F.max(F.when(F.col("point") == p, F.col("value"))).alias(name) for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    spread = F.col("q3") - F.col("q1")
    return wide.withColumns({"low_limit": F.col("q1") - 1.5 * spread, "high_limit": F.col("q3") + 1.5 * spread})


def rank_errors(df: DataFrame, answers: DataFrame, limit: float | None = None) -> DataFrame:
    """``answers`` (``feature, point, n, value``) with ``rank_error``: the distance of ``point`` from the ranks that ``value`` really has."""
    rows = answers.collect()  # columns x points
    cells = {r["feature"]: finite_or_null(quoted(r["feature"]).cast("double"), limit) for r in rows}
    wide = df.agg(*[f.alias(f"{side}{i}") for i, r in enumerate(rows) for side, f in (
        ("b", F.count_if(cells[r["feature"]] < r["value"])), ("t", F.count_if(cells[r["feature"]] <= r["value"])))])
    entries = [F.struct(F.lit(r["feature"]).alias("feature"), F.lit(r["point"]).alias("point"), F.lit(r["n"]).alias("n"), F.lit(r["value"]).alias("value"),
                        F.greatest(F.col(f"b{i}") / F.lit(r["n"]) - r["point"], F.lit(r["point"]) - F.col(f"t{i}") / F.lit(r["n"]), F.lit(0.0)).alias("rank_error"))
               for i, r in enumerate(rows)]
    return wide.select(F.inline(F.array(*entries)))
