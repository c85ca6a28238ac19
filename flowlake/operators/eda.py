"""Exploratory aggregations: distributions, time buckets, pivots, quantiles, correlation, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.hashing import digest, draw
from flowlake.functions.ordered import exact_quantiles, with_ordinal
from flowlake.functions.safe import finite_or_null, quoted, try_num
from flowlake.session import materialise


def top_k(df: DataFrame, column: str, k: int, exclude: str | None = None) -> DataFrame:
    """The ``k`` most frequent values (ties by name), optionally without one of them."""
    if exclude is not None:
        df = df.filter(quoted(column) != exclude)
    counts = df.groupBy(quoted(column).alias(column)).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), column).limit(k)


def hour_bucket(seconds: Column, width: float = 3600) -> Column:
    """Ordinal of the time bucket that holds an offset in seconds; null for text that is no number."""
    return F.floor(try_num(seconds) / F.lit(float(width)))


def bucket_counts(df: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    """Rows per bucket; rows without a bucket are left out."""
    return df.select(bucket.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(
        F.count(F.lit(1)).alias("n")
    )


def bucket_pivot(df: DataFrame, bucket: Column, column: Column, values: list[str], name: str = "bucket") -> DataFrame:
    """Bucket x class counts, zero-filled. The classes are given, so the schema is fixed beforehand."""
    slim = df.select(bucket.alias(name), column.alias("_class")).filter(F.col(name).isNotNull())
    return slim.groupBy(name).pivot("_class", values).agg(F.count(F.lit(1))).fillna(0)


def normal_or_attack(label: Column, normal: str = "Normal") -> Column:
    """Two-way class from the label text."""
    return F.when(label == normal, F.lit("normal")).otherwise(F.lit("attack"))


def bucket_top_classes(df: DataFrame, bucket: Column, column: str, k: int, exclude: str | None = None,
                       name: str = "bucket") -> DataFrame:
    """Counts per bucket and class for the ``k`` most frequent classes, long format.

    The scan is folded to (bucket, class) first; the ranking and the restriction then work on that.
    """
    slim = df.select(bucket.alias(name), quoted(column).alias(column))
    if exclude is not None:
        slim = slim.filter(F.col(column) != exclude)
    folded = slim.groupBy(name, column).agg(F.count(F.lit(1)).alias("n"))
    leaders = (
        folded.groupBy(column).agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), column).limit(k)
    )
    # k rows at most, whatever the table holds.
    return folded.filter(F.col(name).isNotNull()).join(F.broadcast(leaders.select(column)), column, "left_semi")


def ordinal_batches(df: DataFrame, column: str, order: list[str], batches: int = 200) -> DataFrame:
    """Split the rows, in order, into runs of ``max(rows // batches, 1)`` and count classes per run.

    Ties of ``order`` are broken by the class itself: rows equal in both are interchangeable here, so the counts do not depend on layout.
    """
    names = list(dict.fromkeys([*order, column]))
    numbered = with_ordinal(df.select(*names), names)
    size = F.greatest(F.floor(numbered.agg(F.count(F.lit(1))).scalar() / batches), F.lit(1))
    return (
        numbered.groupBy(F.floor(F.col("ordinal") / size).alias("batch"), column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def unpivot(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """``keep``, ``feature``, ``value``: one row per cell of ``columns``."""
    return df.select(*(keep or []), *[quoted(c).cast("double").alias(c) for c in columns]).unpivot(
        keep or [], columns, "feature", "value"
    )


def finite_cells(df: DataFrame, columns: list[str], keep: list[str] | None = None, limit: float | None = None) -> DataFrame:
    """Unpivoted cells without null, NaN, infinities and magnitudes above ``limit``."""
    cells = unpivot(df, columns, keep)
    return cells.withColumn("value", finite_or_null(F.col("value"), limit)).filter("value is not null")


def histogram(df: DataFrame, columns: list[str], bins: int = 30, by: list[str] | None = None) -> DataFrame:
    """Equi-width bins per column (and per ``by``): ``feature, bin, bin_start, n``.

    Two scans: one for the ranges, one for the counts. Ranges are per column, so they stay few; the
    ranges of ``by`` groups are as many as those groups and are joined by the planner's choice.
    """
    keys = [*(by or []), "feature"]
    cells = finite_cells(df, columns, by)
    ranges = cells.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    place = F.floor(F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")) * bins)
    found = ranges.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    if not by:
        found = F.broadcast(found)  # one row per column
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    binned = cells.join(found, same, "inner").select(
        *keys,
        F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"),
        F.col("lo").alias("_lo"), width.alias("_width"),
    )
    return (
        binned.groupBy(*keys, "bin", "_lo", "_width").agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "bin", (F.col("_lo") + F.col("_width") * F.col("bin")).alias("bin_start"), "n")
    )


def correlation(df: DataFrame, columns: list[str], limit: float | None = None, digits: int | None = None) -> DataFrame:
    """Pearson correlation of every two columns, each over the rows where both are usable; long format.

    One scan. Each row is expanded once per column (not per pair) and folded map-side into one row of
    partial moments per column, so what is shuffled is as wide and as long as the matrix.
    """
    usable = {c: finite_or_null(quoted(c).cast("double"), limit) for c in columns}
    cells = df.select(*[v.alias(f"x{i}") for i, v in enumerate(usable.values())]).select(
        "*", F.inline(F.array(*[
            F.struct(F.lit(i).alias("_i"), F.col(f"x{i}").alias("_x")) for i in range(len(columns))
        ]))
    )
    rows = cells.groupBy("_i").agg(*[F.corr("_x", f"x{j}").alias(f"r{j}") for j in range(len(columns))])
    names = F.array(*[F.lit(c) for c in columns])

    def cell(j):
        r = F.when(F.col("_i") == j, F.lit(1.0)).otherwise(F.col(f"r{j}"))
        return F.struct(
            names[F.col("_i")].alias("feature_a"), F.lit(columns[j]).alias("feature_b"),
            (r if digits is None else F.round(r, digits)).alias("r"),
        )

    return rows.select(F.inline(F.array(*[cell(j) for j in range(len(columns))])))


def _bounds(cells: DataFrame, low: float, high: float, exact: bool) -> DataFrame:
    if exact:
        return exact_quantiles(cells, ["feature"], "value", {"lo": low, "hi": high}).drop("n")
    ends = F.percentile_approx("value", [low, high], 10_000)
    return cells.groupBy("feature").agg(ends.alias("_e")).select(
        "feature", F.col("_e")[0].alias("lo"), F.col("_e")[1].alias("hi")
    )


def trim(df: DataFrame, columns: list[str], low: float = 0.02, high: float = 0.98, keep: list[str] | None = None,
         limit: float | None = 1e12, exact: bool = True) -> DataFrame:
    """Cells inside the percentile range of their column, long format. The bounds are one row per column."""
    cells = finite_cells(df, columns, keep, limit)
    bounds = _bounds(finite_cells(df, columns, limit=limit), low, high, exact)
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    return cells.join(F.broadcast(bounds), "feature").filter(inside).drop("lo", "hi")


def log1p_clipped(col: Column) -> Column:
    """``log(1 + x)`` with negatives lifted to zero."""
    return F.log1p(F.greatest(col, F.lit(0.0)))


def frequent_classes(df: DataFrame, column: str, at_least: int = 50) -> DataFrame:
    """Rows of classes that have at least that many rows.

    The classes are written first: of a table of known size the planner sends a short list to the rows, which then stay where they are. Otherwise
    all rows would be dealt out by class, and a few large classes are a few tasks.
    """
    kept = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= at_least).select(column)
    return df.join(materialise(kept, "frequent"), column, "left_semi")


def box_statistics(df: DataFrame, by: str, columns: list[str], logged: list[str] | None = None, low: float = 0.02,
                   high: float = 0.98, at_least: int = 50, exact: bool = True) -> DataFrame:
    """Quartiles per class and column after dropping rare classes, trimming, and the optional log."""
    cells = trim(frequent_classes(df, by, at_least), columns, low, high, [by], exact=exact)
    if logged:
        value = F.col("value")
        cells = cells.withColumn("value", F.when(F.col("feature").isin(logged), log1p_clipped(value)).otherwise(value))
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    if exact:
        return exact_quantiles(cells, ["feature", by], "value", points)
    marks = F.percentile_approx("value", list(points.values()), 10_000)
    return cells.groupBy("feature", by).agg(F.count(F.lit(1)).alias("n"), marks.alias("_m")).select(
        "feature", by, "n", *[F.col("_m")[i].alias(q) for i, q in enumerate(points)]
    )


def sample_n(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """A fixed-size sample that depends on keys and seed only. Exact copies of a row draw alike, so pass
    keys that tell rows apart or accept that copies are taken together."""
    drawn = df.withColumn("_draw", digest([quoted(k) for k in keys], seed))
    return drawn.orderBy("_draw", *keys).limit(n).drop("_draw")


def sample_fraction(df: DataFrame, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """A Bernoulli sample that depends on keys and seed only."""
    return df.filter(draw([quoted(k) for k in keys], seed) < F.lit(int(fraction * (1 << 32))))
