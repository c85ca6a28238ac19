"""Quality profiles kept per partition (an ingest day, say) and merged, so that a report over a grown table reads what is new.

A partition's profile is a few rows: counts, sums and extremes of its cells, deviations around its own mean, how many of its rows are
distinct, its class counts, and sketches of its distinct values. All of them merge: counts and sums add up, means and deviations
combine exactly, sketches unite. Distinct rows add up as well if equal rows always lie in one partition, which holds
when the partition is a function of the row. A partition is profiled once and its folder put there whole; the scan that
profiles new ones opens the folders of those alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.columns import NUMBERS
from flowlake.functions.safe import finite_or_null, quoted
from flowlake.operators import quality as Q
from flowlake.streaming.commits import folder_names

PARTS = ["cells", "rows", "classes"]
SKETCH_BITS = 14  # distinct counts within about 1 %


def _numbers(fields: list[T.StructField]) -> list[str]:
    return [f.name for f in fields if isinstance(f.dataType, NUMBERS)]


def _cells(df: DataFrame, fields: list[T.StructField], part: str) -> DataFrame:
    measures = Q.cell_measures(fields)
    spread = {f"v{i}": F.coalesce(F.var_pop(finite_or_null(quoted(c).cast("double"))) * F.count(finite_or_null(quoted(c).cast("double"))), F.lit(0.0))
              for i, c in enumerate(_numbers(fields))}
    # With a sign before it, since a sketch passes over empty texts.
    sketches = {f"d{i}": F.hll_sketch_agg(F.concat(F.lit("="), F.coalesce(quoted(f.name).cast("string"), F.lit(""))), F.lit(SKETCH_BITS)) for i, f in enumerate(fields)}
    # One by one, as Spark generates no code for an aggregate with sketches in it, nor for one of so many cells.
    found, *others = (df.groupBy(quoted(part).alias(part)).agg(*[c.alias(n) for n, c in kind.items()]) for kind in (measures, spread, sketches) if kind)
    for other in others:  # one row per partition
        found = found.join(other.withColumnRenamed(part, "_part"), quoted(part).eqNullSafe(F.col("_part"))).drop("_part")
    return found


def _rows(df: DataFrame, fields: list[T.StructField], part: str) -> DataFrame:
    copies = df.groupBy(quoted(part).alias(part), *[quoted(f.name) for f in fields]).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.groupBy(part).agg(F.sum("_copies").alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows"))


def _classes(df: DataFrame, labels: list[str], part: str) -> DataFrame:
    combos = df.groupBy(quoted(part).alias(part), *[quoted(c).cast("string").alias(f"_{c}") for c in labels]).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("class_value")) for c in labels])
    return combos.select(part, "_n", F.inline(pairs)).groupBy(part, "column_name", "class_value").agg(F.sum("_n").alias("count"))


def missing_parts(spark: SparkSession, source: str, profile: str, part: str) -> list[str]:
    """Partition values of the table that have no complete profile yet, from folder names alone."""
    name = f"{part}="
    there = [f.removeprefix(name) for f in folder_names(spark, source) if f.startswith(name)]
    done = set.intersection(*[{f.removeprefix(name) for f in folder_names(spark, f"{profile}/{kind}")} for kind in PARTS])
    return [p for p in there if p not in done]


def update(spark: SparkSession, source: str, profile: str, part: str, labels: list[str]) -> list[str]:
    """Profile the partitions of the table at ``source`` that are new; their values as text."""
    new = missing_parts(spark, source, profile, part)
    if new:
        table = spark.read.parquet(source)
        fields = [f for f in table.schema.fields if f.name != part]
        fresh = table.filter(quoted(part).cast(table.schema[part].dataType).isin([F.lit(p).cast(table.schema[part].dataType) for p in new]))
        for kind, frame in {"cells": _cells(fresh, fields, part), "rows": _rows(fresh, fields, part), "classes": _classes(fresh, labels, part)}.items():
            # A partition whose profile was lost half-way is written anew, the others stay.
            frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(f"{profile}/{kind}")
    return new


def read(spark: SparkSession, profile: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{profile}/{kind}")


def report(spark: SparkSession, profile: str, fields: list[T.StructField], labels: list[str], digits: int = 2) -> DataFrame:
    """The rows of ``quality.report`` over all profiled partitions, from the profiles alone."""
    cells = read(spark, profile, "cells")
    add = {n: F.min(n) if n.startswith("lo") else F.max(n) if n.startswith("hi") else F.sum(n) for n in Q.cell_measures(fields)}
    totals = read(spark, profile, "rows").agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum("distinct_rows"), F.lit(0)).alias("distinct_rows"))
    surplus = F.col("total_rows") - F.col("distinct_rows")
    dup = totals.select("total_rows", "distinct_rows", surplus.alias("duplicate_rows"), Q.percent(surplus, F.col("total_rows"), digits).alias("duplicate_pct"))
    counts = read(spark, profile, "classes").filter(F.col("column_name").isin(labels)).groupBy("column_name", "class_value").agg(F.sum("count").alias("count"))
    whole = cells.agg(F.sum("_rows")).scalar()
    classes = counts.withColumn("percentage", Q.percent(F.col("count"), whole, digits))
    return Q.assembled(cells.agg(*[c.alias(n) for n, c in add.items()]), fields, dup, classes, digits)


def numeric_stats(spark: SparkSession, profile: str, fields: list[T.StructField]) -> DataFrame:
    """``column_name, n, mean, stddev, min_value, max_value`` of the finite values, as ``quality.long_stats`` has them."""
    names = _numbers(fields)
    cells = read(spark, profile, "cells")
    long = cells.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("s"), F.col(f"v{i}").alias("v"),
                 F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi")) for i, c in enumerate(names)])))
    means = long.groupBy("column_name").agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"))
    both = long.join(means, "column_name").withColumn("_mean", F.try_divide(F.col("_s"), F.col("_n").cast("double")))
    # Deviations around the common mean: those around the own mean, and the own mean's distance.
    off = F.coalesce(F.col("n") * F.pow(F.try_divide(F.col("s"), F.col("n").cast("double")) - F.col("_mean"), F.lit(2)), F.lit(0.0))
    merged = both.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(F.col("v") + off).alias("_m2"), F.min("lo").alias("min_value"), F.max("hi").alias("max_value"))
    spread = F.sqrt(F.try_divide(F.col("_m2"), (F.col("n") - 1).cast("double")))
    return merged.select("column_name", "n", "mean", spread.alias("stddev"), "min_value", "max_value")


def distinct_values(spark: SparkSession, profile: str, fields: list[T.StructField]) -> DataFrame:
    """``column_name, distinct_values`` (null as the empty text), estimated from the united sketches."""
    cells = read(spark, profile, "cells").agg(*[F.hll_union_agg(f"d{i}").alias(f"d{i}") for i in range(len(fields))])
    return cells.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.hll_sketch_estimate(f"d{i}").alias("distinct_values")) for i, f in enumerate(fields)])))
