"""Global order without a global task.

``row_number() over (order by ..)`` or a running sum per large group sends all rows of a group to one
task. Here rows are range-partitioned and sorted once, the partition layout is written down, and what
has to cross partitions is one small total per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.session import materialise

ROWS_PER_PART = 5_000_000
ROWS_PER_SLICE = 1_000_000  # of a part of which only some are walked
_INDEX_BITS = 33  # monotonically_increasing_id(): partition number above, row index below


def _ranged(df: DataFrame, order: list[str], parts: int | None, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    # Counting, finding the limits of the ranges and the exchange would each make the rows anew; so they are written once before.
    stored = materialise(df, "to-order")
    if parts is None:
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), stored.count() // rows_per_part)
    laid_out = (
        stored.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return (
        materialise(laid_out, "ranged")
        .withColumn("_part", F.shiftright("_mid", _INDEX_BITS))
        .withColumn("_index", F.col("_mid").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
        .drop("_mid")  # an index beyond its bits would need a part of 2**33 rows
    )


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal", parts: int | None = None) -> DataFrame:
    """Add the 0-based rank of each row in the total order of ``order`` (end it with a unique column)."""
    ranged = _ranged(df, order, parts)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, so this frame is as small as the partition count.
    offsets = (
        ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_index"))
        .drop("_part", "_index", "_offset")
    )


def running_totals(
    df: DataFrame, groups: list[str], order: list[str], sums: list[str], parts: int | None = None
) -> DataFrame:
    """Per group and in the order of ``order``: for each column of ``sums`` add ``<c>_before`` (sum of
    all earlier rows) and ``<c>_total`` (sum of the group).

    ``order`` must be unique inside a group (aggregate first). A group may span any number of tasks;
    null is a group like any other.
    """
    # The group as text is never null, so the window and the join below can share it as a key.
    group = F.to_json(F.struct(*groups)) if groups else F.lit("")
    ranged = _ranged(df.withColumn("_group", group), ["_group", *order], parts)
    keys = ["_part", "_group"]
    slices = ranged.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most groups + parts rows: a partition edge cuts one group in two.
    offsets = slices.select(
        *keys,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_off") for c in sums],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in sums],
    )
    # Same keys again: if the planner does not broadcast the offsets, the shuffle of the window is reused.
    local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    walked = ranged.drop("_index").select(
        "*", *[F.coalesce(F.sum(c).over(local), F.lit(0)).alias(f"_{c}_loc") for c in sums]
    )
    before = {f"{c}_before": F.col(f"_{c}_loc") + F.col(f"_{c}_off") for c in sums}
    return walked.join(offsets, keys).withColumns(before).drop(
        *keys, *[f"_{c}_loc" for c in sums], *[f"_{c}_off" for c in sums]
    )


def exact_quantiles(
    df: DataFrame, groups: list[str], value: str, points: dict[str, float], parts: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of ``points``.

    Counts per distinct value are laid out in order. One total per group and part tells which parts hold the wanted ranks;
    only their rows are added up one by one. No buffer ever holds a whole group. Null and NaN are left out.
    """
    counts = (
        df.filter(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    )
    # The group as text is never null, so the windows and the join below can share it as a key.
    group = F.to_json(F.struct(*groups)) if groups else F.lit("")
    ranged = _ranged(counts.withColumn("_group", group), ["_group", value], parts, ROWS_PER_SLICE)
    keys = ["_part", "_group"]
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    position = {q: F.lit(p) * (F.col("n_total") - 1) for q, p in points.items()}

    def within(rank):
        return (F.col("_off") <= rank) & (rank < F.col("_off") + F.col("_in"))

    wanted = F.lit(False)
    for pos in position.values():
        wanted = wanted | within(F.floor(pos)) | within(F.ceil(pos))
    # At most groups + parts rows: a partition edge cuts one group in two.
    slices = ranged.groupBy(*keys).agg(F.sum("n").alias("_in")).select(
        *keys, "_in", F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_off"), F.sum("_in").over(whole).alias("n_total")
    ).filter(wanted).drop("_in")
    local = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.drop("_index").join(slices, keys).withColumn(
        "n_before", F.col("_off") + F.coalesce(F.sum("n").over(local), F.lit(0)))

    def at(rank):
        hit = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
        return F.max(F.when(hit, F.col(value)))

    aggregates = [F.max("n_total").alias("n_total")]
    for q, pos in position.items():
        aggregates += [at(F.floor(pos)).alias(f"_{q}_lo"), at(F.ceil(pos)).alias(f"_{q}_hi")]
    found = ranked.groupBy(*groups).agg(*aggregates)
    return found.select(
        *groups,
        F.col("n_total").alias("n"),
        *[
            (F.col(f"_{q}_lo") + (F.col(f"_{q}_hi") - F.col(f"_{q}_lo")) * (pos - F.floor(pos))).alias(q)
            for q, pos in position.items()
        ],
    )
