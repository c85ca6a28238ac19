"""Mixing sources to target weights with a low-discrepancy schedule.

A source's *target* is its weight's share of all tokens, at most ``MOST`` times what it has; what that leaves over is
shared out again by weight until no target is above its limit. The mix is a schedule of slots of equal token counts:

* slot ``i`` takes the van der Corput point of ``i`` (its bits reversed) through the cumulative targets to a source, so
  every stretch of the schedule is mixed like the whole;
* slots are ranked per source (counted per stretch of slots, the stretches' counts added up), and rank ``k`` takes block
  ``k`` of the source's shuffled token stream, starting again when the stream is used up. The last slot of a source
  is cut so that the source gives its target, rounded down, exactly; ranks that the points give beyond that are
  dropped, and the few they leave out follow at the end of the schedule.
* A source's documents are shuffled by a hash of their id, laid end to end and cut into blocks; a document lies in one or
  more blocks and is taken as often as slots take its parts, so at most ``MOST`` times.

The schedule is the order of the mix: a document comes where its first block does (``slots``, one entry per time the block is taken), and
``mixed`` lays out documents, and each repetition of one, in that order.

Sources are dealt over hash buckets for the token positions and over stretches for the ranks, so no task holds a source.
The driver sees one row per source; thus the number of sources must be moderate (it is a list of targets, not of data).
``block`` (tokens per slot) is a parameter and does not follow the size of the table.

Defined results: null text has size 0 and is taken 0 times; a null source is a source of its own, ordered last; rows that
repeat id, source and size are shared alike (the first ones take the remainder); without any token, targets are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import materialise, n_words_of, packed, running_start, shuffle_parts, unpacked

WEIGHTS = [5.0, 2.0, 1.0]
MOST = 3
BLOCK = 4096
STRETCH = 1 << 16


def targets(sizes: dict, weights: dict, most: float = MOST) -> dict:
    """Targets per source: ``weights`` shares of all tokens, none above ``most`` times its source's size."""
    total, fixed, left = float(sum(sizes.values())), {}, set(sizes)
    while left:
        room = total - math.fsum(fixed.values())
        weight = math.fsum(weights[s] for s in left)
        above = {s for s in left if room * weights[s] / weight > most * sizes[s]}
        if not above:
            return fixed | {s: room * weights[s] / weight for s in left}
        fixed |= {s: float(most * sizes[s]) for s in above}
        left -= above
    return fixed


def source_targets(sized: DataFrame, weights: list[float] | None = None, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size); sources by code point, null last, weigh ``weights`` in turn."""
    weights = weights or WEIGHTS
    spark = sized.sparkSession
    found = {r["source"]: int(r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    ordered = sorted(found, key=lambda s: (s is None, s))
    aims = targets(found, {s: weights[i % len(weights)] for i, s in enumerate(ordered)}, most)
    return spark.createDataFrame([(s, i, found[s], aims[s]) for i, s in enumerate(ordered)],
                                 "source string, number int, source_size long, target double")


def _reversed_bits(i: Column, bits: int) -> Column:
    """The first ``bits`` binary digits of ``i`` in reverse order: the van der Corput point of ``i`` times 2**bits."""
    return F.conv(F.reverse(F.lpad(F.bin(i), bits, "0")), 2, 10).cast("long") if bits else F.lit(0).cast("long")


def schedule(aims: DataFrame, block: int) -> DataFrame:
    """(slot, number, block_no, epoch, upto): which block each slot takes, and up to which token of it.

    ``slot`` orders the mix; slots left out by the points get numbers after all others.
    """
    spark = aims.sparkSession
    rows = [r for r in aims.collect() if r["source_size"] and math.floor(r["target"])]
    if not rows:
        return spark.createDataFrame([], "slot long, number int, block_no long, epoch long, upto long")
    per_source = {r["number"]: (r["source_size"], math.floor(r["target"])) for r in rows}

    def slots_of(size: int, take: int) -> int:
        return take // size * -(-size // block) + -(-(take % size) // block)

    counts = {n: slots_of(*x) for n, x in per_source.items()}
    slots = sum(counts.values())
    bits = max(1, (slots - 1).bit_length())
    stretch = F.shiftright("slot", STRETCH.bit_length() - 1)
    # Cumulative counts as limits on the points; each source's share of the schedule is its share of the slots.
    limits, at = [], 0
    for n in counts:
        at += counts[n]
        limits.append((at * (1 << bits) // slots, n))
    source = F.lit(limits[-1][1])
    for limit, n in reversed(limits[:-1]):
        source = F.when(F.col("point") < limit, F.lit(n)).otherwise(source)
    drawn = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", _reversed_bits(F.col("slot"), bits))
    drawn = drawn.select("slot", source.alias("number"), stretch.alias("stretch"))
    sums = drawn.groupBy("number", "stretch").agg(F.count(F.lit(1)).alias("s"))
    earlier = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("number", "stretch", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("number", "stretch").orderBy("slot")) - 1
    ranked = drawn.withColumn("local", local).join(offsets, ["number", "stretch"]).select(
        "slot", "number", (F.col("before") + F.col("local")).alias("rank"))
    facts = spark.createDataFrame([(n, s, t, counts[n], -(-s // block)) for n, (s, t) in per_source.items()],
                                  "number int, size long, take long, slots long, blocks long")
    got = ranked.groupBy("number").agg(F.count(F.lit(1)).alias("got"))
    missing = facts.join(got, "number", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < slots").select(
        "number", F.explode(F.sequence("got", F.col("slots") - 1)).alias("rank"))
    late = missing.select((F.lit(slots) + F.col("rank") * (len(counts) + 1) + F.col("number")).alias("slot"), "number", "rank")
    placed = ranked.union(late).join(F.broadcast(facts), "number").filter("rank < slots")  # facts: one row per source
    epoch = F.floor(F.col("rank") / F.col("blocks"))
    placed = placed.withColumn("epoch", epoch).withColumn("block_no", F.col("rank") - F.col("epoch") * F.col("blocks"))
    here = F.least(F.col("size"), F.col("take") - F.col("epoch") * F.col("size"))  # tokens of the stream this epoch gives
    return placed.select("slot", "number", "block_no", "epoch", F.least((F.col("block_no") + 1) * block, here).alias("upto"))


def mix(sized: DataFrame, aims: DataFrame, seed: int = 17, block: int = BLOCK) -> DataFrame:
    """``sized`` (doc_id, source, size) -> one row per input row: doc_id, source, size, source_size, target, taken, slots.

    ``slots``: where in the schedule the document's first block is taken, in order; null if it is not.
    """
    aims = F.broadcast(aims)  # one row per source
    units = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times"))
    units = units.join(aims, units["source"].eqNullSafe(aims["source"])).drop(aims["source"])
    units = units.withColumn("mass", F.col("size") * F.col("times"))
    hashed = F.xxhash64("doc_id", "size", F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))
    units = materialise(running_start(units, ["number"], [hashed, F.col("doc_id"), F.col("size")], "mass", "start"), "units")

    pieces = units.filter("mass > 0").select(
        "doc_id", "source", "size", "number", "start", "mass",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("mass") - 1) / block))).alias("block_no"))
    # Blocks are taken a few times each: fold the slots, keeping which take the block whole and how far the last one goes.
    end = F.least((F.col("block_no") + 1) * block, F.col("source_size"))
    slots = schedule(aims, block).join(aims.select("number", "source_size"), "number")
    slots = slots.groupBy("number", "block_no").agg(
        F.sum((F.col("upto") >= end).cast("long")).alias("whole"),
        F.max(F.when(F.col("upto") < end, F.col("upto"))).alias("partly"),
        F.array_sort(F.collect_list(F.struct("slot", "upto"))).alias("takers"))  # MOST + 1 at most
    low = F.greatest(F.col("start"), F.col("block_no") * block)
    high = F.least(F.col("start") + F.col("mass"), (F.col("block_no") + 1) * block)
    part = F.greatest(F.lit(0), F.least(F.coalesce("partly", F.lit(0)), high) - low)
    first = F.when(F.col("block_no") == F.floor(F.col("start") / block),
                   F.transform(F.filter("takers", lambda x: x["upto"] > F.col("start")), lambda x: x["slot"]))
    taken = pieces.join(slots, ["number", "block_no"]).groupBy("doc_id", "source", "size").agg(
        F.sum(F.col("whole") * (high - low) + part).alias("taken"), F.max(first).alias("slots"))
    taken = taken.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "size")], "taken", "slots")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "source", "size")]
    out = units.join(taken, same, "left").select(
        "doc_id", "source", "size", "source_size", "target", "times", F.coalesce("taken", F.lit(0)).alias("taken"),
        F.when(F.size("slots") > 0, F.col("slots")).alias("slots"))
    return _per_row(out).select(
        "doc_id", "source", "size", "source_size", "target", F.floor((F.col("taken") + F.col("times") - 1 - F.col("i")) / F.col("times")).alias("taken"), "slots")


def _per_row(units: DataFrame, chunk: int = 4096) -> DataFrame:
    """Rows numbered ``i`` below their ``times`` again. Very many repetitions of one row are dealt over tasks first."""
    few = units.filter(F.col("times") <= chunk).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    many = units.filter(F.col("times") > chunk).withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / chunk))))
    many = many.repartition("doc_id", "_c").withColumn(
        "i", F.explode(F.sequence(F.col("_c") * chunk, F.least((F.col("_c") + 1) * chunk, F.col("times")) - 1))).drop("_c")
    return few.unionByName(many)


def _sized(docs: DataFrame) -> DataFrame:
    return materialise(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words_of(F.col("text")).alias("size")), "sizes")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (tokens are words), first_slot (null for what is not taken)."""
    sized = _sized(docs)
    return mix(sized, source_targets(sized), **options).select(
        "doc_id", "size", "source_size", "target", "taken", F.get("slots", F.lit(0)).alias("first_slot"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, rounded, so not at all or up to ``MOST`` times, in the order
    of the schedule (files and rows; a repetition comes at its own slot).

    Documents stay whole (only one per source is taken in part). Documents without words are no part of a mix of words
    and are left as they are, before all others.
    """
    sized = _sized(docs)
    taken = mix(sized, source_targets(sized), **options)
    copies = taken.filter("size > 0").groupBy("doc_id", "source", "size").agg(
        F.max(F.round(F.col("taken") / F.col("size"))).cast("int").alias("copies"), F.max("slots").alias("slots")).toDF("_id", "_source", "_size", "copies", "slots")
    copies = copies.filter("copies > 0")
    rows = packed(docs).withColumn("size", n_words_of(F.col("row.text")))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & F.col("row.source").cast("string").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    none = F.lit(None).cast("long")
    empty = rows.filter("size = 0").select("row", none.alias("slot"))
    joined = rows.filter("size > 0").join(copies, same).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    at = F.coalesce(F.get("slots", F.col("copy")), F.get("slots", F.size("slots") - 1))
    laid = empty.union(joined.select("row", at.alias("slot")))
    parts = shuffle_parts(docs.sparkSession)
    return unpacked(laid.repartitionByRange(parts, "slot").sortWithinPartitions("slot"), docs)
