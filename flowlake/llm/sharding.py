"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a 192-bit key: a hash of the text, then of the id, then the row number. The exact bytes below candidate
boundaries are counted over all partitions and the boundaries next to each shard's goal are refined, digit by digit
of the key, until a boundary is within ``tolerance`` of its goal. Boundaries between texts are preferred: a group of
equal texts is cut only where keeping it whole would miss the goal by more than ``group_tolerance`` of a shard. Then rows
are exchanged once, by shard and block. Every count is one grouped sum with at most (shards - 1) * 256 result rows,
which is all the driver sees, whatever the number of rows; a group of copies may span any number of shards and tasks.

The law is ``bytes``: sizes are near equal, and how near is limited only by the documents next to a boundary.

Defined results: null text counts as empty; rows that repeat are ordered by a row number written once; a null id is hashed
like any id; an empty table gives an empty result; with fewer documents than shards some shards stay empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import materialise, text_of

SHARDS = 40
TOLERANCE = 0.002
GROUP_TOLERANCE = 0.02
DIGIT = 8
FIRST_DIGIT = 12
KEYS = ["k1", "k2", "k3"]
BITS = 64


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _at_least(values: tuple[int, ...]) -> Column:
    """Whether the row's key is at or above ``values`` (unsigned 64-bit parts, in order)."""
    flip = lambda x: _signed(x ^ (1 << (BITS - 1)))  # noqa: E731  compares unsigned as signed
    out = F.lit(True)
    for name, value in reversed(list(zip(KEYS, values))):
        part = F.col(name).bitwiseXOR(F.lit(_signed(1 << (BITS - 1))))
        bound = F.lit(flip(value))
        out = (part > bound) | ((part == bound) & out)
    return out


def _inside(prefix: int, bits: int) -> Column:
    """Whether the first ``bits`` bits of the row's key are ``prefix``."""
    tests, left = [], bits
    for i, name in enumerate(KEYS):
        take = min(BITS, left)
        if take <= 0:
            break
        part = (prefix >> (left - take)) & ((1 << take) - 1)
        tests.append(F.shiftrightunsigned(name, BITS - take) == F.lit(_signed(part) if take == BITS else part))
        left -= take
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _digit(bits: int, width: int) -> Column:
    """The ``width`` bits of the key after the first ``bits``; a digit never crosses two key parts."""
    name, within = KEYS[bits // BITS], bits % BITS
    return F.shiftrightunsigned(F.shiftleft(name, within), BITS - width)


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE, group_tolerance: float = GROUP_TOLERANCE) -> list[tuple[int, ...]]:
    """The ``shards - 1`` lower boundaries of shards 1, 2, .. over rows (size, k1, k2, k3)."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    whole = len(KEYS) * BITS
    # A goal's state: the key prefix it lies in, how long that is, the bytes below the prefix, the best boundary so far.
    goals = {s: {"goal": total * s / shards, "prefix": 0, "bits": 0, "below": 0, "best": (float(total * s / shards), 0)} for s in range(1, shards)}
    open_goals = dict(goals) if total else {}
    while open_goals:
        places = sorted({(g["bits"], g["prefix"]) for g in open_goals.values()})
        number = F.lit(None).cast("int")
        digit = F.lit(None).cast("long")
        for i, (bits, prefix) in enumerate(places):
            width = min(FIRST_DIGIT if not bits else DIGIT, BITS - bits % BITS)
            inside = _inside(prefix, bits)
            number = F.when(inside, F.lit(i)).otherwise(number)
            digit = F.when(inside, _digit(bits, width)).otherwise(digit)
        counted = keyed.select(number.alias("place"), digit.alias("digit"), "size").filter("place is not null").groupBy("place", "digit").agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        cells: dict[int, list[tuple[int, int, int]]] = {}
        for r in counted.collect():  # at most (shards - 1) * 256 rows, in the first round 4096
            cells.setdefault(r["place"], []).append((r["digit"], r["bytes"], r["rows"]))
        for s, g in list(open_goals.items()):
            bits, prefix = g["bits"], g["prefix"]
            width = min(FIRST_DIGIT if not bits else DIGIT, BITS - bits % BITS)
            at = g["below"]
            for value, size, rows in sorted(cells.get(places.index((bits, prefix)), [])):
                low, high = (prefix << width) | value, (prefix << width) + value + 1
                g["best"] = min(g["best"], (abs(at - g["goal"]), low << (whole - bits - width)),
                                (abs(at + size - g["goal"]), high << (whole - bits - width)))
                if at <= g["goal"] < at + size:
                    g |= {"prefix": low, "bits": bits + width, "below": at, "rows": rows}
                    break
                at += size
            else:
                del open_goals[s]
                continue
            near = group_tolerance if g["bits"] >= BITS else tolerance  # after 64 bits all that is left is one text's group
            if g["best"][0] <= near * total / shards or g["rows"] == 1 or g["bits"] >= whole:
                del open_goals[s]
    mask = (1 << BITS) - 1
    keys = [min(g["best"][1], (1 << whole) - 1) for g in goals.values()]
    return [tuple((k >> (BITS * (len(KEYS) - 1 - i))) & mask for i in range(len(KEYS))) for k in keys]


def shard_rows(keyed: DataFrame, shards: int = SHARDS, rows_per_block: int = 100_000, **options) -> DataFrame:
    """``keyed`` (size, k1, k2, k3, any others) plus ``shard`` and ``slot``, exchanged once.

    A shard's rows lie in blocks of bounded size (by a hash of the key); a slot is the rank in the block plus the rows
    of the shard's earlier blocks.
    """
    bounds = splitters(keyed, shards, **options)
    shard = reduce(lambda a, b: a + b, [_at_least(b).cast("int") for b in bounds], F.lit(0))
    blocks = max(1, keyed.count() // (shards * rows_per_block) + 1)
    placed = keyed.withColumn("shard", shard).withColumn("_block", F.pmod(F.xxhash64(*KEYS), F.lit(blocks)))
    counts = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("_os"), F.col("_block").alias("_ob"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*KEYS)) - 1
    ranked = placed.withColumn("_rank", rank)
    return ranked.join(offsets, (F.col("shard") == F.col("_os")) & (F.col("_block") == F.col("_ob"))).withColumn(
        "slot", F.col("_before") + F.col("_rank")).drop("_block", "_os", "_ob", "_before", "_rank")


def shard_report(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is not ``key``)."""
    text = text_of(F.col("text"))
    keyed = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("k1"), F.xxhash64("doc_id").alias("k2"), F.monotonically_increasing_id().alias("k3"))
    placed = shard_rows(materialise(keyed, "keyed"), shards, **options)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
