"""Prefix trie of conversations: which beginnings are shared, by how many, and what sharing them saves.

Every conversation is a sequence of turns; each distinct sequence of its first d turns is a node, the root has none. A prefix's key
is a polynomial hash (modulo 2^127 - 1) of its turns' digests, so keys of stretches can be put together: rows are laid out once
by a range sort of (conversation, place), every task chains the turns of its rows, and a conversation that is cut by a task's edge
goes on from the (length, hash) its earlier part ended with. One row per task is all that the driver sees of that.

A *count-min sketch* of all keys then screens them. An estimate is never too low, so estimate one proves that a prefix has a
single member, and so has all that follows in that conversation: such tails are nodes already and are emitted where they lie.
Only prefixes that may be shared are shuffled and grouped by key, with partial aggregation, so that the root, or a first
turn that a third of all conversations share, is one row per task. The sketch has four cells per prefix up to ``CELLS``
cells in each of its ``ROWS`` rows (a documented bound of 48 MB for what is collected and broadcast); beyond that it proves less,
more prefixes are grouped, and the result is the same.

Sums over subtrees need no walk down the tree. Each node has its smallest member for a name; the nodes that carry a conversation's name
are the end of its path. So leaves and savings of a name count for all earlier prefixes of that conversation, and one grouping by
key adds them up. Joins that would meet a hot key (a node with many children, a conversation with many turns) look the hot
keys up in a broadcast table, whose rows are counted (``common.looked_up``).
The members that end at a node are sorted by range, joined to blocks of numbers, and only the blocks of one node are
hashed in order.

Defined results: rows without conversation id belong to none and are left out; null role or text is empty; turns with the same number
follow each other by role, then by the digest of role and text, so repeated rows are repeated turns; an empty table gives an empty result;
other columns are ignored. Very long texts are read once, where they lie, and leave as a digest and a length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.ordered import ROWS_PER_PART, running_totals
from flowlake.llm.common import looked_up, materialise, shuffle_parts, text_of

PRIME = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D_9E3779B97F4A7C15 % PRIME
FAMILY = 100
CELLS = 1 << 24
ROWS = 3
BLOCK = 1 << 12
PER_SKETCH = 1 << 23
IDS = 1 << 15
ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()

CHAIN = "part int, i long, head boolean, opened boolean, c long, d long, x binary, px binary, n long, last boolean"
SCREENED = "c long, d long, x binary, px binary, n long, last boolean, alone boolean, palone boolean"


def _key(value: int) -> bytes:
    return value.to_bytes(16, "little")


def _number(key: bytes) -> int:
    return int.from_bytes(key, "little")


def own_turns(conversations: DataFrame) -> DataFrame:
    """c, pos (place of the turn, from 0), digest, n (code points of the text)."""
    role, text = text_of(F.col("role")), text_of(F.col("text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    slim = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"),
        F.length(text).cast("long").alias("n"), F.lit(1).alias("one"))
    placed = running_totals(slim, ["c"], ["turn", "role", "digest"], ["one"])
    return placed.select("c", F.col("one_before").alias("pos"), "digest", "n")


def borrowed(c: Column) -> Column:
    """How many turns a conversation takes from the first of its family of a hundred."""
    return F.crc32(c.cast("string")) % 6


def rebuilt(turns: DataFrame) -> DataFrame:
    """c, seg, pos, digest, n: per conversation a head row (seg -1), the turns it borrows (0) and those it keeps (1)."""
    heads = turns.filter("pos = 0").select("c", (F.col("c") - F.col("c") % FAMILY).alias("first"), borrowed(F.col("c")).alias("h"))
    base = turns.filter((F.col("c") % FAMILY == 0) & (F.col("pos") < 5)).select(F.col("c").alias("first"), "pos", "digest", "n")
    copied = heads.join(base, "first").filter("pos < h")  # at most 199 conversations and 5 turns a key
    row = lambda df, seg: df.select("c", F.lit(seg).alias("seg"), "pos", "digest", "n")
    head = heads.select("c", F.lit(-1).alias("seg"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"),
                        F.lit(0).cast("long").alias("n"))
    return head.union(row(copied, 0)).union(row(turns.filter(F.col("pos") >= borrowed(F.col("c"))), 1))


def as_they_are(turns: DataFrame) -> DataFrame:
    """The same columns for conversations that are not rebuilt."""
    heads = turns.filter("pos = 0").select("c", F.lit(-1).alias("seg"), F.lit(0).cast("long").alias("pos"),
                                           F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n"))
    return heads.union(turns.select("c", F.lit(1).alias("seg"), "pos", "digest", "n"))


def _chained_batch(rows):
    kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=[f.split()[0] for f in CHAIN.split(", ")])


def _chain(batches):
    """Depths and keys as far as this task sees. A row leaves once it is known whether its conversation goes on; the task's last does not know."""
    part = TaskContext.get().partitionId()
    i, c, d, x, opened, held, out = 0, None, 0, 0, False, None, []
    for batch in batches:
        for conv, digest, n in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            head, before = digest is None, x
            if head or conv != c:
                c, d, x, before, opened = conv, 0, 0, 0, head
            if not head:
                x, d = (x * BASE + _number(digest) + 1) % PRIME, d + 1
            if held:
                out.append((*held, head))
            held = (part, i, head, opened, c, d, _key(x), None if head else _key(before), n)
            i += 1
        if out:
            yield _chained_batch(out)
            out = []
    if held:
        yield _chained_batch([(*held, None)])


class Edges:
    """What crosses from task to task: the (length, hash) of a conversation that goes on, and whether a task's last row ends one."""

    def __init__(self, tasks):
        self.carry, self.ends = {}, {}
        length, value, before = 0, 0, None
        for e in sorted(tasks, key=lambda r: r["part"]):
            if not e["starts"]:
                self.carry[e["part"]] = (length, value)
                self.ends[before] = False
            before, end = e["part"], e["end"]
            if end["opened"]:
                length, value = end["d"], _number(end["x"])
            else:  # the whole task lies inside one conversation
                length, value = length + end["d"], (value * pow(BASE, end["d"], PRIME) + _number(end["x"])) % PRIME

    def finished(self, batch: pa.RecordBatch):
        """Columns c, d, x, px, n, last of chained rows, in the conversation's own terms."""
        part, _, _, opened, c, d, x, px, n, last = (batch.column(k).to_pylist() for k in range(10))
        for k in range(len(c)):
            if not opened[k]:
                length, value = self.carry[part[k]]
                x[k] = _key((value * pow(BASE, d[k], PRIME) + _number(x[k])) % PRIME)
                px[k] = _key((value * pow(BASE, d[k] - 1, PRIME) + _number(px[k])) % PRIME)
                d[k] += length
            if last[k] is None:
                last[k] = self.ends.get(part[k], True)
        return c, d, x, px, n, last


def chained(rows: DataFrame, parts: int | None = None) -> tuple[DataFrame, Edges]:
    """The laid-out rows with keys, and what crosses the edges of tasks."""
    parts = parts or max(shuffle_parts(rows.sparkSession), rows.count() // ROWS_PER_PART)
    laid = rows.select("c", "seg", "pos", "digest", "n").repartitionByRange(parts, "c", "seg", "pos").sortWithinPartitions("c", "seg", "pos")
    chain = materialise(laid.mapInArrow(_chain, CHAIN), "chain")
    # One row per task.
    tasks = chain.groupBy("part").agg(F.min_by("head", "i").alias("starts"), F.max_by(F.struct("opened", "d", "x"), "i").alias("end")).collect()
    return chain, Edges(tasks)


def _cells(keys: list[bytes], width: int) -> np.ndarray:
    """One cell per row of the sketch and key."""
    halves = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    mixed = (halves[:, 0] ^ (halves[:, 1] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    step = (halves[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
    shift = np.uint64(64 - (width.bit_length() - 1))
    return np.stack([((mixed + np.uint64(r) * step) >> shift).astype(np.int64) + r * width for r in range(ROWS)])


def sketch(chain: DataFrame, edges: Edges, rows: int) -> np.ndarray:
    """The merged count-min sketch; counts stop at two, which is all that matters."""
    width = 1 << max(12, min(CELLS, 4 * rows).bit_length() - 1)

    def run(batches):
        counts = np.zeros(ROWS * width, np.uint8)
        for batch in batches:
            keys = edges.finished(batch)[2]
            cell, times = np.unique(_cells(keys, width), return_counts=True) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            counts[cell] = np.minimum(2, counts[cell] + times)
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([blocks[b].tobytes() for b in used], pa.binary())], names=["block", "cells"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.uint8)
        for cells in table.column("cells").to_pylist():
            total = np.minimum(2, total + np.frombuffer(cells, np.uint8))
        return pa.table({"block": table.column("block").slice(0, 1), "cells": pa.array([total.tobytes()], pa.binary())})

    tasks = chain.coalesce(max(1, -(-rows // PER_SKETCH))).mapInArrow(run, "block long, cells binary")
    merged = tasks.groupBy("block").applyInArrow(merge, "block long, cells binary")
    whole = np.zeros((ROWS * width // BLOCK, BLOCK), np.uint8)
    for r in merged.collect():  # ROWS * width bytes at most
        whole[r["block"]] = np.frombuffer(r["cells"], np.uint8)
    return whole.reshape(ROWS, width)


def screened(chain: DataFrame, edges: Edges, rows: int) -> DataFrame:
    """Every prefix with whether it, and its parent, is proven to have one member."""
    counts = sketch(chain, edges, rows)
    width = counts.shape[1]
    shared = chain.sparkSession.sparkContext.broadcast(counts.reshape(-1))

    def run(batches):
        table = shared.value
        before, proven = None, False
        for batch in batches:
            c, d, x, px, n, last = edges.finished(batch)
            if not c:
                continue
            place = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            one = table[_cells(x, width)].min(axis=0) == 1
            above = table[_cells([p or ROOT for p in px], width)].min(axis=0) == 1
            alone, palone = [], []
            for k in range(len(c)):
                part, i = place[k]
                if d[k] == 0 or before != (part, i - 1):  # files are read in any order: only the very row before tells something
                    proven = False
                before = part, i
                palone.append(d[k] > 0 and (proven or bool(above[k])))
                proven = d[k] > 0 and (palone[-1] or bool(one[k]))
                alone.append(proven)
            arrays = [pa.array(v, t) for v, t in zip((c, d, x, px, n, last, alone, palone), (
                pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in SCREENED.split(", ")])

    return materialise(chain.mapInArrow(run, SCREENED), "screened")


def _blocks(batches):
    """Sorted (x, c) -> blocks of at most ``IDS`` numbers of one node, as text."""
    def row(x, ids):
        return (x, ids[0], ",".join(map(str, ids)))

    x, ids, out = None, [], []
    for batch in batches:
        for key, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (key != x or len(ids) >= IDS):
                out.append(row(x, ids))
                ids = []
            x = key
            ids.append(c)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*out)], names=["x", "c", "ids"])
            out = []
    if ids:
        out.append(row(x, ids))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*out)], names=["x", "c", "ids"])


def _digests(batches):
    """Sorted blocks -> one digest per node."""
    x, state, done = None, None, []
    for batch in batches:
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if key != x:
                if state:
                    done.append((x, state.hexdigest()))
                x, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done)], names=["x", "ends"])
            done = []
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()), pa.array([state.hexdigest()])], names=["x", "ends"])


def _ends(grouped: DataFrame) -> DataFrame:
    """x, ends: digest of the numbers of the conversations that end at a node."""
    members = grouped.filter("last").select("x", "c")
    sorted_ = members.repartitionByRange(shuffle_parts(members.sparkSession), "x", "c").sortWithinPartitions("x", "c")
    blocks = materialise(sorted_.mapInArrow(_blocks, "x binary, c long, ids string"), "end-blocks")
    parts = shuffle_parts(members.sparkSession)
    return blocks.repartition(parts, "x").sortWithinPartitions("x", "c").mapInArrow(_digests, "x binary, ends string")


def trie(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per node from (c, seg, pos, digest, n): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    chain, edges = chained(rows, parts)
    every = screened(chain, edges, chain.count())
    single = every.filter("alone")
    grouped = every.filter(~F.col("alone"))

    nodes = grouped.groupBy("x").agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("px").alias("px"),
                                     F.first("d").alias("depth"), F.first("n").alias("n"))
    nodes = materialise(nodes, "nodes")
    under = nodes.filter("px is not null").select("px").union(single.filter(~F.col("palone")).select("px"))
    kids = under.groupBy(F.col("px").alias("x")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(nodes.join(kids, "x", "left").fillna(0, ["n_children"]), "nodes")

    # What carries a conversation's name, for the prefixes of that conversation that carry another one.
    worth = nodes.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), ((F.col("n_convs") - 1) * F.col("n")).alias("w"),
                         (F.col("n_children") == 0).cast("long").alias("leaf"))
    chains = worth.groupBy("c").agg(F.sum("w").alias("w"), F.min("d").alias("named_from"), F.max("leaf").alias("leaf"))
    tails = single.filter("last").select("c", F.lit(0).cast("long").alias("w"), F.lit(None).cast("long").alias("named_from"), F.lit(1).cast("long").alias("leaf"))
    per_conv = chains.union(tails).groupBy("c").agg(F.sum("w").alias("w"), F.min("named_from").alias("named_from"), F.max("leaf").alias("leaf"))
    per_conv = materialise(per_conv.filter("w > 0 or leaf > 0"), "named")
    paths = looked_up(grouped.select("x", "c", "d"), ["c"], per_conv)
    sums = paths.groupBy("x").agg(F.sum("leaf").alias("n_leaves"), F.sum(F.when(F.col("d") < F.col("named_from"), F.col("w"))).alias("below"))
    along = running_totals(worth, ["c"], ["d"], ["w"]).select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), (F.col("w_total") - F.col("w_before")).alias("along"))

    names = nodes.select(F.col("x").alias("px"), F.col("conv_id").alias("parent"))
    seekers = nodes.select("px", "conv_id", "depth", F.col("x")).union(
        single.filter(~F.col("palone")).select("px", F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.lit(None).cast("binary").alias("x")))
    found = materialise(looked_up(seekers.filter("depth > 0"), ["px"], names).select(
        "x", "conv_id", "depth", F.coalesce("parent", "conv_id").alias("parent_conv_id")), "parents")

    whole = (
        nodes.drop("px").join(sums, "x", "left").join(_ends(grouped), "x", "left").join(along, ["conv_id", "depth"], "left")
        .join(found.filter("x is not null").select("x", "parent_conv_id"), "x", "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
                (F.coalesce("along", F.lit(0)) + F.coalesce("below", F.lit(0))).alias("saved_tokens"),
                F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))
    )
    own = found.filter("x is null").select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), "parent_conv_id")
    digest = F.when(F.col("last"), F.sha2(F.col("c").cast("string"), 256)).otherwise(NOTHING)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tail = lambda df, parent: df.select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), parent.alias("parent_conv_id"), one.alias("n_convs"),
        (~F.col("last")).cast("long").alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"), digest.alias("ends_sha256"))
    later = tail(single.filter("palone"), F.col("c"))
    firsts = tail(single.filter(~F.col("palone")).join(own, ["c", "d"], "left"), F.col("parent_conv_id"))
    return whole.union(later).union(firsts)


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(own_turns(conversations)))


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(as_they_are(own_turns(conversations)))
