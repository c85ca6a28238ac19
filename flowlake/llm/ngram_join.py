"""Similarity join of documents on the Jaccard measure of their word n-gram sets, exact, by size-banded tiles.

1. *Heads.* Each text becomes the sorted array of its distinct n-gram hashes (48 bits kept); written down are only its
   size and a digest of the set. Documents with equal sets are folded to one representative (smallest id).
2. *Pruning.* Of every set the first ``n - k + l`` hashes are posted, where k = ceil(t n) and l = 1 + k // ``PART``. Two linked
   sets share at least the larger one's ``l`` of them, so a set that shares fewer with other sets links to nothing. This
   removes most documents, also those of which up to half is a passage that many documents share. Postings travel packed,
   about half of all hashes; texts do not.
3. *Stars.* The arrays and bitmap signatures (``BITS`` bits) of what is left are built again from their texts. Sets that share
   some of their ``SMALLEST`` lowest hashes are compared with one such leader, those it does not link with a few others;
   verified links form components. A family of copies costs a few rows per member, never its pairs, and from here on
   only links between different components matter.
4. *Tiles.* Sets meet by posted hash; inside a tile they are sorted by size and a set is compared with the range of sizes
   up to 1 / t times its own: ``|A & B| <= (|A| + |B| - popcount(a xor b)) / 2`` from the bitmaps. A pair that passes
   is counted once per hash, and stays if it has ``l`` in common.
   A hash with over ``TILE`` sets is cut into size bands and blocks; pairs of blocks are tiles of their own.
5. Surviving pairs are verified by intersecting the sorted arrays; all verified links together give the components.

Nothing grows on the driver, and no step is skipped or cut at any size.

Defined results: null, empty and wordless texts have the empty set and link with nothing; with fewer than ``n`` words
the whole sequence is one gram. Rows with equal ``doc_id`` are each reported; their id's component joins all of them.
A null id is reported with its size and a null component. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import components, materialise, packed, shuffle_parts, unpacked

GRAM = 5
PERCENT = 75
BITS = 512
SMALLEST = 6
PART = 3
CHANCES = 3
TILE = 4096
TRIED = 1 << 17  # pairs of a tile whose bitmaps are compared at once, 64 bytes a side
HASH_BITS = 48
_MASK = np.uint64((1 << HASH_BITS) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word ``n``-grams of a text, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    starts = len(words) - k + 1
    out = np.full(starts, np.uint64(k), np.uint64)
    for i in range(k):
        out += one[i: starts + i] * _factors(n)[i]
    return _distinct(_mix(out))


@functools.cache
def _factors(n: int) -> np.ndarray:
    """One odd factor per place in a gram."""
    return _mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _kept(size: np.ndarray | int, percent: int):
    """Least overlap of a set of ``size`` with any set it links to."""
    return -(-size * percent // 100)


def _needed(size: int, percent: int) -> int:
    """l(size): so many posted hashes a set of ``size`` has in common at least with any set it links to.

    Post the first ``size - kept + l`` hashes. Two linked sets share at least ``kept`` of the larger one, so of the
    posted ones at least the larger one's l, provided that ``kept - l`` does not fall as sizes grow; as l follows ``kept``, it does not.
    """
    return 1 + _kept(size, percent) // PART


def _needed_column(size, percent: int):
    return 1 + F.floor(F.floor((size * percent + 99) / 100) / PART)


def _pack48(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _each(batches: Iterator[pa.RecordBatch], n: int, rows: int = 256):
    """Blocks of (ids, list of hash arrays); a block holds few documents because texts may be long."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.column(0).slice(at, rows), [gram_hashes(t.as_py(), n) for t in batch.column(1).slice(at, rows)]


def _digest(full: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(full.tobytes())


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _heads(batches, n: int):
    for ids, grams in _each(batches, n):
        digests = [_digest(g) for g in grams]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(g) for g in grams], pa.int64()), pa.array(digests, pa.binary()),
             pa.array([_key(d) for d in digests], pa.int64())], names=["doc_id", "n", "digest", "key"])


def _sets(batches, n: int):
    for ids, grams in _each(batches, n):
        smallest, packed, bits = [], [], []
        for full in grams:
            short = _distinct(full & _MASK)
            smallest.append(short[:SMALLEST].astype(np.int64))
            packed.append(_pack48(short))
            flags = np.zeros(BITS, np.uint8)
            flags[(short % np.uint64(BITS)).astype(np.int64)] = 1
            bits.append(np.packbits(flags).tobytes())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(g) // 6 for g in packed], pa.int64()), pa.array(smallest, pa.list_(pa.int64())),
             pa.array(packed, pa.binary()), pa.array(bits, pa.binary())],
            names=["doc_id", "n", "smallest", "grams", "bits"])


def _post(batches, n: int, percent: int, buckets: int):
    """Per block and bucket of hashes one row: the posted hashes and the keys of the sets they belong to.

    A task posts equal sets once.
    """
    seen: set[bytes] = set()
    for _, grams in _each(batches, n, 1024):
        hashes, owner = [], []
        for full in grams:
            digest = _digest(full)
            if not len(full) or digest in seen:
                continue
            seen.add(digest)
            size = len(full)
            own = _distinct(full & _MASK)[:size - _kept(size, percent) + _needed(size, percent)]
            hashes.append(own)
            owner.append(np.full(len(own), _key(digest), np.int64))
        if not hashes:
            continue
        hashes, owner = np.concatenate(hashes), np.concatenate(owner)
        bucket = (_mix(hashes) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        hashes, owner, bucket = hashes[order], owner[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        parts = list(zip(edges, np.append(edges[1:], len(bucket))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[edges], pa.int32()), pa.array([_pack48(hashes[s:e]) for s, e in parts], pa.binary()),
             pa.array([owner[s:e].tobytes() for s, e in parts], pa.binary())], names=["bucket", "hashes", "keys"])


def _shared_counts(table: pa.Table, parts: int) -> pa.Table:
    """One bucket: how many posted hashes each set shares with another set."""
    hashes = _unpack48(b"".join(table.column("hashes").to_pylist()))
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.int64)
    order = np.argsort(hashes, kind="stable")
    hashes, keys = hashes[order], keys[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    size = np.diff(np.append(first, len(hashes)))
    mixed = np.repeat(np.minimum.reduceat(keys, first) < np.maximum.reduceat(keys, first), size)
    posted = np.unique(np.stack([hashes[mixed].astype(np.int64), keys[mixed]]), axis=1)[1]  # copies from several tasks once
    chosen, counts = np.unique(posted, return_counts=True)
    return _dealt(np.stack([chosen, counts]), chosen, parts)


def _dealt(rows: np.ndarray, keys: np.ndarray, parts: int) -> pa.Table:
    """The columns of ``rows`` dealt over ``parts`` by key, one packed row each."""
    part = (_mix(keys.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, first = np.unique(part[order], return_index=True)
    packed_rows = [np.ascontiguousarray(x).tobytes() for x in np.split(rows[:, order], first[1:], axis=1)] if len(found) else []
    return pa.table({"part": pa.array(found, pa.int32()), "rows": pa.array(packed_rows, pa.binary())})


def _gathered(table: pa.Table, width: int) -> np.ndarray:
    return np.concatenate([np.empty((width, 0), np.int64), *(np.frombuffer(x, np.int64).reshape(width, -1) for x in table.column("rows").to_pylist())], axis=1)


def _summed(table: pa.Table) -> pa.Table:
    """One part: the counts of each key added up."""
    keys, counts = _gathered(table, 2)
    chosen, at = np.unique(keys, return_inverse=True)
    return pa.table({"key": chosen, "shared": np.bincount(at, counts, len(chosen)).astype(np.int64)})


def _enough(table: pa.Table, percent: int) -> pa.Table:
    """One part: the pairs that have at least l posted hashes in common."""
    a, b, larger, times = _gathered(table, 4)
    pairs, first, at = np.unique(np.stack([a, b]), axis=1, return_index=True, return_inverse=True)
    total, kept = np.bincount(at.ravel(), times, pairs.shape[1]), -(-larger[first] * percent // 100)
    ok = total >= 1 + kept // PART
    return pa.table({"a": pairs[0][ok], "b": pairs[1][ok]})


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that really link. Each side's array is fetched by a join, the arrays are intersected in batches."""
    arrays = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga"))
    both = pairs.join(arrays, "a").join(arrays.toDF("b", "gb"), "b").select("a", "b", "ga", "gb")

    def intersect(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = _unpack48(x.as_py()), _unpack48(y.as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(intersect, "a long, b long")


def _tile_pairs(table: pa.Table, percent: int, parts: int) -> pa.Table:
    """All tiles of one task: pairs of different components whose sizes and bitmaps allow a link.

    Rows are sorted by tile and size, so the partners of a row are one range: up to its size / t. The ranges are
    expanded in blocks of bounded length.
    """
    column = lambda c: table.column(c).to_numpy()
    order = np.lexsort((column("n"), column("q"), column("p"), column("tile"), column("h")))
    ids, comps, n, h, tile, p, q, own, home = (
        column(c)[order] for c in ("doc_id", "comp", "n", "h", "tile", "p", "q", "own", "home"))
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(ids), -1)[order]
    new = np.ones(len(ids), bool)
    new[1:] = (h[1:] != h[:-1]) | (tile[1:] != tile[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
    group = np.cumsum(new) - 1
    span = int(n.max()) * 100 // percent + 2 if len(n) else 1
    key = group * span + n
    last = np.searchsorted(key, group * span + n * 100 // percent, side="right")
    width = last - np.arange(len(ids)) - 1
    out, at = [np.empty((3, 0), np.int64)], 0
    ends = np.cumsum(width)
    while at < len(ids):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TRIED, side="right")))
        w = width[at:to]
        i = np.repeat(np.arange(at, to), w)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w)
        ok = (comps[i] != comps[j]) & (ids[i] != ids[j]) & ((own[i] != own[j]) | (p[i] == q[i])) & (home[i] | home[j])
        i, j = i[ok], j[ok]
        differ = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        most = (n[i] + n[j] - differ) // 2  # the overlap is no larger
        ok = 100 * most >= percent * (n[i] + n[j] - most)
        i, j = i[ok], j[ok]
        out.append(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), np.maximum(n[i], n[j])]))
        at = to
    pairs, times = np.unique(np.concatenate(out, axis=1), axis=1, return_counts=True)
    return _dealt(np.vstack([pairs, times]), pairs[0] * 31 + pairs[1], parts)


def _tiles(posted: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs among (doc_id, comp, n, h) with ``bits`` (doc_id, bits), tile by tile.

    A hash that up to ``TILE`` sets post is one tile. Beyond that its sets are tiled by size band (each set visits its own
    band and, as the smaller side, the next) and by pairs of blocks inside a band. Tiles are dealt over tasks by their key.
    """
    size = posted.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    met = materialise(posted.join(size.filter("lo < hi").select("h", "size"), "h"), "posted")
    # Once more: a set that shares too few hashes with other components is done.
    enough = met.groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("n")).filter(
        F.col("shared") >= _needed_column(F.col("n"), percent)).select("doc_id")
    met = met.join(bits.join(enough, "doc_id"), "doc_id")
    light = met.filter(F.col("size") <= TILE).select(
        "h", F.lit(0).alias("tile"), F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(0).alias("own"), F.lit(True).alias("home"),
        "doc_id", "comp", "n", "bits")
    band = (F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9) + 1).cast("int")
    visits = met.filter(F.col("size") > TILE).withColumn("band", band).withColumn("v", F.explode(F.array(
        F.struct(F.col("band").alias("tile"), F.lit(True).alias("home")),
        F.struct((F.col("band") + 1).alias("tile"), F.lit(False).alias("home")))))
    visits = visits.select("h", "v.tile", "v.home", "doc_id", "comp", "n", "bits")
    banded = visits.groupBy("h", "tile").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    heavy = visits.join(banded, ["h", "tile"]).withColumn("own", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
    heavy = heavy.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "h", "tile", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "home",
        "doc_id", "comp", "n", "bits")
    tiles = materialise(light.unionByName(heavy), "tiles")
    tasks = max(shuffle_parts(posted.sparkSession), tiles.count() // 100_000 + 1)
    found = tiles.withColumn("task", F.pmod(F.xxhash64("h", "tile", "p", "q"), F.lit(tasks))).groupBy("task").applyInArrow(
        lambda table: _tile_pairs(table, percent, tasks), "part int, rows binary")
    # Two linked sets share at least l posted hashes, each of which names the pair once.
    return found.groupBy("part").applyInArrow(lambda table: _enough(table, percent), "a long, b long")


def _stars(low: DataFrame) -> DataFrame:
    """One pair (a, b) to try per set: with the set that best stands for the groups it is in.

    ``low`` has the smallest hashes of every set. A set is as popular as all the groups of its hashes are large: the text
    from which a family was copied has every popular hash, its copies have lost some. Each group is led by its most popular
    set, and a set tries the leader it meets most often.
    """
    size = low.groupBy("h").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = materialise(low.join(size, "h"), "low-hashes")
    popular = met.groupBy("doc_id").agg(F.sum("size").alias("popular"))
    ranked = met.join(popular, "doc_id")
    leaders = ranked.groupBy("h").agg(F.max_by("doc_id", F.struct("popular", -F.col("doc_id"))).alias("b"), F.max("popular").alias("rank"))
    tries = met.join(leaders, "h").filter("b <> doc_id").groupBy(F.col("doc_id").alias("a"), "b").agg(
        F.count(F.lit(1)).alias("times"), F.max("rank").alias("rank"))
    return tries.groupBy("a").agg(F.max_by("b", F.struct("times", "rank", -F.col("b"))).alias("b"))


def _chances(low: DataFrame, open_low: DataFrame) -> DataFrame:
    """Pairs (a, b) of a set that its leader did not link with a few members of each of its groups, drawn by hash."""
    drawn = [F.max_by("doc_id", F.xxhash64("doc_id", F.lit(i))).alias(f"m{i}") for i in range(CHANCES)]
    members = low.groupBy("h").agg(F.count(F.lit(1)).alias("size"), *drawn).filter("size > 1")
    pairs = open_low.join(members, "h").select(F.col("doc_id").alias("a"), F.explode(F.array(*[f"m{i}" for i in range(CHANCES)])).alias("b"))
    return pairs.filter("a <> b").distinct()


def _best_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of all pairs of a set ``a`` the one whose bitmaps leave room for the greatest likeness, and an arbitrary one."""
    side = sets.select("doc_id", "n", "bits")
    both = pairs.join(side.toDF("a", "na", "xa"), "a").join(side.toDF("b", "nb", "xb"), "b").select("a", "b", "na", "nb", "xa", "xb")

    def bounds(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (4, 5))
            na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            most = (na + nb - np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)) / 2
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(most / (na + nb - most))], names=["a", "b", "bound"])

    best = both.mapInArrow(bounds, "a long, b long, bound double").groupBy("a").agg(
        F.max(F.struct("bound", "b")).alias("x"), F.max_by("b", F.struct(-F.xxhash64("b"))).alias("y"))
    return best.select("a", F.explode(F.array_distinct(F.array("x.b", "y"))).alias("b"))


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _prefix(batches, percent: int):
    for batch in batches:
        lists = []
        for data in batch.column(2):
            own = _unpack48(data.as_py())
            lists.append(own[:len(own) - _kept(len(own), percent) + _needed(len(own), percent)].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "n", "hs"])


def similar(docs: DataFrame, n: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, set_id (smallest id with an equal set)."""
    spark, docs = docs.sparkSession, _slim(docs)
    heads = materialise(docs.mapInArrow(lambda it: _heads(it, n), "doc_id long, n long, digest binary, key long"), "heads")
    named = heads.filter("n > 0 and doc_id is not null")
    same = materialise(
        named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("key").alias("key")), "same-sets")
    belongs = named.select("doc_id", "digest").join(same.select("digest", "rep"), "digest").select("doc_id", "rep").distinct()
    belongs = materialise(belongs, "members")

    hashes = same.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_parts(spark), hashes // 1_500_000 + 1)  # about half a million postings each
    counted = (
        docs.filter("doc_id is not null")
        .mapInArrow(lambda it: _post(it, n, percent, buckets), "bucket int, hashes binary, keys binary")
        .groupBy("bucket").applyInArrow(lambda table: _shared_counts(table, buckets), "part int, rows binary")
        .groupBy("part").applyInArrow(_summed, "key long, shared long")
    )
    open_sets = materialise(
        same.join(counted, "key").filter(F.col("shared") >= _needed_column(F.col("n"), percent)).select(F.col("rep").alias("doc_id")).distinct(), "open")
    left = docs.join(open_sets, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    left = materialise(left.select("doc_id", "text").mapInArrow(
        lambda it: _sets(it, n), "doc_id long, n long, smallest array<long>, grams binary, bits binary"), "open-sets").filter("n > 0")

    low = left.select("doc_id", F.explode("smallest").alias("h")).distinct()
    first = materialise(_verified(_stars(low), left, percent), "star-links")
    linked = materialise(first.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "linked")
    more = _best_of(_chances(low, low.join(linked, "doc_id", "left_anti")), left)
    first = materialise(first.union(_verified(more, left, percent)), "star-links")

    comp = components(first).withColumnRenamed("node", "doc_id")
    posted = left.select("doc_id", "n", "grams").mapInArrow(lambda it: _prefix(it, percent), "doc_id long, n long, hs array<long>")
    placed = posted.join(comp, "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("comp"), "n", F.explode("hs").alias("h"))
    pairs = _tiles(placed, left.select("doc_id", "bits"), percent)
    second = _verified(materialise(pairs, "candidates"), left, percent)

    own = belongs.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = components(materialise(first.union(second).union(own), "links"))
    names = belongs.groupBy("doc_id").agg(F.min("rep").alias("set_id"))
    return (
        heads.select("doc_id", F.col("n").alias("n_shingles"))
        .join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(names, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"), F.coalesce("set_id", "doc_id").alias("set_id"))
    )


def keep_one(docs: DataFrame, n: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of similar documents: the smallest ``doc_id``.

    Rows that repeat an id are one document: the first text (by order) stays. Rows without an id stay.
    """
    found = similar(docs.select("doc_id", "text"), n, percent)
    gone = materialise(found.filter("component_id <> doc_id").select("doc_id").distinct(), "dropped")
    rows = packed(docs).withColumn("doc_id", F.col("row.doc_id"))
    kept = rows.join(gone, "doc_id", "left_anti")
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("doc_id")
    repeated = materialise(repeated, "repeated")
    if not repeated.isEmpty():
        first = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.min_by("row", F.coalesce(F.col("row.text"), F.lit(""))).alias("row"))
        kept = kept.join(repeated, "doc_id", "left_anti").select("row").union(first.select("row"))
    return unpacked(kept, docs)
