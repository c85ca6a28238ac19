"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is taken as the multiset of its paragraphs: lines, cut further after marks that end a clause, so that texts of one
line have paragraphs too. Each paragraph (with its occurrence number) has a 64-bit digest, which is added to three cells
of the sketch; a cell holds a count, the sum of digests and the sum of check values. Subtracting two sketches leaves the
paragraphs in which the texts differ, and peeling (a cell that holds one digest gives it away, which frees others) recovers
their digests. If peeling gets stuck, both sketches are built again four times as large, until it succeeds or a cell
is kept for every paragraph twice over, where the digests are compared themselves.

The *published* fingerprint is the number of paragraphs, the smallest sketch, and odd sketches of the digests. An odd sketch is a row of
bits, one flipped per digest; those of two texts, combined by exclusive or, are that of the paragraphs in which the texts differ, and the share
of set bits tells how many there are. Level l holds a 4^-l sample of the digests, so any number is measured by a level that is neither empty nor
full. Likeness of two fingerprints is common paragraphs / all paragraphs (as multisets), 1 for two empty texts, from what is
published alone: exact if the small sketches' difference peels, else from the odd sketches, then with a standard error of about
0.03. Equal texts have equal fingerprints. ``likeness`` of digest sets, by larger and larger sketches, is exact.

Versions come from the neighbour in descending id order. The table is cut into ranges of ids of about equal counts; each
row goes to its range, and the last row of each range also to the next one, so every task sees each row next to its neighbour:
one exchange of the texts, and one extra row per range.

Defined results: null text is empty; rows that repeat an id are ordered by their text; null ids come first in ascending
order; a table of one row has itself as the next document; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import materialise, shuffle_parts

CELLS = 12
PLACES = 3
GROWTH = 4
PARAGRAPH = re.compile(r"[^\n.,;:!?|]*[\n.,;:!?|]+|[^\n.,;:!?|]+").findall
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def digests(text: str) -> np.ndarray:
    """Sorted digests of a text's paragraphs; repeated paragraphs count separately."""
    found = [p for p in map(str.strip, PARAGRAPH(text)) if p]
    if not found:
        return np.empty(0, np.uint64)
    one = np.sort(np.fromiter((xxhash.xxh3_64_intdigest(p) for p in found), np.uint64, len(found)))
    first = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]]))
    if len(first) == len(one):
        return one
    times = np.arange(len(one)) - np.repeat(first, np.diff(np.append(first, len(one))))
    return np.sort(_mix(one + times.astype(np.uint64) * _ODD[0]) * (times > 0) + one * (times == 0))


class Sketches:
    """Sketches of several texts at once: arrays of shape (texts, cells)."""

    def __init__(self, cells: int, count: np.ndarray, keys: np.ndarray, checks: np.ndarray):
        self.cells, self.count, self.keys, self.checks = cells, count, keys, checks

    @staticmethod
    def places(keys: np.ndarray, cells: int) -> list[np.ndarray]:
        """One cell in each third of the sketch."""
        third = cells // PLACES
        return [(_mix(keys * odd) % np.uint64(third)).astype(np.int64) + i * third for i, odd in enumerate(_ODD)]

    @classmethod
    def of(cls, sets: list[np.ndarray], cells: int) -> Sketches:
        empty = cls(cells, np.zeros((len(sets), cells), np.int64), np.zeros((len(sets), cells), np.uint64), np.zeros((len(sets), cells), np.uint64))
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        keys = np.concatenate([*sets, np.empty(0, np.uint64)])
        empty._add(rows, keys, np.ones(len(keys), np.int64))
        return empty

    def _add(self, rows: np.ndarray, keys: np.ndarray, signs: np.ndarray) -> None:
        signed = signs.astype(np.uint64)  # sums wrap, so -1 is its complement
        checks = _mix(keys + _ODD[1])
        for place in self.places(keys, self.cells):
            at = rows * self.cells + place
            np.add.at(self.count.reshape(-1), at, signs)
            np.add.at(self.keys.reshape(-1), at, keys * signed)
            np.add.at(self.checks.reshape(-1), at, checks * signed)

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.cells, self.count - other.count, self.keys - other.keys, self.checks - other.checks)

    def peel(self, kept: int = (1 << 64) - 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(rows, keys, signs) of what was recovered, and which rows were recovered in full. ``kept``: the bits of the check sums that are known."""
        kept = np.uint64(kept)
        rows, keys, signs = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        while True:
            row, cell = np.nonzero(np.abs(self.count) == 1)
            sign = self.count[row, cell]
            key = self.keys[row, cell] * sign.astype(np.uint64)
            pure = (_mix(key + _ODD[1]) * sign.astype(np.uint64)) & kept == self.checks[row, cell] & kept
            row, key, sign = row[pure], key[pure], sign[pure]
            if not len(row):
                break
            order = np.lexsort((key, row))
            row, key, sign = row[order], key[order], sign[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])
            row, key, sign = row[new], key[new], sign[new]
            self._add(row, key, -sign)
            rows.append(row)
            keys.append(key)
            signs.append(sign)
        clean = ~(self.count.any(axis=1) | self.keys.any(axis=1) | (self.checks & kept).any(axis=1))
        return np.concatenate(rows), np.concatenate(keys), np.concatenate(signs), clean


def differences(one: list[np.ndarray], two: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pair of digest sets: what only the first has, and what only the second has, by peeling."""
    out: list = [None] * len(one)
    left = list(range(len(one)))
    while left:
        giant = [i for i in left if cells >= 2 * PLACES * (len(one[i]) + len(two[i])) + PLACES * 8]
        for i in giant:  # a sketch this large would hold more than the sets themselves
            out[i] = (np.setdiff1d(one[i], two[i], assume_unique=True), np.setdiff1d(two[i], one[i], assume_unique=True))
        left = [i for i in left if out[i] is None]
        stuck = []
        step = max(1, (1 << 18) // cells)  # a block of sketches stays small however large they are
        for at in range(0, len(left), step):
            part = left[at: at + step]
            gone = Sketches.of([one[i] for i in part], cells).minus(Sketches.of([two[i] for i in part], cells))
            rows, keys, signs, clean = gone.peel()
            order = np.argsort(rows, kind="stable")
            rows, keys, signs = rows[order], keys[order], signs[order]
            edges = np.searchsorted(rows, np.arange(len(part) + 1))
            for k, i in enumerate(part):
                if clean[k]:
                    own, sign = keys[edges[k]: edges[k + 1]], signs[edges[k]: edges[k + 1]]
                    out[i] = (own[sign > 0], own[sign < 0])
                else:
                    stuck.append(i)
        left, cells = stuck, cells * GROWTH
    return out


ODD_BITS = 512
LEVELS = 6
FULL = 0.4  # share of set bits up to which a level is read


def odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Bits (texts, levels, ODD_BITS): each digest flips one bit on every level that samples it."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keys = _mix(np.concatenate([*sets, np.empty(0, np.uint64)]) * _ODD[2])
    bits = (keys % np.uint64(ODD_BITS)).astype(np.int64)
    out = np.zeros((len(sets), LEVELS, ODD_BITS), np.uint8)
    for level in range(LEVELS):
        in_sample = keys >> np.uint64(64 - 2 * level) == 0 if level else np.ones(len(keys), bool)
        counts = np.bincount(rows[in_sample] * ODD_BITS + bits[in_sample], minlength=len(sets) * ODD_BITS)
        out[:, level] = (counts & 1).reshape(len(sets), ODD_BITS)
    return out


class Published:
    """What the fingerprints of several texts hold: numbers of paragraphs, small sketches, odd sketches."""

    def __init__(self, sizes: np.ndarray, cells: Sketches, odd: np.ndarray):
        self.sizes, self.cells, self.odd = sizes, cells, odd

    @classmethod
    def of(cls, sets: list[np.ndarray], cells: int = CELLS) -> Published:
        small = Sketches.of(sets, cells)
        small.checks &= np.uint64(0xFFFFFFFF)
        return cls(np.array([len(s) for s in sets], np.int64), small, odd_sketches(sets))

    def text(self) -> list[str]:
        """One printable fingerprint per text: its size, counts, digest sums, 32 bits of the check sums, odd sketches."""
        small = self.cells
        parts = [self.sizes[:, None].astype("<u4"), small.count.astype("<i4"), small.keys.astype("<u8"), small.checks.astype("<u4"),
                 np.packbits(self.odd.reshape(len(self.sizes), LEVELS * ODD_BITS), axis=1)]
        return [base64.b64encode(b"".join(p[i].tobytes() for p in parts)).decode() for i in range(len(self.sizes))]

    @classmethod
    def parse(cls, texts: list[str]) -> Published:
        raw = [base64.b64decode(t) for t in texts]
        odd = LEVELS * ODD_BITS // 8
        cells = (len(raw[0]) - 4 - odd) // 16
        cut = lambda at, size, kind: np.frombuffer(b"".join(r[at: at + size] for r in raw), kind).reshape(len(raw), -1)
        small = Sketches(cells, cut(4, 4 * cells, "<i4").astype(np.int64), cut(4 + 4 * cells, 8 * cells, "<u8").astype(np.uint64),
                         cut(4 + 12 * cells, 4 * cells, "<u4").astype(np.uint64))
        bits = np.unpackbits(cut(4 + 16 * cells, odd, np.uint8), axis=1).reshape(len(raw), LEVELS, ODD_BITS)
        return cls(cut(0, 4, "<u4")[:, 0].astype(np.int64), small, bits)

    def differing(self, other: Published) -> np.ndarray:
        """How many paragraphs only one of the two texts has, per pair."""
        set_bits = (self.odd ^ other.odd).sum(axis=2) / ODD_BITS
        level = np.argmax(set_bits <= FULL, axis=1)
        level[(set_bits > FULL).all(axis=1)] = LEVELS - 1
        share = np.minimum(set_bits[np.arange(len(level)), level], 0.499)
        guess = -ODD_BITS / 2 * np.log1p(-2 * share) * 4.0 ** level
        gone = self.cells.minus(other.cells)
        rows, _, _, clean = gone.peel(0xFFFFFFFF)
        exact = np.bincount(rows, minlength=len(level))
        return np.clip(np.where(clean, exact, guess), np.abs(self.sizes - other.sizes), self.sizes + other.sizes)

    def likeness(self, other: Published) -> np.ndarray:
        every = self.sizes + other.sizes
        differ = self.differing(other)
        return np.where(every > 0, (every - differ) / np.maximum(every + differ, 1), 1.0)


def likeness(one: list[np.ndarray], two: list[np.ndarray], cells: int = CELLS) -> list[float]:
    near = []
    for a, b, (x, y) in zip(one, two, differences(one, two, cells)):
        every = len(a) + len(y)
        near.append((len(a) - len(x)) / every if every else 1.0)
    return near


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


REPORT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
          "n_paragraphs long, n_changed long")


def _report(rows: list[tuple[int, str, str]], cells: int) -> pa.RecordBatch:
    new = [edited(text, following) for _, text, following in rows]
    own, changed, other = [digests(t) for _, t, _ in rows], [digests(t) for t in new], [digests(t) for _, _, t in rows]
    prints, new_prints = Published.of(own, cells), Published.of(changed, cells)
    parts = differences(own, changed, cells)
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
        pa.array(prints.text(), pa.string()), pa.array(new_prints.text(), pa.string()),
        pa.array(prints.likeness(new_prints), pa.float64()), pa.array(prints.likeness(Published.of(other, cells)), pa.float64()),
        pa.array([len(a) for a in own], pa.int64()), pa.array([len(x) + len(y) for x, y in parts], pa.int64()),
    ], names=[c.split()[0] for c in REPORT.split(", ")])


def _walk(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range and id; the row before a row (in its range) is its next document."""
    before, held, size = None, [], 0
    for batch in batches:
        for part, doc_id, halo, text in zip(*(batch.column(i) for i in range(4))):
            part, halo, text = part.as_py(), halo.as_py(), text.as_py()
            if not halo:
                assert before is not None and before[0] == part, "a range begins with the last row of the one before"
                held.append((doc_id.as_py(), text, before[1]))
                size += len(text)
                if size > 1 << 20 or len(held) >= 512:
                    yield _report(held, cells)
                    held, size = [], 0
            before = (part, text)
    if held:
        yield _report(held, cells)


def fingerprint_report(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints and both likenesses, paragraphs and how many the edit changed."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = materialise(slim.select("doc_id", F.xxhash64("text").alias("tie")), "ids")
    rows = ids.count()
    if not rows:
        return spark.createDataFrame([], REPORT)
    # One row per range: what a range ends with is the first row of the next one.
    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    parts = shuffle_parts(spark)
    ranged = materialise(ids.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    tops = ranged.groupBy("part").agg(F.max_by(F.struct("doc_id", "tie"), F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")).alias("top"),
                                      F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    ends = [(r["top"]["doc_id"], r["top"]["tie"]) for r in tops]
    sent = _dealt(slim.withColumn("tie", F.xxhash64("text")), ends)
    sent = sent.repartitionByRange(len(ends), "part").sortWithinPartitions("part", F.desc("halo"), *order)
    return sent.select("part", "doc_id", "halo", "text").mapInArrow(lambda it: _walk(it, cells), REPORT)


def _dealt(rows: DataFrame, ends: list[tuple[int | None, int]]) -> DataFrame:
    """``rows`` (doc_id, tie, text) with the number of their range, and once more, as ``halo``, for the range that follows the one they end."""
    bounds = F.array(*[F.struct(F.lit(d is not None).alias("known"), F.lit(d or 0).cast("long").alias("id"), F.lit(t).cast("long").alias("tie")) for d, t in ends])
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.col("tie").alias("tie"))
    part = F.least(F.size(F.filter(bounds, lambda b: b < F.col("_key"))), F.lit(len(ends) - 1))
    is_end = F.get(bounds, F.col("_part")) == F.col("_key")
    copies = F.filter(F.array(
        F.struct(F.col("_part").alias("part"), F.lit(False).alias("halo")),
        F.when(is_end, F.struct(((F.col("_part") + 1) % len(ends)).alias("part"), F.lit(True).alias("halo")))), lambda x: x.isNotNull())
    placed = rows.withColumn("_key", key).withColumn("_part", part)
    return placed.select("doc_id", "tie", "text", F.explode(copies).alias("to")).select("to.part", "doc_id", "to.halo", "text", "tie")
