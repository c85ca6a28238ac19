"""Periodic runs of words: all maximal stretches that repeat with a period, by internal pattern matching.

A run of smallest period q and length 2q or more holds, in its first q words, an aligned *dyadic block* of 2^k words (k is
the largest with 2^(k+1) - 1 <= q; blocks of two words serve all q below 7), and the block occurs again q words on. So, for
every aligned block, its occurrences in the neighbouring window of starts are asked for, 2^k starts at a time:

* prefix doubling ranks all stretches of 2^k words, level by level, and ends in the suffix array; a block's occurrences are
  one range of that array, known the moment its level is ranked;
* a wavelet matrix over the suffix array answers range successor: the smallest position >= x inside a range of the array;
* occurrences that start within one block length of each other are an arithmetic progression. Its first, second and last
  members are candidate periods; of three or more, the rest is settled by the maximal stretches [a, b) and [a', b') of the
  block's own period around the block and around the progression: a run's period is b' - b or a' - a, or the two stretches
  touch and every member short enough to fit is one; if they are the same stretch, none is.

Candidates are checked by longest common extensions on the ranks, to both sides, so a result never rests on the search alone.
Equal stretches keep their smallest period.

Documents never leave their task: texts are read once, a record batch is cut into chunks of about ``WORDS`` words (a longer
document is a chunk of its own), and numpy works on a whole chunk at a time. Memory per chunk is a few dozen bytes per word
and level. There is no shuffle, and a lost executor costs the batches it held.

Defined results: null and empty texts have no words and no run; a null id is carried along and its text is not rewritten by
``cycled``; repeated rows are answered each; ties of the longest run go to the smaller start, then the smaller period; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18
SHORTEST = 12

RUNS = "doc_id long, start long, length long, period long"
REPORT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


class Ladder:
    """Ranks of all stretches of 2^k words in texts laid end to end, and the suffix array they end in.

    ``ranks[k][i]`` is the first place, in the suffix array, of those that begin with the same 2^k words as i. A stretch that
    would reach over the end of its text is like no other.
    """

    def __init__(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        n = len(keys)
        self.starts, self.ends = starts, ends  # per position: where its text starts and ends
        order = np.argsort(keys, kind="stable")
        first = np.r_[True, keys[order][1:] != keys[order][:-1]] if n else np.zeros(0, bool)
        rank = np.full(n + 1, -1, np.int32)
        rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
        self.ranks, self.blocks = [rank], []
        slots = self._shared(first, np.arange(n))
        half, self.places, self.sorted = 1, None, order
        while len(slots):
            inside = order[slots]
            nexts = inside + half
            beyond = np.where(nexts < ends[inside], rank[np.minimum(nexts, n)], -1).astype(np.int64)
            key = rank[inside].astype(np.int64) * (n + 1) + beyond + 1
            by = np.argsort(key, kind="stable")
            order[slots] = inside[by]
            key = key[by]
            first = np.r_[True, key[1:] != key[:-1]]
            rank = rank.copy()
            rank[order[slots]] = slots[np.flatnonzero(first)][np.cumsum(first) - 1]
            half *= 2
            self.ranks.append(rank)
            slots = self._shared(first, slots)
            if self.places is None:
                self.places = slots  # no later block lies outside
            self.blocks.append(self._aligned(order, slots, half))

    @staticmethod
    def _shared(first: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """The slots whose group has two members or more."""
        alone = first & np.r_[first[1:], True] if len(first) else first
        return slots[~alone]

    def _aligned(self, order, slots, size):
        """(size, block starts, first and last slot of their groups, as places in ``places``)."""
        rank = self.ranks[-1]
        members = order[slots]
        group = rank[members]
        left, count = np.unique(group, return_counts=True)
        aligned = (members - self.starts[members]) % size == 0
        at = np.searchsorted(left, group[aligned])
        begin = np.searchsorted(self.places, left)
        return size, members[aligned], begin[at], begin[at] + count[at]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are the same from i and from j on (i < j, same text)."""
        i, j = i.copy(), j.copy()
        began = i.copy()
        last = len(self.ranks[0]) - 1
        for k in reversed(range(len(self.ranks))):
            rank = self.ranks[k]
            same = (rank[np.minimum(i, last)] == rank[np.minimum(j, last)]) & (j < last)
            i += same << k
            j += same << k
        return i - began

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are the same before i and before j (i < j, same text)."""
        i, j = i.copy(), j.copy()
        began, floor = i.copy(), self.starts[i]
        for k in reversed(range(len(self.ranks))):
            rank, step = self.ranks[k], 1 << k
            room = i - step >= floor
            same = room & (rank[np.where(room, i - step, 0)] == rank[np.where(room, j - step, 1)])
            i -= same << k
            j -= same << k
        return began - i


class WaveletMatrix:
    """Range successor and predecessor over a sequence of small numbers, for many queries at a time."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for bit in reversed(range(self.bits)):
            zero = (values >> bit) & 1 == 0
            self.zeros.append(np.r_[0, np.cumsum(zero)])
            values = np.r_[values[zero], values[~zero]]

    def below(self, left, right, x):
        """How many of [left, right) are smaller than x."""
        left, right, count = left.copy(), right.copy(), np.zeros(len(x), np.int64)
        over = x >= 1 << self.bits
        whole = right - left
        for zeros, bit in zip(self.zeros, reversed(range(self.bits))):
            one = (x >> bit) & 1 == 1
            l0, r0 = zeros[left], zeros[right]
            count += np.where(one, r0 - l0, 0)
            left = np.where(one, zeros[-1] + left - l0, l0)
            right = np.where(one, zeros[-1] + right - r0, r0)
        return np.where(over, whole, count)

    def nth(self, left, right, nth):
        """The nth smallest (from 0) of [left, right); nth has to be inside."""
        left, right, nth = left.copy(), right.copy(), nth.copy()
        value = np.zeros(len(nth), np.int64)
        for zeros, bit in zip(self.zeros, reversed(range(self.bits))):
            l0, r0 = zeros[left], zeros[right]
            one = nth >= r0 - l0
            value |= one.astype(np.int64) << bit
            nth -= np.where(one, r0 - l0, 0)
            left = np.where(one, zeros[-1] + left - l0, l0)
            right = np.where(one, zeros[-1] + right - r0, r0)
        return value

    def successor(self, left, right, x):
        """The smallest of [left, right) that is x or more; -1 if there is none."""
        smaller = self.below(left, right, x)
        there = smaller < right - left
        found = np.full(len(x), -1, np.int64)
        found[there] = self.nth(left[there], right[there], smaller[there])
        return found

    def predecessor(self, left, right, x):
        """The largest of [left, right) that is x or less; -1 if there is none."""
        smaller = self.below(left, right, x + 1)
        there = smaller > 0
        found = np.full(len(x), -1, np.int64)
        found[there] = self.nth(left[there], right[there], smaller[there] - 1)
        return found


def _windows(size: int):
    """Distances of the windows of starts that a block of ``size`` words looks into: (first, last), ``size`` starts each."""
    low, high = (1, 6) if size == 2 else (2 * size - 1, 4 * size - 2)
    return [(d, d + size - 1) for d in range(low, high + 1, size)]


def _candidates(ladder: Ladder, tree: WaveletMatrix, size: int, at, left, right):
    """(block start, period) pairs that may be runs, from the occurrences of the blocks in their windows."""
    pairs = []
    for low, high in _windows(size):
        base = ladder.starts[at]
        local = at - base
        first = tree.successor(left, right, local + low)
        hit = (first >= 0) & (first <= local + high)
        i, l, r, x0, x1, start = at[hit], left[hit], right[hit], first[hit], local[hit] + high, base[hit]
        if not len(i):
            continue
        last = tree.predecessor(l, r, x1)
        second = tree.successor(l, r, x0 + 1)
        pairs += [(i, start + x0 - i), (i, start + last - i)]
        more = (second > 0) & (second < last)  # three or more: a progression
        i, x0, x2, d, start = i[more], x0[more], last[more], (second - x0)[more], start[more]
        if not len(i):
            continue
        j = start + x0
        a, b = i - ladder.backward(i, i + d), i + d + ladder.forward(i, i + d)
        a2, b2 = j - ladder.backward(j, j + d), j + d + ladder.forward(j, j + d)
        other = a != a2
        i, j, d, a, b, a2, b2, n = (x[other] for x in (i, j, d, a, b, a2, b2, (x2 - x0) // np.maximum(d, 1) + 1))
        pairs += [(i, b2 - b), (i, a2 - a)]
        reach = np.minimum(np.minimum(b - a, b2 - a2), (b2 - a) // 2)
        fits = np.where(b >= a2, np.clip((reach - (j - i)) // np.maximum(d, 1) + 1, 0, n), 0)
        many = np.repeat(np.arange(len(i)), fits)
        step = np.arange(len(many)) - np.repeat(np.cumsum(fits) - fits, fits)
        pairs.append((i[many], (j - i)[many] + step * d[many]))
    return pairs


def runs_of(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST):
    """(start, end, period) arrays of all runs, by start and period, in texts laid end to end (no word is in two texts)."""
    none = np.zeros(0, np.int64)
    ladder = Ladder(keys, starts, ends)
    if not any(len(b[1]) for b in ladder.blocks):
        return none, none, none
    inside = ladder.sorted[ladder.places]
    tree = WaveletMatrix(inside - starts[inside])
    pairs = [p for block in ladder.blocks if len(block[1]) for p in _candidates(ladder, tree, *block)]
    if not pairs:
        return none, none, none
    i, q = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    real = (q > 0) & (i + q < ends[i])
    i, q = i[real], q[real]
    start, end = i - ladder.backward(i, i + q), i + q + ladder.forward(i, i + q)
    long = end - start >= np.maximum(shortest, 2 * q)
    start, end, q = start[long], end[long], q[long]
    by = np.lexsort((q, end, start))
    start, end, q = start[by], end[by], q[by]
    smallest = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(by) else np.zeros(0, bool)
    start, end, q = start[smallest], end[smallest], q[smallest]
    by = np.lexsort((q, start))
    return start[by], end[by], q[by]


def cycled(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place after the rewriting that one document in ten undergoes; None if it stays as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    return np.where(place < a, place, a + (place - a) % p)


def _chunks(batch, rewrite):
    """Lists of (doc_id, words) of about ``WORDS`` words."""
    chunk, total = [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        words = (text.as_py() or "").encode("utf-8").split()  # bytes are parted at ASCII white space, no other
        order = rewrite(doc_id, len(words)) if rewrite else None
        if order is not None:
            words = [words[i] for i in order.tolist()]
        if chunk and total + len(words) > WORDS:
            yield chunk
            chunk, total = [], 0
        chunk.append((doc_id, words))
        total += len(words)
    if chunk:
        yield chunk


def _solved(chunk, shortest: int):
    """Per document of the chunk: doc_id, words, (start, end, period) arrays counted from its first word."""
    sizes = np.array([len(words) for _, words in chunk], np.int64)
    known = defaultdict(itertools.count().__next__)
    numbers = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(w for _, w in chunk)), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    doc = np.repeat(np.arange(len(chunk)), sizes)
    start, end, q = runs_of(doc * (len(known) + 1) + numbers, np.repeat(begins, sizes), np.repeat(ends, sizes), shortest)
    owner = doc[start]
    edges = np.searchsorted(owner, np.arange(len(chunk) + 1))
    for k, (doc_id, words) in enumerate(chunk):
        part = slice(edges[k], edges[k + 1])
        yield doc_id, words, start[part] - begins[k], end[part] - begins[k], q[part]


def kept_words(words: list[bytes], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> list[bytes]:
    """The words that no run repeats: each run keeps its first period."""
    if not len(start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, start, length, period: one row per run of at least ``shortest`` words of every text as it is."""
    def run(batches):
        for batch in batches:
            for chunk in _chunks(batch, None):
                ids, columns = [], ([], [], [])
                for doc_id, _, start, end, q in _solved(chunk, shortest):
                    ids += [doc_id] * len(q)
                    for out, values in zip(columns, (start, end - start, q)):
                        out.extend(values.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in columns)],
                                                 names=["doc_id", "start", "length", "period"])

    return _slim(docs).mapInArrow(run, RUNS)


def collapsed(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, text: the words that stay when every run is cut to its first period, joined by one blank; null texts are empty."""
    def run(batches):
        for batch in batches:
            for chunk in _chunks(batch, None):
                rows = [(doc_id, b" ".join(kept_words(words, *found)).decode("utf-8")) for doc_id, words, *found in _solved(chunk, shortest)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                                                 names=["doc_id", "text"])

    return _slim(docs).mapInArrow(run, "doc_id long, text string")


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def runs_report(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Per document, after ``cycled``: n_runs, the longest run and its exponent, digests of all runs and of the kept words."""
    def run(batches):
        for batch in batches:
            for chunk in _chunks(batch, cycled):
                rows = []
                for doc_id, words, start, end, q in _solved(chunk, shortest):
                    length = end - start
                    lines = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), q.tolist()))
                    best = (None,) * 4
                    if len(q):
                        k = int(np.argmax(length))  # the first of the longest; runs come by start, then period
                        best = (int(start[k]), int(length[k]), int(q[k]), int(1000 * length[k] // q[k]))
                    rows.append((doc_id, len(q), *best, _digest(lines.encode()), _digest(b" ".join(kept_words(words, start, end, q)))))
                kinds = [pa.int64()] * 6 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
                                                 names=[f.split()[0] for f in REPORT.split(", ")])

    return _slim(docs).mapInArrow(run, REPORT)
