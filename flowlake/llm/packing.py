"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become tokens, end with a separator, and are cut into pieces of at most ``ROOM`` tokens only where they are
longer. Full pieces are sequences of their own. The others are dealt at random over *problems* of about ``PIECES`` pieces;
each problem is worked on by ``ISLANDS`` islands in separate tasks. An island keeps a population of packings (lists of
groups). Crossover injects well-filled groups of one parent whole into another, removes the groups that held the same pieces,
and best-fits the displaced pieces; mutation empties the worst groups. An epoch ends
after ``CHILDREN`` children, or ``STALE`` in a row that improve nothing, or at the proven minimum. Then the best packing of each island
migrates to the next island of its problem, which takes it in place of its worst; the population is kept over epochs. The best packing of a
problem stands; its groups that are not well filled leave their pieces to a last, smaller round of problems, so loose ends of all problems
meet, and what that round finds is taken if it needs fewer groups.

A piece travels as (number, length); texts and token arrays never move, and a problem's memory is bounded by ``PIECES``.
All random choices are seeded by problem, island and epoch, so a lost task gives the same packing again.

Defined results: null and empty texts are one separator; rows that repeat an id are packed each; a null id is carried
along; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import Memory, materialise, text_blocks
from flowlake.session import settings

ROOM = 4096
SEPARATOR = 1
PIECES = 3000
ISLANDS = 2
EPOCHS = 3
POPULATION = 8
CHILDREN = 200
STALE = 80
FILLED = 0.995
LINE = 256
BLOCK, LEAN_BLOCK = 1 << 22, 1 << 19  # characters
KEPT, LEAN_KEPT = (300_000, 300_000), (40_000, 120_000)  # stretches and words in a generation of an encoder's memory
LEAN_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}
MARKS = ".,;:!?"
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)").fullmatch


class Encoder:
    """Ids of texts as little-endian bytes, put together from remembered stretches without blanks.

    Encoding is exact stretch by stretch because this kind of tokenizer drops white space and never joins across it. A
    plain word with closing marks is encoded as the word and the marks, which its pre-tokenizer parts as well. What a block of texts
    has that is new is encoded in one call.
    """

    def __init__(self, path: str, kept: tuple[int, int] = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.stretches, self.words = Memory(self._stretches, kept[0]), Memory(self._ids, kept[1])

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Plain words are encoded many to a line, and told apart by the word that each id belongs to; other stretches of ASCII by where in
        the line each id comes from; all else is encoded alone."""
        plain = [t for t in texts if t.isalpha()]
        done = dict(zip(plain, self._lines(plain)))
        mixed = [t for t in texts if t not in done and t.isascii() and t.isprintable()]
        done.update(zip(mixed, self._placed(mixed)))
        others = [t for t in texts if t not in done]
        done.update((t, np.array(e.ids, "<u4").tobytes()) for t, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)))
        return [done[t] for t in texts]

    def _lines(self, words: list[str]):
        lines = [words[k: k + LINE] for k in range(0, len(words), LINE)]
        for line, encoded in zip(lines, self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
            owner, data = np.array(encoded.word_ids, np.int64), np.array(encoded.ids, "<u4").tobytes()
            if len(owner) and owner[-1] + 1 == len(line) and (np.diff(owner, prepend=-1) <= 1).all():
                cuts = (4 * np.searchsorted(owner, np.arange(len(line) + 1))).tolist()
                yield from (data[a:b] for a, b in zip(cuts, cuts[1:]))
            else:  # some word is not one word to the tokenizer
                yield from (np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(line, add_special_tokens=False))

    def _placed(self, stretches: list[str]):
        lines = [stretches[k: k + LINE] for k in range(0, len(stretches), LINE)]
        for line, encoded in zip(lines, self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
            data, begins = np.array(encoded.ids, "<u4").tobytes(), [begin for begin, _ in encoded.offsets]
            first = np.cumsum([0, *(len(x) + 1 for x in line)])
            cuts = (4 * np.searchsorted(np.array(begins, np.int64), first)).tolist()
            yield from (data[a:b] for a, b in zip(cuts, cuts[1:]))

    def _stretches(self, texts: list[str]) -> list[bytes]:
        parts = [(w.lower(), t[len(w):]) if (w := t.rstrip(MARKS)).isalpha() and w.isascii() else
                 (m[1].lower(), m[2]) if (m := _PLAIN(t)) else (t, "") for t in texts]
        known = self.words.known({w for w, _ in parts} | {marks for _, marks in parts})
        return [known[w] + known[marks] if marks else known[w] for w, marks in parts]

    def split(self, text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def block_ids(self, texts: list[str]) -> list[bytes]:
        """Each distinct stretch of the block is looked up once; the ids of all texts are then gathered by arrays."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        stretches = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.stretches.known(set(stretches))
        parts = [known[s] for s in stretches]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        at = coded.indices.to_numpy()
        each = lengths[at]
        ends = np.cumsum(np.r_[0, each])
        source = np.repeat((np.cumsum(lengths) - lengths)[at] - ends[:-1], each) + np.arange(ends[-1])
        data = np.frombuffer(b"".join(parts), "<u4")[source].tobytes()
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def block_counts(self, texts: list[str]) -> list[int]:
        return [len(ids) // 4 for ids in self.block_ids(texts)]


@functools.cache
def encoder_of(path: str, kept: tuple[int, int] = KEPT) -> Encoder:
    return Encoder(path, kept)


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches, path: str, room: int, lean: bool = False):
    encoder = encoder_of(path, LEAN_KEPT if lean else KEPT)
    end = np.array([SEPARATOR], "<u4").tobytes()
    for batch in batches:
        ids, pieces, starts, lengths, sums = [], [], [], [], []
        for numbers, texts in text_blocks(batch.column(0), batch.column(1), LEAN_BLOCK if lean else BLOCK):
            for doc_id, data in zip(numbers, encoder.block_ids(texts)):
                data += end
                for k in range(0, len(data), 4 * room):
                    cut = data[k: k + 4 * room]
                    ids.append(doc_id)
                    pieces.append(k // (4 * room))
                    starts.append(k // 4)
                    lengths.append(len(cut) // 4)
                    sums.append(zlib.crc32(cut))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(pieces, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])
        if lean:
            pa.default_memory_pool().release_unused()


def pieces_of(docs: DataFrame, tokenizer: str, room: int = ROOM, lean: bool = False) -> DataFrame:
    """One row per piece of (doc_id, text): its place in the document, its length and the check sum of its ids. ``lean`` encodes smaller blocks
    and remembers less: the same rows in less memory and more time."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _pieces(it, tokenizer, room, lean), PIECE)


# -- the algorithm on one problem: a packing is a list of (free room, [piece indices])

def _best_fit(groups: list[tuple[int, list[int]]], loose: list[int], sizes: list[int], room: int) -> list[tuple[int, list[int]]]:
    """Put loose pieces, longest first, where least room remains."""
    order = sorted(range(len(groups)), key=lambda g: groups[g][0])
    free = [(groups[g][0], g) for g in order]
    held = [list(g[1]) for g in groups]
    left = [g[0] for g in groups]
    for i in sorted(loose, key=lambda x: -sizes[x]):
        at = bisect.bisect_left(free, (sizes[i], -1))
        if at < len(free):
            _, g = free.pop(at)
            left[g] -= sizes[i]
            held[g].append(i)
        else:
            g = len(held)
            held.append([i])
            left.append(room - sizes[i])
        if left[g]:
            bisect.insort(free, (left[g], g))
    return list(zip(left, held))


def _cost(groups, room: int) -> tuple[int, float]:
    """Fewer groups first, then fuller ones (sum of squared fill)."""
    return len(groups), -sum(((room - free) / room) ** 2 for free, _ in groups)


def _cross(one, two, sizes, room: int, rng: random.Random):
    """A child of ``one`` with some of the best-filled groups of ``two``."""
    good = sorted(two, key=lambda g: g[0])[: max(1, len(two) // 2)]
    start = rng.randrange(len(good))
    injected = good[start: start + 1 + rng.randrange(max(1, len(good)))]
    inside = {i for _, g in injected for i in g}
    kept, loose = list(injected), []
    for free, g in one:
        if inside.isdisjoint(g):
            kept.append((free, g))
        else:
            loose.extend(i for i in g if i not in inside)
    return _best_fit(kept, loose, sizes, room)


def _mutate(groups, sizes, room: int, rng: random.Random):
    """Empty the worst groups and a few others, and fit their pieces again."""
    order = sorted(groups, key=lambda g: -g[0])
    n = 1 + rng.randrange(max(1, len(order) // 20))
    rest = order[n:]
    rng.shuffle(rest)
    extra = rng.randrange(max(1, len(rest) // 20))
    return _best_fit(rest[extra:], [i for _, g in order[:n] + rest[:extra] for i in g], sizes, room)


def least_groups(sizes: list[int], room: int) -> int:
    """A number of groups that no packing goes below: pieces over half the room share no group, and what does not fit beside them, among
    pieces of at least some size, needs groups of its own (the best such bound over all sizes)."""
    if not sizes:
        return 0
    s = np.sort(np.array(sizes, np.int64))
    sums = np.r_[0, np.cumsum(s)]
    half = np.searchsorted(s, room // 2, side="right")  # from here on: over half
    limits = np.unique(np.r_[0, s[:half]])
    at_least = np.searchsorted(s, limits, side="left")
    beside = np.maximum(np.searchsorted(s, room - limits, side="right"), half)  # from here on nothing of the limit fits beside
    spare = (beside - half) * room - (sums[beside] - sums[half])
    small = sums[half] - sums[at_least]
    return int((len(s) - half + np.maximum(0, -(-(small - spare) // room))).max())


def evolve(sizes: list[int], seeds: list[list[list[int]]], seed: str, room: int = ROOM, population: int = POPULATION, children: int = CHILDREN,
           stale: int = STALE) -> list[list[list[int]]]:
    """The population after one epoch, best first, from that before (``seeds``: packings as lists of groups); fresh packings fill it up."""
    rng = random.Random(seed)
    least = least_groups(sizes, room)
    pool = [[(room - sum(sizes[i] for i in g), g) for g in groups] for groups in seeds]
    if not pool:
        pool = [_best_fit([], list(range(len(sizes))), sizes, room)]
    while len(pool) < population and len(min(pool, key=len)) > least:
        some = rng.sample(range(len(sizes)), len(sizes) // 2)  # half of the pieces in random order first
        groups: list[tuple[int, list[int]]] = []
        for i in some:
            if groups and groups[-1][0] >= sizes[i]:
                groups[-1] = (groups[-1][0] - sizes[i], [*groups[-1][1], i])
            else:
                groups.append((room - sizes[i], [i]))
        taken = set(some)
        pool.append(_best_fit(groups, [i for i in range(len(sizes)) if i not in taken], sizes, room))
    pool = sorted(((_cost(g, room), g) for g in pool), key=lambda x: x[0])[:population]
    idle = 0
    for _ in range(children):
        if len(pool[0][1]) <= least or idle >= stale:  # as few as there can be, or no way on
            break
        one, two = (pool[min(rng.randrange(len(pool)), rng.randrange(len(pool)))][1] for _ in range(2))
        child = _mutate(_cross(one, two, sizes, room, rng), sizes, room, rng)
        cost = _cost(child, room)
        idle = 0 if cost < pool[0][0] else idle + 1
        if (cost < pool[-1][0] or len(pool) < population) and all(cost != c for c, _ in pool):
            pool = sorted([*pool[:population - 1], (cost, child)], key=lambda x: x[0])
    return [[g for _, g in groups] for _, groups in pool]


def _island(table: pa.Table, room: int, epoch: int, last: bool) -> pa.Table:
    """One epoch of one island. Rows: its pieces (``packing`` -1) and, from the second epoch on, the packings it starts from.

    Out come its population (``packing`` from 0, the best), or the best alone after the last epoch or at the minimum.
    """
    frame = table.to_pandas()
    problem, island = int(frame["problem"].iloc[0]), int(frame["island"].iloc[0])
    own = frame[frame["packing"] < 0].sort_values(["length", "number"], ascending=[False, True])
    numbers, sizes = own["number"].to_numpy(), own["length"].tolist()
    place = {number: i for i, number in enumerate(numbers.tolist())}
    seeds = []
    for _, packing in frame[frame["packing"] >= 0].groupby("packing", sort=True):
        seeds.append([[place[x] for x in g] for g in packing.groupby("group")["number"].apply(list)])
    found = evolve(sizes, seeds, f"{problem}/{island}/{epoch}", room)
    least = least_groups(sizes, room)
    if last or len(found[0]) <= least:
        found = found[:1]
    order = np.array([i for groups in found for g in groups for i in g], np.int64)
    group = np.concatenate([np.repeat(np.arange(len(groups)), [len(g) for g in groups]) for groups in found])
    n, each = len(order), len(sizes)
    return pa.table({
        "problem": pa.array([problem] * n, pa.int64()), "island": pa.array([island] * n, pa.int32()),
        "packing": pa.array(np.repeat(np.arange(len(found)), each), pa.int32()), "number": pa.array(numbers[order], pa.int64()),
        "length": pa.array(np.array(sizes, np.int64)[order]), "group": pa.array(group, pa.int64()), "least": pa.array([least] * n, pa.int64())})


def _islander(room: int, epoch: int, last: bool):
    return lambda table: _island(table, room, epoch, last)


_PACKED = "problem long, island int, packing int, number long, length long, `group` long, least long"
_MIGRANT = 1000  # a migrant's number among the packings of the island it comes to


def solve(pieces: DataFrame, room: int, size: int, islands: int, epochs: int) -> DataFrame:
    """(number, length) -> problem, number, length, group: the best packing of each problem."""
    problems = max(1, -(-pieces.count() // size))
    dealt = pieces.withColumn("problem", F.pmod(F.xxhash64("number", F.lit(11)), F.lit(problems)))
    start = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))).select(
        "problem", "island", F.lit(-1).alias("packing"), "number", "length", F.lit(None).cast("long").alias("group"))
    start = materialise(start, "islanders")  # every epoch reads it
    rows, finished = start, None
    for epoch in range(epochs):
        done = materialise(rows.groupBy("problem", "island").applyInArrow(_islander(room, epoch, epoch + 1 == epochs), _PACKED), "islands")
        scores = done.filter("packing = 0").groupBy("problem", "island").agg(
            (F.max("group") + 1).alias("groups"), F.max("least").alias("least"))
        best = materialise(scores.groupBy("problem").agg(
            F.min_by("island", F.struct("groups", "island")).alias("island"), (F.min("groups") <= F.min("least")).alias("ready")), "best")
        here = done.filter("packing = 0").join(best.filter("ready" if epoch + 1 < epochs else "true"), ["problem", "island"]).select(
            "problem", "number", "length", "group")
        finished = here if finished is None else finished.union(here)
        open_ones = best.filter("not ready").select("problem")
        if epoch + 1 == epochs or open_ones.isEmpty():
            break  # nothing is left, or every problem is at its proven minimum
        done, start = done.join(open_ones, "problem").select(*start.columns), start.join(open_ones, "problem").select(*start.columns)
        rows = start.union(done)
        if islands > 1:  # the elite stays and also migrates to the next island
            elite = done.filter("packing = 0").select("problem", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                                                      F.lit(_MIGRANT).alias("packing"), "number", "length", "group")
            rows = rows.union(elite)
    return finished


def pack(pieces: DataFrame, room: int = ROOM, size: int = PIECES, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` (``length`` and any others) plus ``sequence_id`` and ``offset``."""
    numbered = materialise(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")
    short = numbered.filter(F.col("length") < room).select("number", "length")
    full = numbered.filter(F.col("length") >= room).select("number", F.col("number").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = materialise(solve(short, room, size, islands, epochs), "packed")
    fill = first.groupBy("problem", "group").agg((F.sum("length") >= FILLED * room).alias("well"))
    judged = materialise(first.join(fill, ["problem", "group"]), "judged")
    loose = judged.filter(~F.col("well"))
    ends = loose.select("problem", "group").distinct().count()
    again = materialise(solve(loose.select("number", "length"), room, size, islands, epochs), "again") if ends > 1 else None
    fewer = again is not None and again.select("problem", "group").distinct().count() < ends
    packed = judged.filter("well" if fewer else "true").select(F.lit(1).alias("round"), "problem", "group", "number", "length")
    if fewer:
        packed = packed.union(again.select(F.lit(2).alias("round"), "problem", "group", "number", "length"))
    line = Window.partitionBy("round", "problem", "group").orderBy(F.desc("length"), "number")
    placed = packed.select(
        "number", F.first("number").over(line).alias("sequence_id"),
        F.coalesce(F.sum("length").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    return numbered.join(placed.union(full), "number").drop("number")


def pack_report(docs: DataFrame, tokenizer: str, lean: bool = False, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``lean`` is for executors whose heap other steps have filled."""
    with settings(docs.sparkSession, LEAN_BATCH if lean else {}):
        return pack(pieces_of(docs, tokenizer, lean=lean), **options)
