"""Token counts by source, language and tokenizer version, maintained from signed changes.

A change says that a document with so many tokens came (+1) or went (-1) under a tokenizer version; a revised count is
both, the old row with -1 and the new one with +1. A batch of changes is folded to one additive delta per (source,
lang, version) and written to a folder of its own, named by the batch. A batch counts once its folder has a success marker:
applying a committed batch again does nothing, and a batch whose writer was lost is written over as a whole. Totals are the
sum of all committed deltas; ``compact`` folds them into a snapshot that remembers which batches it holds.

Only counts travel: texts are read where they lie, each document becomes a few numbers, and sums are partial before any
exchange, so a source with a third of all rows is one row per task. Deltas and snapshots have one row per group.

Defined results: null text has 0 tokens but is a document; null source or language are groups of their own; repeated rows
count each; a group whose documents and tokens are both back at 0 is not reported; empty batches commit and change nothing.
"""

from __future__ import annotations

import base64
import functools
import re
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.common import Memory, materialise, text_blocks, text_of
from flowlake.llm.packing import Encoder
from flowlake.session import scratch_path

GROUP = ["source", "lang", "version"]
DELTA = "source string, lang string, version string, docs long, tokens long"
_STRETCH = re.compile(r" ?[^\s]+|\s+(?!\S)|\s+").findall
_CUT = "\x00"
_ODD_BLANKS = re.compile("[\x1c-\x1f\x85]").search


class _RankCounts:
    """Token counts of texts under a byte-level vocabulary, added up from remembered stretches.

    The stretches are unions of the vocabulary's own pre-tokens (a word with the blank before it and what follows up to the next blank, or a
    run of white space), so counts add up exactly. Where Python's idea of white space is another one, the text is encoded as a whole.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.stretches = Memory(self._counts)

    def _counts(self, texts: list[str]) -> list[int]:
        encode = self.encoding.encode_ordinary
        return [len(encode(t)) for t in texts]

    def split(self, text: str) -> list[str] | None:
        """None if the text has to be taken whole."""
        if _ODD_BLANKS(text):
            return None
        if "  " in text or text.endswith(" ") or _CUT in text:
            return _STRETCH(text)
        return text.replace(" ", _CUT + " ").split(_CUT)  # single blanks: each begins a pre-token

    def block_counts(self, texts: list[str]) -> list[int]:
        split = [self.split(t) for t in texts]
        known = self.stretches.known(set().union(*(stretches for stretches in split if stretches is not None)))
        count = known.__getitem__
        return [self._counts([t])[0] if stretches is None else sum(map(count, stretches)) for t, stretches in zip(texts, split)]


@functools.cache
def _ranks(path: str, pattern: str) -> _RankCounts:
    return _RankCounts(path, pattern)


class _IdCounts(Encoder):
    """Counts only: a stretch is remembered as the number of its ids, so no ids are put together."""

    def __init__(self, path: str):
        super().__init__(path)
        self.lengths = Memory(lambda texts: [len(ids) // 4 for ids in self._stretches(texts)])

    def block_counts(self, texts: list[str]) -> list[int]:
        split = [self.split(t) for t in texts]
        count = self.lengths.known(set().union(*split)).__getitem__
        return [sum(map(count, stretches)) for stretches in split]


_id_counts = functools.cache(_IdCounts)


def _counter(path: str, pattern: str | None):
    """A function texts -> numbers of tokens, for a vocabulary file."""
    return (_ranks(path, pattern) if path.endswith(".tiktoken") else _id_counts(path)).block_counts


def token_counts(docs: DataFrame, tokenizers: dict[str, tuple[str, str | None]]) -> DataFrame:
    """(doc_id, source, lang, text_hash, one count per version) of every row, from ``{version: (file, pattern)}``."""
    versions = list(tokenizers)
    slim = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.xxhash64(text_of(F.col("text"))).alias("text_hash"), text_of(F.col("text")).alias("text"))

    def run(batches):
        counters = [_counter(*tokenizers[v]) for v in versions]
        for batch in batches:
            counts = [[] for _ in versions]
            for _, texts in text_blocks(batch.column(3), batch.column(4)):
                for out, count in zip(counts, counters):
                    out += count(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *(pa.array(c, pa.int64()) for c in counts)],
                names=["doc_id", "source", "lang", "text_hash", *(f"n{i}" for i in range(len(versions)))])

    kind = slim.schema["doc_id"].dataType.simpleString()
    fields = ", ".join(f"n{i} long" for i in range(len(versions)))
    return slim.mapInArrow(run, f"doc_id {kind}, source string, lang string, text_hash long, {fields}")


def changes(counts: DataFrame, version: str, n: str, sign: int) -> DataFrame:
    """Signed changes (source, lang, version, tokens, sign) of the rows of ``counts``; ``n`` is the count or an expression."""
    return counts.select("source", "lang", F.lit(version).alias("version"), F.expr(n).cast("long").alias("tokens"), F.lit(sign).alias("sign"))


def revised(counts: DataFrame, version: str, old: str, new: str) -> DataFrame:
    return changes(counts, version, old, -1).union(changes(counts, version, new, 1))


class Rollup:
    """The maintained totals under ``path``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _done(self, kind: str) -> list[str]:
        """Folders of ``kind`` that have a success marker."""
        files, top = self._files(), self._hadoop(f"{self.path}/{kind}")
        if not files.exists(top):
            return []
        names = [x.getPath().getName() for x in files.listStatus(top)]
        return sorted(n for n in names if files.exists(self._hadoop(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def _snapshot(self) -> int:
        """Number of the newest complete snapshot; 0 before the first."""
        done = set(self._done("snapshots")) & set(self._done("held"))  # the names of the batches are written last
        return max(map(int, done), default=0)

    def _held(self, number: int, names: list[str]) -> set[str]:
        """Which of ``names`` a snapshot holds. It may hold very many batches; only those asked for come back."""
        if not number or not names:
            return set()
        held = self.spark.read.schema("batch string").parquet(f"{self.path}/held/{number}")
        return {r["batch"] for r in held.filter(F.col("batch").isin(names)).collect()}

    def _loose(self) -> tuple[int, list[str], list[str]]:
        """The newest snapshot, the committed batches it does not hold, and those it does whose folders are still there."""
        while True:
            number, names = self._snapshot(), self._done("deltas")
            held = self._held(number, names)
            if self._snapshot() == number:  # else one was completed meanwhile: look again
                return number, [n for n in names if n not in held], sorted(held)

    def applied(self, batch: str) -> bool:
        name = quote(batch, safe="")
        return name in self._done("deltas") or bool(self._held(self._snapshot(), [name]))

    def apply(self, batch: str, changed: DataFrame) -> bool:
        """Commit a batch of changes; False if it was committed before."""
        if self.applied(batch):
            return False
        sign = F.col("sign").cast("long")
        delta = changed.groupBy(*GROUP).agg(F.sum(sign).alias("docs"), F.sum(sign * F.col("tokens")).alias("tokens"))
        delta.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/deltas/{quote(batch, safe='')}")
        return True

    def _sum(self, number: int, names: list[str]) -> DataFrame:
        paths = [f"{self.path}/deltas/{n}" for n in names] + ([f"{self.path}/snapshots/{number}"] if number else [])
        if not paths:
            return self.spark.createDataFrame([], DELTA)
        deltas = self.spark.read.schema(DELTA).parquet(*paths)
        return deltas.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens."""
        number, names, _ = self._loose()
        return self._sum(number, names)

    def compact(self) -> None:
        """Fold the batches committed by now into a new snapshot; later ones are left alone.

        Their folders, and the snapshot before, stay until the next compaction, so totals that were asked for meanwhile can be read.
        One compaction runs at a time.
        """
        number, names, held = self._loose()
        new = str(number + 1)
        self._sum(number, names).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshots/{new}")
        batches = self.spark.createDataFrame([(n,) for n in names], "batch string")
        if number:
            batches = self.spark.read.schema("batch string").parquet(f"{self.path}/held/{number}").union(batches)
        batches.write.mode("overwrite").parquet(f"{self.path}/held/{new}")
        for folder in [*(f"deltas/{n}" for n in held), *(f"{kind}/{number - 1}" for kind in ("held", "snapshots") if number > 1)]:
            self._files().delete(self._hadoop(f"{self.path}/{folder}"), True)


def _life(docs: DataFrame, tokenizers: dict[str, tuple[str, str | None]], room: int) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Batches that curate a corpus, and those that take it back: every document comes under every version, copies of an
    earlier document go, documents longer than ``room`` are cut to it; then whole texts count again and the copies return.
    """
    counts = materialise(token_counts(docs, tokenizers), "token-counts")
    firsts = counts.groupBy("text_hash").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    firsts = materialise(firsts.select("text_hash", "first"), "firsts")
    copies = materialise(counts.join(firsts, "text_hash").filter("doc_id > first").select(*counts.columns), "copies")
    gone = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    names = list(enumerate(tokenizers))
    too_long = functools.reduce(lambda a, b: a | b, [F.col(f"n{i}") > room for i, _ in names])
    left = counts.filter(too_long).join(firsts, "text_hash", "left").filter(~gone)
    left = materialise(left.select(*counts.columns), "long")
    union = lambda frames: functools.reduce(DataFrame.union, frames)
    curated = {
        "load": union([changes(counts, v, f"n{i}", 1) for i, v in names]),
        "copies": union([changes(copies, v, f"n{i}", -1) for i, v in names]),
        "cut": union([revised(left.filter(F.col(f"n{i}") > room), v, f"n{i}", str(room)) for i, v in names]),
    }
    back = {
        "whole": union([revised(left.filter(F.col(f"n{i}") > room), v, str(room), f"n{i}") for i, v in names]),
        "returned": union([changes(copies, v, f"n{i}", 1) for i, v in names]),
    }
    return curated, back


def _after(spark: SparkSession, steps: dict[str, DataFrame]) -> DataFrame:
    """Totals after the batches. Every one is sent twice; it counts once."""
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    for batch in (*steps, *steps):
        rollup.apply(batch, steps[batch])
    rollup.compact()
    return rollup.totals()


def rollup_report(docs: DataFrame, tokenizers: dict[str, tuple[str, str | None]], room: int = 4096) -> DataFrame:
    """Totals of the curated corpus: without copies of an earlier document, and with at most ``room`` tokens of each."""
    return _after(docs.sparkSession, _life(docs, tokenizers, room)[0])


def corpus_report(docs: DataFrame, tokenizers: dict[str, tuple[str, str | None]], room: int = 4096) -> DataFrame:
    """Totals of all rows and whole texts, after a life in which the corpus was curated and then taken back to what it is."""
    curated, back = _life(docs, tokenizers, room)
    return _after(docs.sparkSession, curated | back)
