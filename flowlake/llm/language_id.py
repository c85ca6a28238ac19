"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased and seen as its UTF-8 bytes with everything but letters as blanks; runs of 1 to ``GRAM`` bytes
are hashed into ``BUCKETS`` rows of an embedding table. The mean of a text's rows is its vector; a linear softmax on
it gives the languages. Both layers are trained by stochastic gradient descent in numpy, on at most ``TRAIN_ROWS`` labelled
documents (a documented bound: equal shares of the languages, as far as they have rows, by id hashes).
A quarter of them calibrates: a temperature is fitted by likelihood, and the rejection limit is the smallest score above which
``PRECISION`` of the calibration documents are right.

Prediction goes over whole texts in Arrow batches on the executors. As the softmax is linear in the embeddings, the model
that travels is one table of BUCKETS x languages numbers.

Defined results: null text, or text without any letter, is ``und`` with score 0; without a labelled document every
prediction is ``und``; repeated rows are predicted each (and may each be drawn for training); ties go to the first
language by name; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 14
DIM = 16
GRAM = 4
TRAIN_ROWS = 3000
EPOCHS = 6
RATE = 1.0
GAIN = 10  # a text moves a row by its small share of the text; its rate is larger
PRECISION = 0.99
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str, block: int = 1 << 20) -> np.ndarray:
    """How often each bucket is hit by the byte grams of the whole text."""
    counts = np.zeros(BUCKETS, np.int64)
    data = np.frombuffer(f" {_NOT_LETTERS.sub(' ', text.lower())} ".encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, len(data), block):  # blocks overlap by GRAM - 1 bytes, so memory does not follow the text
        part = data[at: at + block + GRAM - 1].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for size in range(1, GRAM + 1):
            code = code[: len(part) - size + 1] * np.uint32(257) + part[size - 1:] + np.uint32(1)
            starts = code[:block]
            counts += np.bincount((starts * np.uint32(2654435761)) >> np.uint32(18), minlength=BUCKETS)
    return counts


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, seed: int = 5,
          epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """(table of BUCKETS x labels, bias) from (buckets, weights) per text; stochastic gradient descent, decaying rate."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.3, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, n_labels)), np.zeros(n_labels)
    steps, step = epochs * len(features), 0
    for _ in range(epochs):
        for i in rng.permutation(len(features)):
            lr = rate * (1 - step / steps)
            step += 1
            buckets, weights = features[i]
            mean = weights @ table[buckets]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= lr * np.outer(mean, p)
            bias -= lr * p
            table[buckets] -= GAIN * lr * weights[:, None] * back[None, :]
    return table @ out, bias


def scores(counts: np.ndarray, table: np.ndarray, bias: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    logits = (counts @ table / max(1, counts.sum()) + bias) / temperature
    p = np.exp(logits - logits.max())
    return p / p.sum()


def calibrate(features, labels: np.ndarray, table, bias, precision: float = PRECISION) -> tuple[float, float]:
    """(temperature with the best likelihood, smallest score above which ``precision`` of the texts are right)."""
    if not len(features):
        return 1.0, 0.0
    logits = np.array([weights @ table[buckets] for buckets, weights in features]) + bias
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.05, 20, 61):
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        loss = -(z[np.arange(len(z)), labels] - np.log(np.exp(z).sum(axis=1))).mean()
        if loss < best:
            best, temperature = loss, float(t)
    z = np.exp((logits - logits.max(axis=1, keepdims=True)) / temperature)
    top, right = (z / z.sum(axis=1, keepdims=True)).max(axis=1), logits.argmax(axis=1) == labels
    order = np.argsort(-top)
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    return temperature, float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _features(batches):
    for batch in batches:
        buckets, weights = [], []
        for text in batch.column(2):
            counts = gram_counts(text.as_py())
            hit = np.flatnonzero(counts)
            buckets.append(hit.astype(np.int32).tobytes())
            weights.append((counts[hit] / counts.sum()).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(buckets, pa.binary()), pa.array(weights, pa.binary())], names=["lang", "place", "buckets", "weights"])


def drawn(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` rows (lang, place, buckets, weights) to learn from, about as many of each language; one with few rows keeps all.

    ``place`` is what a row's number in its language's order by hash is expected to be, so the smallest places are equal shares.
    """
    usable = docs.filter("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", F.lit(3)).bitwiseAND(F.lit((1 << 62) - 1)).alias("h"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # Every language gets about the same number of rows: a share of its hash range.
    limits = counts.select("lang", "n", (F.lit(float(1 << 62)) * F.least(F.lit(1.0), F.lit(1.2 * rows) / (
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) * F.col("n")))).alias("limit"))
    some = usable.join(F.broadcast(limits), "lang").filter("h <= limit").select(
        "lang", (F.col("n") * (F.col("h") / float(1 << 62))).alias("place"), "text")
    return some.mapInArrow(_features, "lang string, place double, buckets binary, weights binary").orderBy("place", "lang").limit(rows)


def fit(docs: DataFrame, rows: int = TRAIN_ROWS):
    """Model (names, table, bias, temperature, limit) from rows (doc_id, text, lang) that may be learnt from; None without any."""
    found = drawn(docs, rows).collect()
    if not found:
        return None
    names = sorted({r["lang"] for r in found})
    features = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["weights"], np.float32)) for r in found]
    labels = np.array([names.index(r["lang"]) for r in found])
    test = np.arange(len(found)) % 4 == 3
    learn = [i for i in range(len(found)) if not test[i]]
    table, bias = train([features[i] for i in learn], labels[learn], len(names))
    temperature, limit = calibrate([features[i] for i in np.flatnonzero(test)], labels[test], table, bias)
    return names, table.astype(np.float32), bias, temperature, limit


def predict(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted (score at or above the calibrated limit)."""
    slim = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def run(batches):
        known = shared.value
        for batch in batches:
            names, best = [], []
            for text in batch.column(2):
                text = text.as_py()
                if known is None or not has_letter(text):
                    names.append(UNKNOWN)
                    best.append(0.0)
                    continue
                p = scores(gram_counts(text), known[1], known[2], known[3])
                names.append(known[0][int(p.argmax())])
                best.append(float(p.max()))
            accepted = [known is not None and s >= known[4] and n != UNKNOWN for n, s in zip(names, best)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names), pa.array(best, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")


def language_report(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    slim = docs.select("doc_id", "text", "lang")
    return predict(slim, fit(slim.filter(~held_out(F.col("doc_id"))), rows))
