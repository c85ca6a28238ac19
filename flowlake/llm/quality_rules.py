"""Quality rules whose thresholds carry a proven bound on wrongly rejected documents.

Six rules score a document between 0 and 1 (higher is worse). For each stratum (language) and rule, labelled holdout
documents are counted by score in steps of 1/100. Going from the strictest cutoff downwards, a cutoff is certified while
the exact binomial test rejects "more than ``false_rejection / rules`` of the good documents lie above it"; the level of
each walk is ``confidence_error / (strata * rules)`` (Bonferroni over walks; inside a walk the order is fixed in advance,
so its steps need no further correction). All certified cutoffs therefore hold together, and the sum over rules bounds a
stratum's false rejections by ``false_rejection`` with probability ``1 - confidence_error``. Among certified cutoffs the
one that rejects most bad documents, each wrongly rejected good one counted ``good_weight`` times, is used; a rule without
a useful certified cutoff rejects nothing.

Everything is built-in expressions: metrics are one projection per document, the label counts are one grouped sum, and
the table of cutoffs has one row per stratum.

Defined results: null text has no words; documents without labels are judged but not counted; null labels are ignored;
several labels for one id all count; a null stratum is a stratum of its own; empty tables give empty results and no cutoffs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import SPACE, WORD, materialise, packed, text_of, unpacked

WINDOW = 8
MIN_WORDS = 20
STEPS = 100
RULES = ["symbols", "dup_lines", "repeats", "stutter", "long_words", "short_words"]
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def add_metrics(df: DataFrame, text: Column, n: int = WINDOW) -> DataFrame:
    """Add ``_m``: a struct of the five counts plus ``n_lines`` and ``n_stutter`` (words equal to the one before).

    Word windows are compared as 64-bit hashes of hashes. The costly part (which words do repeated windows cover) is
    evaluated only for documents that have a repeated window.
    """
    text = text_of(text)
    df = df.withColumn("_text", text)
    df = df.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    df = df.select(*[c for c in df.columns if c != "_words"], F.size("_words").cast("long").alias("_n"),
                   F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    has = F.col("_n") >= n
    df = df.withColumn("_win", F.when(has, F.transform(
        F.sequence(F.lit(0), (F.col("_n") - n).cast("int")), lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(n)])
    )))
    df = df.withColumn("_sorted", F.when(has & (F.size("_win") > F.size(F.array_distinct("_win"))), F.array_sort(
        F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(x["h"] == F.get("_sorted", j)["h"], F.lit(False))
    df = df.withColumn("_starts", F.when(F.col("_sorted").isNotNull(), F.array_sort(F.filter(
        F.transform("_sorted", lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"])), lambda i: i.isNotNull()))))
    covered = F.when(F.col("_starts").isNull(), F.lit(0)).otherwise(F.aggregate(
        F.transform("_starts", lambda s, j: F.least(F.coalesce(F.get("_starts", j + 1) - s, F.lit(n)), F.lit(n))),
        F.lit(0), lambda a, x: a + x))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    df = df.withColumn("_lines", lines)
    return df.withColumn("_m", F.struct(
        F.col("_n").alias("n_words"),
        F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter(F.transform("_h", lambda x, i: (i > 0) & (x == F.get("_h", i - 1))), lambda b: b)).cast("long").alias("n_stutter"),
    )).drop("_text", "_n", "_h", "_win", "_sorted", "_starts", "_lines")


def base_failed(m: str = "_m") -> Column:
    f = lambda c: F.col(f"{m}.{c}")
    return (f("n_words") < MIN_WORDS) | (100 * f("n_repeat_words") > 30 * f("n_words"))


def rule_scores(m: str = "_m") -> dict[str, Column]:
    """Per rule an integer score from 0 to ``STEPS``; 0 never rejects."""
    f = lambda c: F.col(f"{m}.{c}")
    share = lambda a, b: F.coalesce(F.try_divide(a * STEPS, b), F.lit(0.0))
    mean = F.coalesce(F.try_divide(f("word_chars"), f("n_words")), F.lit(0.0))
    raw = {
        "symbols": share(f("n_symbols"), f("word_chars")), "dup_lines": share(f("n_dup_lines"), f("n_lines")),
        "repeats": share(f("n_repeat_words"), f("n_words")), "stutter": share(f("n_stutter"), f("n_words")),
        "long_words": (mean - 5) * 10, "short_words": F.when(f("n_words") > 0, (5 - mean) * 20).otherwise(F.lit(0.0)),
    }
    return {k: F.greatest(F.lit(0), F.least(F.lit(STEPS), F.ceil(v))).cast("int") for k, v in raw.items()}


def _log_gamma(x: Column) -> Column:
    z = x + 7.0
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    shift = x
    for k in range(1, 7):
        shift = shift * (x + float(k))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(shift)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), exact to rounding where k is below the mean; 1 elsewhere.

    The largest term comes from log gamma, the smaller ones from their ratios; terms 60 standard deviations further
    down are below the smallest double.
    """
    k, n = k.cast("double"), n.cast("double")
    log_top = (_log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0) + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.least(k, F.ceil(60 * F.sqrt(n * p)) + 60).cast("int")
    odds = (1 - p) / p
    total = F.aggregate(
        F.sequence(F.lit(0), steps), F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, i: F.struct((acc["term"] * (k - i) / (n - k + i + 1.0) * odds).alias("term"), (acc["sum"] + acc["term"]).alias("sum")),
        lambda acc: acc["sum"])
    return F.when(k < n * p, F.exp(log_top + F.log(total))).otherwise(F.lit(1.0))


def cutoffs(scored: DataFrame, false_rejection: float = 0.05, confidence_error: float = 0.05, good_weight: int = 20) -> DataFrame:
    """From rows (``stratum``, ``good``, one score per rule): ``stratum`` and one cutoff per rule (null: none).

    ``scored`` is folded to counts per stratum, rule and score step at once; everything after that has at most
    strata * rules * steps rows.
    """
    long = scored.select("stratum", "good", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("score")) for r in RULES])).alias("x"))
    counts = long.groupBy("stratum", "x.rule", "x.score").agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    counts = materialise(counts, "label-counts")
    strata = counts.select("stratum").distinct().count()
    walk = Window.partitionBy("stratum", "rule").orderBy(F.desc("score"))
    group = Window.partitionBy("stratum", "rule")
    at = counts.select("stratum", "rule", "score", F.sum("good").over(walk).alias("k"), F.sum("bad").over(walk).alias("caught"),
                       F.sum("good").over(group).alias("n"))
    level = confidence_error / (max(strata, 1) * len(RULES))
    tested = at.filter("score > 0").withColumn("fails", (binomial_cdf(F.col("k"), F.col("n"), false_rejection / len(RULES)) > F.lit(level)).cast("int"))
    certified = tested.withColumn("failed", F.max("fails").over(walk)).filter("failed = 0")
    gain = F.col("caught") - good_weight * F.col("k")
    best = certified.withColumn("gain", gain).filter("gain > 0").groupBy("stratum", "rule").agg(
        F.max_by("score", F.struct("gain", "score")).alias("cutoff"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES])


def _stratum(col: Column) -> Column:
    return F.when(col.isNull(), F.lit("?")).otherwise(F.concat(F.lit("="), col.cast("string")))


def judge(docs: DataFrame, labels: DataFrame, false_rejection: float = 0.05, confidence_error: float = 0.05,
          good_weight: int = 20) -> DataFrame:
    """``docs`` needs the struct ``row`` (see ``packed``) with ``doc_id``, ``text`` and ``lang``, and may have any text-free
    ``carry`` struct instead of the full row. Returns ``docs``' columns plus ``_m``, ``base_failed``, ``kept``, ``reasons``.
    """
    keep = [c for c in docs.columns if c != "_text_in"]
    scored = add_metrics(docs, F.col("_text_in") if "_text_in" in docs.columns else F.col("row.text"))
    scored = scored.select(*keep, "_m").withColumn("base_failed", base_failed()).withColumn("_stratum", _stratum(F.col("row.lang")))
    scored = materialise(scored.withColumns({f"_s_{k}": v for k, v in rule_scores().items()}), "quality")
    truth = labels.filter("quality is not null").select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("good"))
    holdout = scored.filter(~F.col("base_failed")).select(
        F.col("row.doc_id").alias("_id"), F.col("_stratum").alias("stratum"), *[F.col(f"_s_{r}").alias(r) for r in RULES]
    ).join(truth, "_id")
    cuts = materialise(cutoffs(holdout, false_rejection, confidence_error, good_weight), "cutoffs")
    judged = scored.join(cuts.withColumnRenamed("stratum", "_stratum"), "_stratum", "left")
    reasons = F.filter(F.array(
        F.when(F.col("base_failed"), F.lit("base")),
        *[F.when(F.col(f"_s_{r}") >= F.col(f"_cut_{r}"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return judged.withColumn("reasons", reasons).select(*keep, "_m", "base_failed", (F.size("reasons") == 0).alias("kept"), "reasons")


def quality_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id``, the five counts, ``base_failed``, ``kept``, ``reasons`` (no texts are moved)."""
    slim = docs.select(F.struct("doc_id", "lang").alias("row"), F.col("text").alias("_text_in"))
    return judge(slim, labels, **options).select(
        "row.doc_id", *[f"_m.{c}" for c in METRICS], "base_failed", "kept", F.array_join("reasons", ",").alias("reasons"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rejected rows; columns and repeated rows stay as they are."""
    return unpacked(judge(packed(docs), labels, **options).filter("kept"), docs)
