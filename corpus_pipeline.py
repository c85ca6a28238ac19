"""A training corpus from the ``documents`` table, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``:

1. quality rules: rejected documents go;
2. n-gram Jaccard join: one document of each group of near duplicates stays;
3. secret scans: found secrets are masked, every document stays;
4. mixing sources to target weights: documents repeat or go as the mix takes them;
5. best-fit packing: where each piece of each document lies in the training sequences.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from flowlake.llm import mixing, ngram_join, packing, quality_rules, secret_scan  # noqa: E402
from flowlake.llm.common import materialise, read_table  # noqa: E402
from flowlake.llm.queries import tokenizer_path  # noqa: E402


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_report(docs, tokenizer_path(), lean=True)  # the heaps are full-grown by then


STAGES = [
    ("quality_rules", good_documents),
    ("ngram_join", distinct_documents),
    ("secret_scan", masked_documents),
    ("mixing", mixed_documents),
    ("packing", packed_documents),
]

# The packing runs a genetic search over token counts of a public tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
