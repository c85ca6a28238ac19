"""The queries of this subpackage (spark, sf_dir) and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import (fingerprint, language_id, mixing, ngram_join, packing, periodic_runs, personal_data, prefix_trie, quality_rules,
                          secret_scan, sharding, token_rollup, url_filter)
from flowlake.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The tokenizer file of the packing query; the vocabulary stays where the public package keeps it."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return token_rollup.corpus_report(read_table(spark, sf_dir, "documents"), {
        "word_bpe_49k": (tokenizer_path(), None), "byte_bpe_50k": (str(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)})


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(read_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_report(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(read_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(read_table(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_report(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The labels of documents are taken as labels of the pages of the same number; low quality or toxic is bad.
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge(read_table(spark, sf_dir, "pages"), labels)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_report(read_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(read_table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_report(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_mixing": op2_mixing,
        "op3_ngram_join": op3_ngram_join,
        "op4_language_id": op4_language_id,
        "op5_packing": op5_packing,
        "op6_secret_scan": op6_secret_scan,
        "op7_sharding": op7_sharding,
        "op8_fingerprint": op8_fingerprint,
        "op9_quality_rules": op9_quality_rules,
        "op10_url_filter": op10_url_filter,
        "op11_personal_data": op11_personal_data,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_periodic_runs": op13_periodic_runs,
    }


_JOIN_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then [] else list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
    lambda i: array_to_string(ws[i:i + 4], ' ')))) end as grams from w),
g as (select doc_id, len(grams) as n, unnest(grams) as gram from s),
pairs as (select a.doc_id as a, b.doc_id as b from g a join g b on a.gram = b.gram and a.doc_id < b.doc_id
  group by 1, 2 having 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
links as (select a, b from pairs union all select b, a from pairs),
reach as (select doc_id, doc_id as other from documents union select r.doc_id, l.b from reach r join links l on r.other = l.a),
roots as (select doc_id, min(other) as component_id from reach group by 1)
select doc_id, len(grams)::bigint as n_shingles, component_id,
  case when len(grams) = 0 then doc_id else min(doc_id) over (partition by grams) end as set_id
from s join roots using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_join": _JOIN_SQL}
