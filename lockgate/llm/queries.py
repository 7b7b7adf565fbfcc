"""One query for each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lockgate.llm import (
    decontamination,
    exact_dedup,
    fim,
    jaccard,
    language,
    lm_scoring,
    manifest,
    mixing,
    packing,
    quality_rules,
    suffix_dedup,
    tokens,
    toxicity,
)
from lockgate.llm.common import Work


#: Ranks of the same vocabulary, and the pattern that cuts texts for both.
BYTE_RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scored(docs, toxicity.learn(docs, labels))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return language.identified(docs, language.learn(docs))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ranks=BYTE_RANKS)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "part")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup.exact_groups(docs)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.learn_from(docs, labels, Work(spark, "quality-rules"))
    return quality_rules.judged(docs, rules)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.summary(decontamination.contaminated(docs, benchmark))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proofs(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transformed(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle() -> dict[str, str]:
    return {
        "op9_exact_dedup": EXACT_DEDUP,
        "op11_decontamination": decontamination.SQL,
        "op12_manifest": manifest.SQL,
        "op13_fill_in_middle": fim.SQL,
    }


EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
