"""The registered queries: each operator over its whole table, with the parameters meant for use."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskengine.llm.chunk_bpe import bpe_digests
from riskengine.llm.containment import contaminated
from riskengine.llm.frames import table
from riskengine.llm.ftrl_langid import language_id
from riskengine.llm.host_rules import quality_rules
from riskengine.llm.importance import resampled
from riskengine.llm.interval_merkle import lower_cased_fifth, merkle_manifest
from riskengine.llm.line_windows import remove_repeated_windows
from riskengine.llm.maxent_lm import lm_scores
from riskengine.llm.phrase_prints import phrase_fingerprints
from riskengine.llm.pii_tagger import personal_data
from riskengine.llm.simhash import near_duplicates
from riskengine.llm.strata_search import ranked_search
from riskengine.llm.suffixes import without_repeats

VOCABULARY = "word_bpe_49k.json"


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_windows(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", kept.alias("kept_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "whole", "passage", "weight", "kept")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_found", "n_shingles", F.round("containment", 6).alias("containment"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_fingerprints(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"), lower_cased_fifth())


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_simhash,
        op3_line_dedup,
        op4_pii,
        op5_quality_classifier,
        op6_decontamination,
        op7_suffix_dedup,
        op8_bpe,
        op9_language_id,
        op10_quality_rules,
        op11_fingerprints,
        op12_merkle_manifest,
        op13_ranked_search,
    )
}
