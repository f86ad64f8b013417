"""From raw documents to token ids, in five stages; each works on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskengine.llm.chunk_bpe import bpe
from riskengine.llm.containment import contaminated
from riskengine.llm.frames import stored, table, with_keys
from riskengine.llm.importance import resampled
from riskengine.llm.line_windows import remove_repeated_windows
from riskengine.llm.queries import VOCABULARY
from riskengine.llm.resemblance import one_per_group


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the resampled set; those without words go (null and empty texts too). Rows equal in id and text share a verdict."""
    kept = resampled(docs, table(spark, sf_dir, "labels")).filter("kept").select("key")
    return with_keys(docs, kept, "left_semi")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of passages that stand earlier; ``n_chars`` follows the text. Every row stays, null and empty texts as they are."""
    found = remove_repeated_windows(docs)
    columns = {
        "text": F.col("kept_text"),
        "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars")).cast("bigint"),
    }
    return found.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group tied by 0.8 of their five-word shingles; of rows equal in id and text, one.

    Candidates are links of SimHash fingerprints, and of MinHash keys for what lies beyond their 3 bits.
    """
    return with_keys(docs, one_per_group(docs), "left_semi").dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none and stay, rows equal in id and text go or stay together."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return with_keys(docs, found.select("key").distinct(), "left_anti")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document left."""
    found = bpe(docs, public_tokenizers.path(VOCABULARY))
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

# Gumbel draws, XXH64 fingerprints and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
