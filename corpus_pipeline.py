"""The training-data pipeline: five operators over the documents, each stage on all that the one before kept.

An empty table stays empty through all stages; columns beyond doc_id and text
are carried along, whatever their names, up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandweave.llm import decontaminate, packing, quality, secrets, simhash
from strandweave.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; so do null and empty texts, which have too few words."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    A document without an id goes if one with an id is in its group; rows that
    repeat the smallest id stay together.  Null texts are one group.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; null texts hold none, and benchmark items without text have no window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark, and n_chars is renewed; null texts stay null."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its place in a sequence; null and empty texts are the end's id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Compression, 64-bit xxHash and tokenizers have no SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
