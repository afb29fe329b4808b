"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from streamlookup.llm.decontamination import without_benchmark
from streamlookup.llm.near_dedup import keep_one_of_each
from streamlookup.llm.packing import pack_documents
from streamlookup.llm.quality_classifier import accepted
from streamlookup.llm.secret_scan import redact_secrets
from streamlookup.plans.tables import table
from streamlookup.session import configure
from streamlookup.sources.shared import written

VOCABULARY = "word_bpe_49k.json"
END_ID = 1

# What a worker may remember of words: less than for packing alone, as the stages before
# have left their mark on an executor's memory.
CACHED_BYTES = 40 * 1024 * 1024


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return accepted(docs, table(configure(spark), sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    configure(spark)
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(docs, table(configure(spark), sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    configure(spark)
    return redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as token pieces with their place in packed sequences."""
    configure(spark)
    return pack_documents(docs, public_tokenizers.path(VOCABULARY), END_ID, cached_bytes=CACHED_BYTES)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# Several stages have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
