"""The operators over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from streamlookup.llm.decontamination import benchmark_matches
from streamlookup.llm.divergence import source_divergence
from streamlookup.llm.licenses import scan_licenses
from streamlookup.llm.lm_scoring import score_documents
from streamlookup.llm.near_dedup import near_duplicates
from streamlookup.llm.packing import pack_documents
from streamlookup.llm.periodic_runs import periodic_runs, repeat_tail, run_digests
from streamlookup.llm.quality_classifier import judge_quality
from streamlookup.llm.quality_rules import judge_documents
from streamlookup.llm.secret_scan import scan_secrets
from streamlookup.llm.sharding import shard_documents
from streamlookup.llm.sql import ORACLE_SQL
from streamlookup.llm.token_counts import count_tokens
from streamlookup.llm.token_files import token_round_trip
from streamlookup.plans.tables import table

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
END_ID = 1


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), END_ID)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_VOCABULARY))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), END_ID)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("redacted")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which of several rules comes first depends on measured times.
    return judge_documents(table(spark, sf_dir, "documents")).drop("rejected_by")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(table(spark, sf_dir, "documents"), prepare=repeat_tail))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_token_counts,
        op3_quality_classifier,
        op4_license_scan,
        op5_token_files,
        op6_decontamination,
        op7_secret_scan,
        op8_minhash_dedup,
        op9_lm_scoring,
        op10_quality_rules,
        op11_source_divergence,
        op12_sharding,
        op13_periodic_runs,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
