"""One query for each operator, over the whole table it is meant for, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedmill.llm import chat_rotation, collocations, conversation_repair, decontamination, fingerprints, jaccard_join, language_id, packing, quality, secret_scan, sharding, substring_dedup, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_held_out(_table(spark, sf_dir, "documents"))


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_rotation.rotate(_table(spark, sf_dir, "conversations"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.report(docs, secret_scan.fit(secret_scan.corpus_samples(docs)))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_held_out(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damage(turns), turns)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup, op2_language_id, op3_chat_rotation, op4_fingerprints, op5_decontamination,
            op6_secret_scan, op7_jaccard_join, op8_toxicity, op9_quality, op10_packing, op11_collocations, op12_sharding, op13_conversation_repair,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substring_dedup.SQL,
        "op3_chat_rotation": chat_rotation.SQL,
        "op6_secret_scan": secret_scan.SQL,
        "op7_jaccard_join": jaccard_join.SQL,
        "op10_packing": packing.SQL,
        "op11_collocations": collocations.SQL,
        "op12_sharding": sharding.SQL,
        "op13_conversation_repair": conversation_repair.SQL,
    }
