"""The operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import bpe, conversations, cotrain, dac, dartminhash, decontaminate, gru, importance, lines, secrets, shards, spotsigs, suffix


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.groups(table(spark, sf_dir, "documents"))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op4_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotrain.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "quality_score", "keep")


def op5_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_gru_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru.score(table(spark, sf_dir, "documents"))


def op8_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign(table(spark, sf_dir, "documents"), 8)
    return shards.number_slots(placed).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compared(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_dart_minhash, op2_secret_ledger, op3_byte_bpe, op4_cotrained_quality, op5_suffix_radix, op6_decontamination, op7_gru_score, op8_jump_shards, op9_spotsigs, op10_token_files, op11_importance_resampling, op12_line_dedup, op13_conversation_repair)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from graphloom.llm import oracle

    return dict(oracle.SQL)
