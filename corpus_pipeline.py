"""The documents pipeline: each stage takes the documents that the last one
kept and returns documents; the last returns their tokens.

Stages, in order: documents that the quality classifier rejects go; one
document of each near-duplicate group stays; passages of the benchmark are cut
out; secrets are masked; texts are encoded and decoded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import bpe, cotrain, dartminhash, decontaminate, secrets
from graphloom.llm.queries import table, vocabulary
from graphloom.llm.store import cut, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with ``n_chars`` of the text as it is now."""
    return df.select(*(c for c in COLUMNS if c != "n_chars"), F.length("text").cast("bigint").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = cotrain.classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("keep").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dartminhash.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(decontaminate.remove_spans(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(secrets.redact(docs.select(*COLUMNS)))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret masking", mask_secrets),
    ("byte-level BPE", tokenise),
]

#: The classifier and the near-duplicate search are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"stage{k}", folder)
    return docs
