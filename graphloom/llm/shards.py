"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A row's shard is a function of its key and the number of shards only; with one
more shard, a row either stays or moves into the new one.  Slots number the
rows of a shard without gaps.  Null keys are the key 0 with a flag bit, so they
share a shard; a null text has size 1 and the CRC of the empty string; repeated
rows get slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm.store import ship
from graphloom.llm.texts import mix64

#: Each shard's rows are numbered in so many independent ranges of hashed rows.
SLOT_BUCKETS = 1024


def jump_hash(keys: np.ndarray, n: int) -> np.ndarray:
    """The shard in 0..n-1 of each 64-bit key, without a table."""
    key = mix64(keys)
    shard = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    jump = np.zeros(len(key), np.int64)
    while len(live):
        shard[live] = jump
        k = key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        jump = ((jump + 1) * (float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        go = jump < n
        live, jump = live[go], jump[go]
    return shard


def shard_of(key: Column, n: int) -> Column:
    """Column form; ``key`` is an integer column, null allowed."""

    @F.pandas_udf("int")
    def place(values: pd.Series) -> pd.Series:
        null = values.isna().to_numpy()
        keys = values.fillna(0).astype("int64").to_numpy().astype(np.uint64)
        return pd.Series(jump_hash(np.where(null, keys ^ np.uint64(1 << 63), keys), n).astype(np.int32))

    return place(key.cast("bigint"))


def assign(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``size, text_crc32, shard, grown_shard`` beside the key, one row per row."""
    ship(docs.sparkSession)
    k = F.col(key)
    return docs.select(
        k,
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        shard_of(k, shards).alias("shard"),
        shard_of(k, shards + 1).alias("grown_shard"),
    )


def number_slots(placed: DataFrame, buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard.

    Rows are ranked within hashed ranges of a shard; a range starts where the
    counts of those before it end.  Equal rows of one task of the scan are counted
    first and unfolded last; a key that holds a third of the table is as many rows
    as tasks here, in as many ranges, and none unfolds more than a task has read.
    """
    columns = placed.columns
    parts = placed.withColumn("_part", F.spark_partition_id())
    counted = parts.groupBy(*columns, "_part").agg(F.count("*").alias("_n")).withColumn("_range", F.pmod(F.xxhash64(*columns, "_part"), F.lit(buckets)).cast("int"))
    totals = counted.groupBy("shard", "_range").agg(F.sum("_n").alias("_total"))
    ahead = W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select("shard", "_range", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_base"))
    inside = W.partitionBy("shard", "_range").orderBy(*(F.col(c).asc_nulls_first() for c in (*columns, "_part") if c != "shard")).rowsBetween(W.unboundedPreceding, -1)
    ranked = counted.withColumn("_local", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    # at most shards x ranges rows, whatever the size of the table
    joined = ranked.join(F.broadcast(base), ["shard", "_range"])
    first = F.col("_base") + F.col("_local")
    return joined.select(*columns, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, key: str = "doc_id") -> None:
    """Write whole rows as Parquet, one folder per shard."""
    ship(docs.sparkSession)
    docs.withColumn("shard", shard_of(F.col(key), shards)).write.partitionBy("shard").parquet(path)
