"""Merging a stream of candidate nodes into a graph table, batch by batch.

An addition of this library: a wrapper of the merge operator as micro-batches.
Each batch writes a folder of its own, named by its number and overwritten when
the batch is run again, so a restart after a lost driver adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from graphloom.operators.graph import first_of, promotable


def merge_nodes(stream: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Add promotable candidates whose id the table lacks; ``stream`` has the
    columns of the table, which is a Parquet folder with a first batch in it."""

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = spark.read.option("basePath", table).parquet(table).where(F.col("batch") != number).select("id").distinct()
        new = first_of(batch.where(promotable()), "id").join(known, "id", "left_anti")
        new.select(*batch.columns).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
