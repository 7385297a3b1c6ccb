"""Working tables of multi-round operators, in the folder of spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """A fresh folder that all executors see; a temporary one for local masters without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _OWN.setdefault(context.applicationId, "file://" + tempfile.mkdtemp(prefix="graphloom-"))
    return f"{base.rstrip('/')}/graphloom-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Write and read back."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
