"""Working tables in the folder that driver and executors share.

The folder is the session's ``spark.checkpoint.dir``; where the setting is
absent (tests on a local master) a temporary folder is made and set.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        base = context.getCheckpointDir() or _LOCAL.get(context.applicationId)
        if not base:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="graphloom-")
            context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/graphloom-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, folder: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage
    ends there, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}"
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete working tables that nothing will read again."""
    context = spark.sparkContext
    for name in names:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of a sieve.
SIEVE = 1 << 25


def parted(rows: DataFrame, column: str, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose ``column`` may be one of ``named``'s, and those
    whose surely isn't, so that only the first have to be sent to a join.  What is
    broadcast is a sieve of at most 1,024 rows of 4 KB, however many are named."""
    place = F.pmod(F.xxhash64(column), F.lit(SIEVE)) + 1
    bits = named.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))
    tried = rows.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place")).join(F.broadcast(bits), "_bucket", "left")
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce((F.floor(byte / F.pow(F.lit(2), at % 8)) % 2) == 1, F.lit(False))
    tried = tried.withColumn("_hit", hit)
    return tuple(tried.where(c).select(*rows.columns) for c in ("_hit", "not _hit"))


def schema_of(df: DataFrame) -> str:
    """The columns as DDL, as ``mapInArrow`` takes it."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch that is sent to a Python worker, if the session has no limit of its own: rows of long texts are sent a few at a time.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run."""
    context = spark.sparkContext
    name, default, ours = _BATCH
    if spark.conf.get(name) == default:
        spark.conf.set(name, ours)
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    path = os.path.join(tempfile.mkdtemp(prefix="graphloom-"), "graphloom_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted((root / "graphloom").rglob("*.py")):
            z.write(file, file.relative_to(root))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
