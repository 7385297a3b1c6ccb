"""Importance resampling towards a target distribution, by external sort-count.

Texts become streams of hashed features: one scan packs the bucket of every
feature into unsigned 16-bit streams, a row per chunk of documents with the
documents' offsets, and writes them.  The streams are sorted and run-length
encoded for the bucket counts of the raw and of the target table; the log ratio
of the two is a bucket's gain.  The streams are then read again, the gains
gathered and added up per document with ``np.add.reduceat``.  Documents are
drawn by weight plus Gumbel noise from a hash of their id, highest first.

What is collected are the counts, one row a bucket, of which there are at most
65,536; texts are read once and never shuffled.

Words are runs of ASCII letters and digits and of non-ASCII characters, with
A-Z in lower case; a null or empty text has none, weight 0, and can be drawn
only if no words are asked for.  A null id hashes as the empty text and comes
first among ties.  Repeated rows are rows of their own: they weigh the same and
take ranks beside each other.  An empty table gives no rows, an empty target
counts as no features.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import cut, shared_folder, ship
from graphloom.llm.texts import WORD_BYTES, chunks, spans
from graphloom.operators.ordered import ranked

BUCKETS = 10_000
#: Spans longer than this are hashed one by one.
LONG = 64
#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), c >> np.uint32(1))
    return c


_TABLE = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span: all spans advance a byte at a time, shortest first out."""
    size = ends - starts
    order = np.argsort(size, kind="stable")
    size, at = size[order], starts[order]
    state = np.full(len(size), 0xFFFFFFFF, np.uint32)
    until = np.searchsorted(size, LONG, "right")
    for k in range(int(size[until - 1]) if until else 0):
        lo = np.searchsorted(size[:until], k, "right")
        s = state[lo:until]
        state[lo:until] = _TABLE[(s ^ data[at[lo:until] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = np.empty(len(size), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in range(until, len(size)):
        out[order[i]] = zlib.crc32(data[at[i] : at[i] + size[i]])
    return out


def feature_buckets(data: np.ndarray, offsets: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features row after row, the features of each row, and its words."""
    starts, ends, first = spans(data, offsets, WORD_BYTES)
    size = ends - starts
    until = np.cumsum(size + 1)  # words in lower case, each followed by a space
    at = until - size - 1
    plain = np.full(int(until[-1]) if len(until) else 0, 32, np.uint8)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    plain[np.repeat(at, size) + inside] = _LOWER[data[np.repeat(starts, size) + inside]]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found, owner = [], []
    for n in range(1, longest + 1):
        m = len(at) - n + 1
        if m > 0:
            whole = np.flatnonzero(row[:m] == row[n - 1 :])
            found.append(crc32_of_spans(plain, at[whole], until[whole + n - 1] - 1) % np.uint32(buckets))
            owner.append(row[whole])
    found, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, owner))
    if longest > 1:
        found = found[np.argsort(owner, kind="stable")]
    return found.astype("<u2"), np.bincount(owner, minlength=len(first) - 1), np.diff(first)


def streams(docs: DataFrame, key: str = "doc_id", text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``keys, words, offsets, stream``, a row per chunk of documents: the ids, the
    numbers of words, where each document's features begin (one entry more than
    documents) and the packed buckets."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered in 16 bits")
    ship(docs.sparkSession)
    base = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = base.schema["_key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, data, offsets in chunks(batch, "_text"):
                stream, features, words = feature_buckets(data, offsets, longest, buckets)
                begin = np.concatenate([[0], np.cumsum(features)]).astype("<i8")
                own = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), keys.slice(lo, hi - lo))
                packed = [pa.array([x.tobytes()], pa.binary()) for x in (words.astype("<i8"), begin, stream)]
                yield pa.RecordBatch.from_arrays([own, *packed], names=["keys", "words", "offsets", "stream"])

    return base.mapInArrow(run, f"keys array<{kind}>, words binary, offsets binary, stream binary")


def run_lengths(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a stream in order, and how often each is there."""
    ordered = np.sort(stream)
    head = np.flatnonzero(np.concatenate([[len(ordered) > 0], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[head], np.diff(np.concatenate([head, [len(ordered)]]))


def bucket_counts(packed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` of the buckets in use.  Each stream is sorted and run-length
    encoded; a task adds up its runs, so it sends a row a bucket at most."""
    ship(packed.sparkSession)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for stream in batch.column(0):
                value, n = run_lengths(np.frombuffer(stream.as_buffer(), "<u2"))
                total[value] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return packed.select("stream").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` of all buckets: 1000 times the log ratio of their smoothed
    shares of the target's and of the raw features, floored."""
    each = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t")).unionByName(target.select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("n").alias("t")))
    summed = each.join(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "bucket", "left").na.fill(0, ["s", "t"])
    whole = summed.agg(F.sum("s").alias("_s"), F.sum("t").alias("_t"))
    s, t, S, T = (F.col(x).cast("double") for x in ("s", "t", "_s", "_t"))
    return summed.join(F.broadcast(whole)).select("bucket", F.floor(1000 * F.log((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))).cast("bigint").alias("gain"))


def weigh(packed: DataFrame, gain: np.ndarray) -> DataFrame:
    """``key, n_words, n_features, weight`` per document: the floored mean gain of its features."""
    ship(packed.sparkSession)
    kind = packed.schema["keys"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                words, begin = (np.frombuffer(batch.column(i)[r].as_buffer(), "<i8") for i in (1, 2))
                stream = np.frombuffer(batch.column(3)[r].as_buffer(), "<u2")
                n = np.diff(begin)
                some = np.flatnonzero(n)
                weight = np.zeros(len(n), np.int64)
                if len(some):
                    weight[some] = np.add.reduceat(gain[stream], begin[some]) // n[some]
                yield pa.RecordBatch.from_arrays([batch.column(0)[r].values, *(pa.array(x, pa.int64()) for x in (words, n, weight))], names=["key", "n_words", "n_features", "weight"])

    return packed.select("keys", "words", "offsets", "stream").mapInArrow(run, f"key {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1, buckets: int = BUCKETS, seed: int = 2024, least_words: int = 20, percent: int = 10
) -> DataFrame:
    """Per document: its key, ``n_features, weight, score, rank``.  Of the
    documents of at least ``least_words`` words ``percent`` in 100 are drawn, by
    score and then by key; the others have no rank."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    packed = cut(streams(docs, key, text, longest, buckets), "streams", folder)
    wanted = streams(target.select(F.lit(None).cast("int").alias("_none"), F.col(target_text).alias("_text")), "_none", "_text", longest, buckets)
    rows = gains(bucket_counts(packed, buckets), bucket_counts(wanted, buckets), buckets).collect()
    gain = np.zeros(buckets, np.int64)
    for r in rows:
        gain[r.bucket] = r.gain

    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(seeded, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(weigh(packed, gain).withColumn("score", F.col("weight") + noise), "scored", folder)
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    order = (F.col("score").desc(), F.col("key").asc_nulls_first())
    in_order = ranked(scored.where(able), lambda df, name: cut(df, name, folder), *order)
    place = F.when(F.col("rank") <= drawn, F.col("rank"))
    both = in_order.withColumn("rank", place).unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("bigint")))
    return both.select(F.col("key").alias(key), "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose key is drawn."""
    chosen = resample(docs, target, key, **options).where("rank is not null").select(F.col(key).alias("_drawn")).distinct()
    return docs.join(chosen, docs[key].eqNullSafe(chosen["_drawn"]), "left_semi")
