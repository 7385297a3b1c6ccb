"""Removal of lines that many documents share, by sharded minimal perfect hashes.

One scan hashes every line that is long enough to count and writes document and
hash; lines are counted by documents with partial aggregates.  The hashes that
enough documents have are dealt to shards.  Each shard is a minimal perfect hash
(bits by levels, a level for the hashes that collided in the one before) that
indexes three arrays: a fingerprint, the number of documents, and the document
that keeps the line.  The hashes of the documents then pass by the arrays of
their shard and probe them; no line and no text is joined to find what is
shared.  What a document loses is sent to it, and only the texts that may lose
something are sent, by a sieve of 4 MB.

A shard that is probed often is read in as many copies as it needs, so a line of
a third of all documents is no task of its own.  Shards are sized to about
16,384 hashes and are at most 16,384, which bounds what is broadcast: the number
of copies of each shard.

A line's key is the line without ASCII white space at its ends and with A-Z in
lower case.  A null or empty text is one empty line.  Every row is a document;
all rows of the largest id with a line keep it, and a null id is smaller than
all others.  Keys are 128-bit digests, of which 64 bits are the fingerprint.
Lines that are repeated in a document count once.  The id is an integer.  Other
columns are left as they are, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import cut, parted, schema_of, shared_folder, ship
from graphloom.llm.texts import SOLID_BYTES, U64, chunks, mix64

LEAST_CHARS = 40
LEAST_DOCS = 5
#: Hashes in a shard, and shards, at most as far as the first allows.
SHARD_KEYS = 1 << 14
MOST_SHARDS = 1 << 14
#: Documents that probe one copy of a shard.
COPY_PROBES = 1 << 15
_NO_ID = -(1 << 63)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- minimal perfect hash -------------------------------------------------------


def _place(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = U64((level * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(mix64(a ^ seed) + b) % U64(bits)).astype(np.int64)


class PerfectHash:
    """Numbers 0..n-1 for n pairs of 64-bit words; any number, or -1, for other pairs."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(a):
            bits = -(-2 * len(a) // 64) * 64
            at = _place(a, b, len(sizes), bits)
            n = np.bincount(at, minlength=bits)
            words.append(np.packbits(n == 1, bitorder="little").view("<u8"))
            sizes.append(bits)
            again = n[at] > 1
            a, b = a[again], b[again]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, open_, base = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
        for level, bits in enumerate(self.sizes):
            at = _place(a[open_], b[open_], level, bits) + base
            word, bit = self.words[at >> 6], (at & 63).astype(U64)
            hit = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1)))
            out[open_[hit]] = (self.before[at >> 6] + below)[hit]
            open_, base = open_[~hit], base + bits
        return out


class LineArrays:
    """A shard: the perfect hash of its keys and what it indexes."""

    TYPES = ("<u8", "<u8", "<i8", "<i8")

    def __init__(self, sizes: list[int], words: np.ndarray, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.index, self.prints, self.counts, self.keepers = PerfectHash(sizes, words), prints, counts, keepers

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> LineArrays:
        """Of distinct pairs: the second of each is its fingerprint."""
        index = PerfectHash.of(a, b)
        at = np.argsort(index(a, b))
        return cls(index.sizes, index.words, b[at], counts[at], keepers[at])

    def probe(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of documents of each pair, 0 for unknown ones, and the id that keeps the line."""
        if not len(self.prints):
            return np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        at = self.index(a, b)
        known = (at >= 0) & (self.prints[at] == b)
        return np.where(known, self.counts[at], 0), self.keepers[at]

    def packed(self) -> bytes:
        parts = (np.array(self.index.sizes, "<u8"), self.index.words, self.prints, self.counts, self.keepers)
        return np.array([len(x) for x in parts], "<u8").tobytes() + b"".join(x.astype(t).tobytes() for x, t in zip(parts, ("<u8", *self.TYPES)))

    @classmethod
    def unpacked(cls, raw: bytes) -> LineArrays:
        sizes, at, parts = np.frombuffer(raw, "<u8", 5).tolist(), 40, []
        for n, t in zip(sizes, ("<u8", *cls.TYPES)):
            parts.append(np.frombuffer(raw, t, n, at))
            at += 8 * n
        return cls(parts[0].tolist(), *parts[1:])


# -- lines ------------------------------------------------------------------------


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and the number of lines of each row."""
    breaks = np.flatnonzero(data == 10)
    n = np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=len(offsets) - 1) + 1
    return np.sort(np.concatenate([offsets[:-1], breaks + 1])), np.sort(np.concatenate([breaks, offsets[1:]])), n


def line_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lines have keys of at least ``least`` code points, and the digests
    of those: two 64-bit words each."""
    solid = np.flatnonzero(SOLID_BYTES[data])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    i, j = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = np.flatnonzero(i < j)
    a, b = solid[i[some]], solid[j[some] - 1] + 1
    enough = points[b] - points[a] >= least
    low = _LOWER[data].tobytes()
    digests = [blake2b(low[s:e], digest_size=16).digest() for s, e in zip(a[enough].tolist(), b[enough].tolist())]
    return some[enough], np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Columns c0, c1, ... and the id and content of each row."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    k, t = (f"c{names.index(x)}" for x in (key, text))
    return plain.withColumns({"_doc": F.coalesce(F.col(k).cast("bigint"), F.lit(_NO_ID).cast("bigint")), "_content": F.xxhash64(F.coalesce(F.col(t).cast("string"), F.lit(""))), "_text": F.col(t).cast("string")})


def line_hashes(rows: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``_doc, _content, a, b``: the distinct keys of each row."""

    def run(batches):
        for batch in batches:
            doc, content = batch.column(0), batch.column(1)
            for lo, _, data, offsets in chunks(batch, "_text"):
                starts, ends, n = line_spans(data, offsets)
                at, keys = line_keys(data, starts, ends, least)
                row = np.repeat(np.arange(len(n)), n)[at]
                order = np.lexsort((keys[:, 1], keys[:, 0], row))
                row, keys = row[order], keys[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (keys[1:] != keys[:-1]).any(1)
                own = pa.array(row[new] + lo)
                yield pa.RecordBatch.from_arrays([doc.take(own), content.take(own), *(pa.array(keys[new, i].view(np.int64)) for i in (0, 1))], names=["_doc", "_content", "a", "b"])

    return rows.select("_doc", "_content", "_text").mapInArrow(run, "_doc bigint, _content bigint, a bigint, b bigint")


def build_shards(common: DataFrame, shards: int) -> DataFrame:
    """``shard, arrays`` from ``a, b, n, keeper``: one row a shard."""

    def build(key, group):
        a, b = (group.column(x).to_numpy().view(np.uint64) for x in ("a", "b"))
        arrays = LineArrays.of(a, b, group.column("n").to_numpy(), group.column("keeper").to_numpy())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "arrays": pa.array([arrays.packed()], pa.binary())})

    return common.withColumn("shard", F.pmod("a", F.lit(shards)).cast("bigint")).groupBy("shard").applyInArrow(build, "shard bigint, arrays binary")


def probed(pairs: DataFrame, arrays: DataFrame, copies: DataFrame, shards: int, least: int) -> DataFrame:
    """Those of ``pairs`` that their document loses.  ``copies`` has a row per
    shard: the arrays lead each of as many runs of pairs, in one sorted stream."""
    names = list(pairs.columns)
    held = arrays.join(F.broadcast(copies), "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), *(F.lit(0).cast("bigint").alias(c) for c in pairs.columns), "arrays")
    asked = pairs.withColumn("shard", F.pmod("a", F.lit(shards)).cast("bigint")).join(F.broadcast(copies), "shard")
    asked = asked.select("shard", F.pmod(F.xxhash64("_doc", "_content"), F.col("copies")).alias("copy"), F.lit(1).alias("kind"), *pairs.columns, F.lit(None).cast("binary").alias("arrays"))

    def run(batches):
        current = None
        for batch in batches:
            kind = batch.column(2).to_numpy()
            doc, a, b = (batch.column(i).to_numpy() for i in (3, 5, 6))
            cuts = [*np.flatnonzero(kind == 0).tolist(), len(kind)]
            lo, lose = 0, np.zeros(len(kind), bool)
            for hi in cuts:
                if hi > lo:
                    n, keeper = current.probe(a[lo:hi].view(np.uint64), b[lo:hi].view(np.uint64))
                    lose[lo:hi] = (n >= least) & (keeper != doc[lo:hi])
                if hi < len(kind):
                    current, lo = LineArrays.unpacked(batch.column(7)[hi].as_py()), hi + 1
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3, 7)], names=names).filter(pa.array(lose))

    both = held.unionByName(asked).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    return both.mapInArrow(run, schema_of(pairs))


def _cleaned(docs: DataFrame, key: str, text: str, least_chars: int, least_docs: int) -> DataFrame:
    """Columns c0, c1, ... with ``_text`` as kept, ``_lines`` and ``_dropped``."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_folder(spark)
    rows = _identified(docs, key, text)
    pairs = cut(line_hashes(rows, least_chars), "pairs", folder)
    common = cut(pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("_doc").alias("keeper")).where(F.col("n") >= least_docs), "common", folder)
    size = common.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("probes")).first()
    shards = min(MOST_SHARDS, max(1, -(-size["keys"] // SHARD_KEYS)))
    each = min(COPY_PROBES, max(1 << 10, size["probes"] // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    arrays = cut(build_shards(common, shards), "arrays", folder)
    copies = common.groupBy(F.pmod("a", F.lit(shards)).cast("bigint").alias("shard")).agg(F.ceil(F.sum("n") / each).cast("bigint").alias("copies"))
    asked, _ = parted(pairs, "a", common.select("a"))
    lost = probed(asked, arrays, copies, shards, least_docs)
    lost = cut(lost.groupBy("_doc", "_content").agg(F.collect_set(F.struct("a", "b")).alias("_lost")), "lost", folder)
    may, sure = parted(rows, "_content", lost.select("_content"))
    told = may.join(lost, ["_doc", "_content"], "left").select(*rows.columns, "_lost")
    told = told.unionByName(sure.withColumn("_lost", F.lit(None).cast(lost.schema["_lost"].dataType)))

    def run(batches):
        for batch in batches:
            at, lists = batch.schema.get_field_index("_text"), batch.column(batch.schema.get_field_index("_lost"))
            kept, n_lines, n_dropped = [], [], []
            for lo, hi, data, offsets in chunks(batch, "_text"):
                starts, ends, n = line_spans(data, offsets)
                drop = np.zeros(len(starts), bool)
                own = lists.slice(lo, hi - lo)
                flat, first = own.flatten(), np.concatenate([[0], np.cumsum(np.nan_to_num(pc.list_value_length(own).to_numpy(zero_copy_only=False)))]).astype(np.int64)
                if len(flat):
                    row = np.repeat(np.arange(hi - lo), np.diff(first)).tolist()
                    gone = {*zip(row, flat.field(0).to_pylist(), flat.field(1).to_pylist())}
                    owner = np.repeat(np.arange(len(n)), n)
                    mine = np.flatnonzero((np.diff(first) > 0)[owner])
                    found, keys = line_keys(data, starts[mine], ends[mine], least_chars)
                    found, keys = mine[found], keys.view(np.int64)
                    drop[found] = [k in gone for k in zip(owner[found].tolist(), keys[:, 0].tolist(), keys[:, 1].tolist())]
                until = np.cumsum(n)
                lost_n = np.add.reduceat(drop, until - n).astype(np.int64)
                raw = data.tobytes()
                for r in range(hi - lo):
                    if lost_n[r]:
                        lines = range(until[r] - n[r], until[r])
                        kept.append(b"\n".join(raw[starts[i] : ends[i]] for i in lines if not drop[i]))
                    else:
                        kept.append(raw[offsets[r] : offsets[r + 1]])
                n_lines += n.tolist()
                n_dropped += lost_n.tolist()
            texts = pa.array(kept, pa.binary()).cast(pa.string())
            columns = [texts if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*batch.schema.names[:-1], "_lines", "_dropped"])

    return told.mapInArrow(run, f"{schema_of(rows)}, _lines bigint, _dropped bigint")


def remove_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` without the lines; null texts stay null."""
    names = docs.columns
    found = _cleaned(docs, key, text, least_chars, least_docs)
    own = [F.when(F.col(f"c{i}").isNotNull(), F.col("_text")).alias(c) if c == text else F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return found.select(*own)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Per document: its key, ``n_lines, n_dropped, kept_sha256``."""
    found = _cleaned(docs.select(key, text), key, text, least_chars, least_docs)
    return found.select(F.col("c0").alias(key), F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.sha2("_text", 256).alias("kept_sha256"))
