"""SpotSigs fingerprints (Theobald, Siddharth and Paepcke, 2008).

Common words are anchors; the chain of the next content words after an anchor
is a signature, and a text is the set of its signatures.  Its fingerprint lists
the hashes of that whole set and of the set of its word pairs, which stand in for
texts with too few anchors.  Sets are compared by the
Jaccard coefficient.  Only the pairs that are asked for are compared: similar texts
are not searched for, so sets are not dealt out by length.

Documents follow each other in ascending order of the key, nulls first, equal
keys by the hash of the text; rows equal in both are kept together.  After the
last comes the first, so a single document follows itself.  A null text counts
as empty; texts without words have one signature, of their bytes; the empty text
has none, and two empty fingerprints are alike (1.0).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import ship
from graphloom.llm.texts import LOWER_BYTES, WORD_BYTES, Hasher, chunks, mix64, rows_of, spans, windows

#: Common words of four languages.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his in is it its of on or she that the their they this to was we were which will with you not "
    "au aux avec ce cette dans de des du elle en est et il ils la le les leur mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous "
    "als am auch auf aus bei bin das dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch sich sie sind so und von vor war wie wir zu zum zur über "
    "al como con del desde el ella en entre era es esta este fue hay la las lo los más muy no nos o para pero por porque que se sin sobre son su sus también un una y ya"
).split()
CHAIN = 2
#: With fewer signatures, word pairs are compared.
FEW = 6


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode("utf-8") for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    until = np.cumsum([len(x) for x in raw])
    return np.unique(Hasher(data, LOWER_BYTES)(until - [len(x) for x in raw], until))


_ANCHOR_HASHES: list[np.ndarray] = []


def _distinct(row: np.ndarray, h: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """The distinct hashes of each row, in ascending order."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    return np.split(h, np.searchsorted(row, np.arange(1, n_rows))) if n_rows else []


def signature_sets(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(signatures, word pairs) of each row."""
    if not _ANCHOR_HASHES:
        _ANCHOR_HASHES.append(_hash_words(ANCHORS))
    anchors, n = _ANCHOR_HASHES[0], len(offsets) - 1
    starts, ends, first = spans(data, offsets, WORD_BYTES)
    exact = Hasher(data, LOWER_BYTES)
    h = exact(starts, ends)
    row = rows_of(first)
    common = anchors[np.minimum(np.searchsorted(anchors, h), len(anchors) - 1)] == h
    content, at = np.flatnonzero(~common), np.flatnonzero(common)
    k = np.searchsorted(content, at)
    fits = k + CHAIN <= len(content)
    at, k = at[fits], k[fits]
    same = row[content[k + CHAIN - 1]] == row[at] if len(at) else np.zeros(0, bool)
    at, k = at[same], k[same]
    chain = h[at]
    for i in range(CHAIN):
        chain = mix64(chain + h[content[k + i]])
    spots = _distinct(row[at], chain, n)
    pair_at, pair = windows(h, first, 2)
    single = np.flatnonzero(np.diff(first) == 1)
    bare = np.flatnonzero((np.diff(first) == 0) & (np.diff(offsets) > 0))
    whole = Hasher(data)(offsets[bare], offsets[bare + 1])
    pairs = _distinct(np.concatenate([row[pair_at], single, bare]), np.concatenate([pair, h[first[single]], whole]), n)
    return list(zip(spots, pairs))


def fingerprint(sets: tuple[np.ndarray, np.ndarray]) -> str:
    """Hex of the signatures, a colon and hex of the word pairs."""
    return ":".join(x.astype(">u8").tobytes().hex() for x in sets)


def parse(text: str) -> tuple[np.ndarray, np.ndarray]:
    spots, _, pairs = text.partition(":")
    return tuple(np.frombuffer(bytes.fromhex(x), ">u8").astype(np.uint64) for x in (spots, pairs))


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    kind = 0 if min(len(a[0]), len(b[0])) >= FEW else 1
    return _jaccard(a[kind], b[kind])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text."""
    ship(docs.sparkSession)
    names = [c for c in docs.columns if c != out]
    kept = docs.select(*names)

    def run(batches):
        for batch in batches:
            found = []
            for _, _, data, offsets in chunks(batch, text):
                found += [fingerprint(s) for s in signature_sets(data, offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*names, out])

    return kept.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + f", `{out}` string")


def _in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_range, _ahead, _key, _hash, _text``: ranges of consecutive documents,
    each followed by the first document of the next range (``_ahead``)."""
    spark = docs.sparkSession
    base = docs.select(F.col(key).cast("bigint").alias("_key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_hash"), F.coalesce(text, F.lit("")).alias("_text"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = base.select("_key", "_hash").repartitionByRange(n, F.col("_key").asc_nulls_first(), F.col("_hash"))
    # one row for each of the n ranges
    heads = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(F.col("_key").isNotNull().alias("v"), "_key", "_hash")).alias("m")).collect()
    bounds = sorted((bool(r.m.v), r.m._key or 0, r.m._hash) for r in heads)

    @F.pandas_udf("array<int>")
    def place(k: pd.Series, h: pd.Series) -> pd.Series:
        valid = k.notna()
        out = []
        for v, x, y in zip(valid.tolist(), k.fillna(0).astype("int64").tolist(), h.tolist()):
            own = (v, x, y)
            r = bisect_right(bounds, own) - 1
            out.append([r, (r - 1) % len(bounds)] if bounds[r] == own else [r])
        return pd.Series(out)

    dealt = base.select(F.posexplode(place("_key", "_hash")).alias("_ahead", "_range"), "_key", "_hash", "_text")
    return dealt.repartition("_range").sortWithinPartitions("_range", "_ahead", F.col("_key").asc_nulls_first(), "_hash")


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and the likeness
    of its own to the edited text's and to the next document's."""
    ship(docs.sparkSession)

    def table(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        edited = []
        for _, own, following in rows:
            half = len(own) // 2
            edited.append(own[: len(own) - half] + following[:half])
        column = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows] + edited + [r[2] for r in rows], pa.large_string())], names=["t"])
        sets = [s for _, _, data, offsets in chunks(column, "t") for s in signature_sets(data, offsets)]
        n = len(rows)
        own, changed, following = sets[:n], sets[n : 2 * n], sets[2 * n :]
        columns = [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited], pa.string()),
            pa.array(map(fingerprint, own), pa.string()),
            pa.array(map(fingerprint, changed), pa.string()),
            pa.array(map(likeness, own, changed), pa.float64()),
            pa.array(map(likeness, own, following), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        rows, held, last = [], 0, None
        for batch in batches:
            for where, ahead, k, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last is not None and last[0] == where:
                    rows.append((last[1], last[2], t))
                    held += len(last[2])
                    if held > 1 << 20:
                        yield table(rows)
                        rows, held = [], 0
                last = None if ahead else (where, k, t)
        if rows:
            yield table(rows)

    ordered = _in_order(docs, key, text).select("_range", "_ahead", "_key", "_text")
    return ordered.mapInArrow(run, f"`{key}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
