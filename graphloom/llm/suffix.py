"""Repeated strings by a depth-limited radix sort of suffixes.

Suffixes are ordered through their first ``length`` symbols only, by passes from
the most significant digit on, and a suffix whose group has no other member
drops out.  A pass over the plain prefixes of all suffixes would send a row for
every byte, many times the input, so digits are read around an anchor: the first
digit of a suffix is the least hashed short string of its window (the same string
wherever the window stands), together with those of its neighbours that have the
same one: such a run of starts is one row.  Later digits are ever longer middles
of the window around that string, for ever shorter runs, until the digit is the
whole window.  A run that equals another one as a whole is settled at once; one
of them stays to be compared.  Groups equal through the last digit are exactly
the windows that occur twice.

Two kinds of symbols go through the same passes: the bytes of the text, whose
repeated windows are removed, and its words (lower case), whose windows that more
than one document has are counted as passages.

Runs meet by hashes of 64 bits for a digit and 64 for a whole run.  A null text
counts as empty; texts shorter than a window have no window; equal texts, and
repeated rows, repeat all windows of each other; an empty table gives an empty
result.  Rows are told apart by a hash of their key and text, so they have the
same name in every scan; rows equal in both are one document to passages.
Columns of the input are renamed inside, so no name of theirs clashes.
"""

from __future__ import annotations

import functools
import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import cut, forget, schema_of, shared_folder, ship
from graphloom.llm.texts import CHUNK_BYTES, LOWER_BYTES, WORD_BYTES, Hasher, chunks, mix64, spans, take_columns

_U = np.uint64


class Scale(NamedTuple):
    """Symbols of a window, of its anchor, and of a run in the second pass."""

    length: int
    anchor: int
    inner: int


BYTES, WORDS = Scale(400, 32, 16), Scale(50, 4, 8)
#: Bits of the sieve that keeps rows without need of it from being sent.
_SIEVE = 1 << 25


def _anchors(data: np.ndarray, exact: Hasher, length: int, anchor: int) -> np.ndarray:
    """For each start of ``length`` bytes, the place of the leftmost least anchor in them."""
    n = len(data) - anchor + 1
    width = length - anchor + 1
    value = exact.every(anchor)
    value &= _U(0xFFFFFFFF00000000)
    value |= np.arange(n, dtype=_U)
    padded = np.full(-(-n // width) * width, np.iinfo(_U).max, _U)
    padded[:n] = value
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - width + 1
    return (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & _U(0xFFFFFFFF)).astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray, block: int, allowed: tuple[np.ndarray, np.ndarray, np.ndarray] | None, length: int, anchor: int):
    """Runs of starts: (row, digit, whole, first start, one after the last start),
    starts from the row's own beginning.  ``allowed``: rows and ranges of starts in them."""
    empty = (np.zeros(0, np.int64),) * 5
    if len(data) < length:
        return empty
    if allowed is None:
        has = np.diff(offsets) >= length
        lo, hi = offsets[:-1][has], offsets[1:][has] - length + 1
    else:
        lo, hi = (offsets[allowed[0]] + x for x in allowed[1:])
    if not len(lo):
        return empty
    count = np.zeros(len(data) + 1, np.int32)
    np.add.at(count, lo, 1)
    np.add.at(count, hi, -1)
    s = np.flatnonzero(np.cumsum(count) > 0)
    exact = Hasher(data)
    p = _anchors(data, exact, length, anchor)[s]
    part = (p - s) // block
    new = np.ones(len(s), bool)
    new[1:] = (p[1:] != p[:-1]) | (part[1:] != part[:-1]) | (s[1:] != s[:-1] + 1)
    row = np.searchsorted(offsets, s, "right") - 1
    new[1:] |= row[1:] != row[:-1]
    i = np.flatnonzero(new)
    first, last = s[i], s[np.append(i[1:], len(s)) - 1]
    p, part, row = p[i], part[i], row[i]
    far = np.minimum(part * block + block - 1, length - anchor)
    digit = mix64(exact(p - part * block, p - far + length) + (part + block * 1000).astype(_U))
    whole = mix64(exact(first, last + length) + ((p - first) * 1000 + (p - last)).astype(_U))
    return row, digit.view(np.int64), whole.view(np.int64), first - offsets[row], last + 1 - offsets[row]


def _sieve(rows: DataFrame, column: str):
    """Bits of the rows named in ``column``: 4 MB, whatever their number."""
    place = F.pmod(F.xxhash64(column), F.lit(_SIEVE))
    bits = rows.select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()
    table = np.zeros(_SIEVE // 8, np.uint8)
    for r in bits:
        m = np.frombuffer(bytes(r.m), np.uint8)
        table[(r.b - 1) * 4096 : (r.b - 1) * 4096 + len(m)] = m
    return rows.sparkSession.sparkContext.broadcast(table)


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(_SIEVE)).cast("int").alias("_p")


def _packed(docs: DataFrame, sieve) -> DataFrame:
    """``_row, _key, n_bytes, _sha, _z`` of ``_row, _key, _text, _p``: the packed
    text of rows that the sieve lets through, the SHA-256 of others."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            places = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            through = (sieve.value[places // 8] >> (places % 8).astype(np.uint8) & 1).astype(bool)
            for lo, hi, data, offsets in chunks(batch, "_text"):
                raw, sha, packed = data.tobytes(), [], []
                for yes, a, b in zip(through[lo:hi].tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    sha.append(None if yes else hashlib.sha256(raw[a:b]).hexdigest())
                    packed.append(packer.compress(raw[a:b]) if yes else None)
                yield pa.RecordBatch.from_arrays([*take_columns(batch, ["_row", "_key"], lo, hi), pa.array(np.diff(offsets)), pa.array(sha, pa.string()), pa.array(packed, pa.binary())], names=["_row", "_key", "n_bytes", "_sha", "_z"])

    return docs.mapInArrow(run, f"_row bigint, _key {docs.schema['_key'].dataType.simpleString()}, n_bytes bigint, _sha string, _z binary")


_RUN = "_row bigint, unit int, digit bigint, whole bigint, a int, b int"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and the index of each row's first."""
    starts, ends, first = spans(data, offsets, WORD_BYTES)
    return Hasher(data, LOWER_BYTES)(starts, ends), first


def _batch(row_ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, turn: int, scales: list[Scale], allowed: tuple | None = None) -> pa.RecordBatch:
    """The runs of a pass in both kinds of symbols; ``allowed``: rows, units and ranges."""
    parts = []
    for unit, scale in enumerate(scales):
        symbols, first = _words(data, offsets) if unit else (data, offsets)
        block = (scale.length - scale.anchor + 1, scale.inner, 1)[turn]
        own = None if allowed is None else tuple(allowed[i][allowed[1] == unit] for i in (0, 2, 3))
        row, digit, whole, a, b = runs(symbols, first, block, own, scale.length, scale.anchor)
        salt = _U(unit * 0x5851F42D4C957F2D)
        parts.append((row_ids[row], np.full(len(row), unit, np.int32), digit ^ salt.astype(np.int64), whole ^ salt.astype(np.int64), a.astype(np.int32), b.astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["_row", "unit", "digit", "whole", "a", "b"])


def _first_pass(docs: DataFrame, scales: list[Scale]) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in chunks(batch, "_text"):
                yield _batch(ids[lo:hi], data, offsets, 0, scales)

    return docs.select("_row", "_text").mapInArrow(run, _RUN)


def _lists(column: pa.Array, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each row's structs begin (one entry more than rows), and their fields."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int64), [flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in names]


def _next_pass(docs: DataFrame, open_runs: DataFrame, turn: int, scales: list[Scale]) -> DataFrame:
    """Runs of a shorter block within the runs that are open."""
    wanted = open_runs.groupBy("_row").agg(F.collect_list(F.struct("unit", "a", "b")).alias("r"))
    packed = _packed(docs, _sieve(open_runs, "_row")).where("_z is not null").select("_row", "_z")
    both = packed.join(wanted, "_row").select("_row", "_z", "r")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            first, fields = _lists(batch.column(2), "unit", "a", "b")
            at = 0
            while at < batch.num_rows:
                end, size, raw = at, 0, []
                while end < batch.num_rows and size < CHUNK_BYTES:
                    raw.append(unpack(batch.column(1)[end].as_buffer()))
                    size += len(raw[-1])
                    end += 1
                owner = np.repeat(np.arange(end - at), np.diff(first[at : end + 1]))
                allowed = (owner, *(x[first[at] : first[end]] for x in fields))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
                yield _batch(ids[at:end], np.frombuffer(b"".join(raw), np.uint8), offsets, turn, scales, allowed)
                at = end

    return both.mapInArrow(run, _RUN)


def repeated(docs: DataFrame, folder: str, scales: list[Scale]) -> DataFrame:
    """``_row, unit, a, b``: ranges of symbols covered by windows that occur again
    (words: in another document), for ``docs`` of ``_row, _key, _text, _p``."""
    settled, rows = [], None
    reach = F.col("b") + F.element_at(F.array(*(F.lit(s.length - 1) for s in scales)), F.col("unit") + 1)
    again = (F.col("n") > 1) & ((F.col("u") == 0) | (F.col("r") != F.col("q")))
    counted = F.count("*").alias("n"), F.min("unit").alias("u"), F.min("_row").alias("r"), F.max("_row").alias("q")
    for turn in range(3):
        rows = cut(_next_pass(docs, rows, turn, scales) if turn else _first_pass(docs, scales), f"runs{turn}", folder)
        digits = rows.groupBy("digit").agg(*counted, F.min("whole").alias("x"), F.max("whole").alias("y"))
        digits = cut(digits.where(again).select("digit", (F.col("x") != F.col("y")).alias("mixed")), f"digits{turn}", folder)
        met = cut(rows.join(digits, "digit"), f"met{turn}", folder)
        settled.append(met.where("not mixed").select("_row", "unit", "a", reach.alias("b")))
        mixed = met.where("mixed")
        same = cut(mixed.groupBy("digit", "whole").agg(*counted).where(again).select("digit", "whole", "r"), f"same{turn}", folder)
        judged = mixed.join(same, ["digit", "whole"], "left").select("_row", "unit", "a", "b", F.col("r").isNotNull().alias("again"), (F.col("r").isNull() | (F.col("_row") == F.col("r"))).alias("open"))
        judged = cut(judged, f"judged{turn}", folder)
        # what is judged depends on its own table only
        forget(docs.sparkSession, folder, f"runs{turn}", f"digits{turn}", f"same{turn}")
        settled.append(judged.where("again").select("_row", "unit", "a", reach.alias("b")))
        rows = judged.where("open").select("_row", "unit", "a", "b").distinct()
    return functools.reduce(DataFrame.unionByName, settled)


def _covered(size: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """Whether each byte is covered, and the number of maximal covered runs."""
    edge = np.bincount(a, minlength=size + 1) - np.bincount(np.minimum(b, size), minlength=size + 1)
    on = np.cumsum(edge[:size]) > 0
    return on, int(on[:1].sum() + (on[1:] & ~on[:-1]).sum())


def _marked(docs: DataFrame, key: str, text: str, scales: list[Scale]) -> tuple[DataFrame, DataFrame]:
    """(``_row, _key, n_bytes, _sha, _z, r, w`` for each row, with the ranges to
    remove and those of passages; the rows with their names, columns as ``c0, c1, ...``)."""
    ship(docs.sparkSession)
    folder = shared_folder(docs.sparkSession)
    inner = [f"c{i}" for i in range(len(docs.columns))]
    own, whole = (inner[docs.columns.index(x)] for x in (key, text))
    named = docs.toDF(*inner).withColumn("_row", F.xxhash64(own, whole))
    base = named.select("_row", F.col(own).alias("_key"), F.col(whole).alias("_text"), _place("_row"))
    # a range is one number; rows that are there several times have each of theirs once
    both = F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")
    lists = (F.collect_set(F.when(F.col("unit") == u, both)).alias(x) for u, x in enumerate("rw"))
    grouped = cut(repeated(base, folder, scales).groupBy("_row").agg(*lists), "grouped", folder)
    forget(docs.sparkSession, folder, *(f"{name}{turn}" for name in ("met", "judged") for turn in range(3)))
    return _packed(base, _sieve(grouped.where("size(r) > 0"), "_row")).join(grouped, "_row", "left"), named


def _ranges(column: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Where each row's ranges begin (one entry more than rows), and their ends."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int64), (flat >> 32, flat & 0xFFFFFFFF)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", window: Scale = BYTES, passage: Scale = WORDS) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, SHA-256 of the bytes that stay;
    ``n_passage_words`` and ``n_passages``: words, and maximal runs of them, in
    windows of ``passage`` words that another document has too."""
    marked, _ = _marked(docs, key, text, [window, passage])
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            keys, sizes, sha, packed, ranges, words = (batch.column(i) for i in range(6))
            removed, runs_, passage_words, passages = (np.zeros(batch.num_rows, np.int64) for _ in range(4))
            kept = sha.to_pylist()
            (of_bytes, (a, b)), (of_words, (c, d)) = _ranges(ranges), _ranges(words)
            for i in np.flatnonzero(np.diff(of_words)).tolist():
                own = slice(of_words[i], of_words[i + 1])
                on, passages[i] = _covered(int(d[own].max()), c[own], d[own])
                passage_words[i] = on.sum()
            for i in np.flatnonzero(pc.is_valid(packed).to_numpy(zero_copy_only=False)).tolist():
                raw, own = unpack(packed[i].as_buffer()), slice(of_bytes[i], of_bytes[i + 1])
                if of_bytes[i] < of_bytes[i + 1]:
                    on, runs_[i] = _covered(len(raw), a[own], b[own])
                    removed[i] = on.sum()
                    raw = np.frombuffer(raw, np.uint8)[~on].tobytes()
                kept[i] = hashlib.sha256(raw).hexdigest()
            counts = [pa.array(x) for x in (removed, runs_, passage_words, passages)]
            yield pa.RecordBatch.from_arrays([keys, sizes, *counts[:2], pa.array(kept, pa.string()), *counts[2:]], names=["_key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "n_passages"])

    out = marked.select("_key", "n_bytes", "_sha", "_z", "r", "w").mapInArrow(run, f"_key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_passage_words bigint, n_passages bigint")
    return out.withColumnRenamed("_key", key)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", window: Scale = BYTES) -> DataFrame:
    """``docs`` without the covered bytes; a character that is cut is dropped."""
    marked, named = _marked(docs, key, text, [window])
    names = [c for c in named.columns if c != "_row"]
    ranges = marked.where("size(r) > 0").select("_row", "r").dropDuplicates(["_row"])
    joined = named.join(ranges, "_row", "left").select(*names, "r")
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts, (first, (a, b)) = batch.column(at).to_pylist(), _ranges(batch.column(len(names)))
            for i in np.flatnonzero(np.diff(first)).tolist():
                if texts[i]:
                    raw, own = np.frombuffer(texts[i].encode("utf-8"), np.uint8), slice(first[i], first[i + 1])
                    texts[i] = raw[~_covered(len(raw), a[own], b[own])[0]].tobytes().decode("utf-8", "ignore")
            yield pa.RecordBatch.from_arrays([batch.column(i) if i != at else pa.array(texts, pa.string()) for i in range(len(names))], names=names)

    return joined.mapInArrow(run, schema_of(named.select(*names))).toDF(*docs.columns)
