"""Token files of directly addressable codes (Brisaboa, Ladra and Navarro, 2009).

An id is cut into chunks of a fixed number of bits; level k holds the k-th
chunks of all ids that have one, one after the other, and a bitmap that tells
which of them go on.  A rank directory over each bitmap gives the place on the
next level, so any id or range of ids is read without decoding what lies before.

A table of tokens is a folder of Parquet files whose rows are segments: some
consecutive documents, in ascending order of the key, with their lengths and
one coded block.  Order: nulls first, then the key; rows with equal keys follow
the hash of their text and then the place in the input.  A null text counts as
empty and has the end id only.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm.pieces import PieceEncoder
from graphloom.llm.store import shared_folder, ship
from graphloom.llm.texts import chunks, only

#: Ids in a segment, unless one document has more.
SEGMENT_IDS = 1 << 20
#: Bits of a bitmap between two entries of its rank directory.
RANK_EVERY = 512


def dac_encode(ids: np.ndarray, bits: int = 8) -> bytes:
    """Chunks of 8 or 16 bits."""
    kind = {8: np.uint8, 16: np.uint16}[bits]
    rest, levels = ids.astype(np.uint64), []
    while True:
        more = rest >> np.uint64(bits)
        on = more > 0
        padded = np.zeros(-(-max(len(on), 1) // RANK_EVERY) * RANK_EVERY, bool)
        padded[: len(on)] = on
        ranks = np.cumsum(padded.reshape(-1, RANK_EVERY).sum(1)).astype("<u4")
        directory = np.concatenate([np.zeros(1, "<u4"), ranks[:-1]]).astype("<u4")
        levels.append((rest.astype(kind).tobytes(), np.packbits(padded, bitorder="little").tobytes(), directory.tobytes(), len(rest)))
        if not on.any():
            break
        rest = more[on]
    head = [struct.pack("<4sBBxxQ", b"DAC1", bits, len(levels), len(ids))]
    head += [struct.pack("<QIII", n, len(a), len(b), len(c)) for a, b, c, n in levels]
    return b"".join(head + [x for level in levels for x in level[:3]])


class DacReader:
    def __init__(self, block: bytes):
        magic, self.bits, depth, self.n = struct.unpack_from("<4sBBxxQ", block)
        if magic != b"DAC1":
            raise ValueError("not a block of directly addressable codes")
        kind, at, self.levels = {8: np.uint8, 16: np.dtype("<u2")}[self.bits], 16 + 20 * depth, []
        for k in range(depth):
            n, *sizes = struct.unpack_from("<QIII", block, 16 + 20 * k)
            parts = []
            for size, of in zip(sizes, (kind, np.uint8, np.dtype("<u4"))):
                parts.append(np.frombuffer(block, of, size // np.dtype(of).itemsize, at))
                at += size
            self.levels.append((n, *parts))

    def rank(self, level: int, i: int) -> int:
        """Set bits before ``i``."""
        _, _, bitmap, directory = self.levels[level]
        block = i // RANK_EVERY
        if block >= len(directory):
            return int(directory[-1]) + int(np.unpackbits(bitmap[(len(directory) - 1) * RANK_EVERY // 8 :]).sum())
        inside = np.unpackbits(bitmap[block * RANK_EVERY // 8 : -(-i // 8)], bitorder="little")[: i - block * RANK_EVERY]
        return int(directory[block]) + int(inside.sum())

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi-1."""
        out = np.zeros(max(hi - lo, 0), np.uint64)
        live = np.arange(len(out))
        for k, (_, chunk, bitmap, _) in enumerate(self.levels):
            if hi <= lo:
                break
            out[live] |= chunk[lo:hi].astype(np.uint64) << np.uint64(self.bits * k)
            on = np.unpackbits(bitmap[lo // 8 : -(-hi // 8)], bitorder="little")[lo % 8 : lo % 8 + hi - lo].astype(bool)
            live = live[on]
            lo = self.rank(k, lo)
            hi = lo + len(live)
        return out

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])


class RowEncoder:
    """Ids and row offsets of a chunk: by pieces, or by ``whole`` for rows with one of ``added``."""

    def __init__(self, pieces: PieceEncoder, whole: Callable[[str], list[int]], added: list[bytes]):
        self.pieces, self.whole, self.added = pieces, whole, added

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, first = self.pieces(data, offsets)
        raw, rows = data.tobytes(), set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(token) <= offsets[row + 1]:
                    rows.add(row)
                at = raw.find(token, at + 1)
        if not rows:
            return ids, first
        size, parts, done = np.diff(first), [], 0
        for row in sorted(rows):
            own = self.whole(raw[offsets[row] : offsets[row + 1]].decode("utf-8"))
            parts += [ids[done : first[row]], np.array(own, np.uint32)]
            size[row], done = len(own), first[row + 1]
        return np.concatenate([*parts, ids[done:]]), np.concatenate([[0], np.cumsum(size)])


_ENCODERS: dict[str, RowEncoder] = {}


def library_encoder(path: str) -> RowEncoder:
    """The tokenizers library's model behind the memo of pieces; the library itself
    encodes the rows that hold an added token of the file."""
    only("token files", _ENCODERS.clear)
    if path not in _ENCODERS:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        library = Tokenizer.from_file(path)
        model = library.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(printable)]
        shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        assert set(shown.values()) == set(ByteLevel.alphabet())
        table = {b: shown[b] for b in range(256)}
        id_of = model.token_to_id

        def encode(piece: bytes) -> list[int]:
            text = piece.decode("latin-1").translate(table)
            whole = id_of(text)
            return [whole] if whole is not None else [t.id for t in model.tokenize(text)]

        added = [t.content.encode("utf-8") for t in library.get_added_tokens_decoder().values()]
        _ENCODERS[path] = RowEncoder(PieceEncoder(encode), lambda text: library.encode(text, add_special_tokens=False).ids, added)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0, bits: int = 8) -> None:
    """Encode every text, append ``end_id`` to each and write segments in key order."""
    ship(docs.sparkSession)
    ordered = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_at"))
    ordered = ordered.repartitionByRange("_key", "_hash", "_at").sortWithinPartitions("_key", "_hash", "_at").select("_key", "_text")

    def run(batches):
        encoder = library_encoder(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        keys, sizes, ids, held = [], [], [], 0

        def segment():
            nonlocal keys, sizes, ids, held, before
            flat = np.concatenate(ids)
            row = [[part], [before], [len(flat)], [keys], [sizes], [dac_encode(flat, bits)]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            before += len(flat)
            keys, sizes, ids, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names=["part", "before", "n", "keys", "sizes", "block"])

        for batch in batches:
            own = batch.column(0).to_pylist()
            for lo, hi, data, offsets in chunks(batch, "_text"):
                flat, first = encoder(data, offsets)
                count = np.diff(first)
                out = np.insert(flat, first[1:], end_id)
                keys += own[lo:hi]
                sizes += (count + 1).tolist()
                ids.append(out)
                held += len(out)
                if held >= SEGMENT_IDS:
                    yield segment()
        if keys:
            yield segment()

    ordered.mapInArrow(run, "part int, before bigint, n bigint, keys array<bigint>, sizes array<bigint>, block binary").write.option("compression", "zstd").parquet(path)


def read_tokens(spark, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: key, start, n_tokens, ids_crc32."""
    ship(spark)
    rows = spark.read.schema("part int, before bigint, n bigint, keys array<bigint>, sizes array<bigint>, block binary").parquet(path)
    # one row for each writing task; the running sum is over those few rows
    parts = rows.groupBy("part").agg(F.sum("n").alias("_n"))
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                part, before, _, keys, sizes, block = (batch.column(i)[r].as_py() for i in range(6))
                reader = DacReader(block)
                until = np.cumsum(sizes)
                starts = until - sizes
                crcs = [zlib.crc32(reader.slice(a, b).astype("<u4").tobytes()) for a, b in zip(starts.tolist(), until.tolist())]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(starts + before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["_key", "part", "_start", "n_tokens", "ids_crc32"],
                )

    found = rows.mapInArrow(run, "_key bigint, part int, _start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(parts, "part").select(F.col("_key").alias(key), (F.col("_start") + F.col("_base")).alias("start"), "n_tokens", "ids_crc32")


def tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files into the shared folder and read them back."""
    spark = docs.sparkSession
    path = shared_folder(spark) + "/tokens"
    write_tokens(docs, path, tokenizer, key, text)
    return read_tokens(spark, path, key)
