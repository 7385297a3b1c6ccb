"""Benchmark decontamination by a broadcast set of word windows.

The windows of the test items are hashed into a set that every task holds; the
windows of each text are looked up in it, hits are compared word for word, and
the words inside any occurrence are hit.  The items are taken in blocks of a
bounded number of bytes, repeated ones once: one block is one pass over the
texts, and what several passes find for a row is put together, so no broadcast
grows with the benchmark.  A set is a few flat arrays, about four bytes for each
byte of its items (``WindowSet.nbytes``).

Words are runs of ASCII letters and digits and of non-ASCII characters, with
A-Z in lower case.  An item with fewer words than a window is one window; an
item without words, like a null text, has none.  Items that are repeated or
share windows all count.  A null item id is hit like others and not listed.  The
columns of the documents may have any names: ``remove_spans`` gives back all of
them, ``hits`` all but those named like the three that it adds.  An empty table
or benchmark gives no rows or no hits.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import cut, schema_of, shared_folder, ship
from graphloom.llm.texts import LOWER_BYTES, WORD_BYTES, Hasher, chunks, only, rows_of, spans, windows

WIDTH = 10
#: Bytes of item text in a block; the set of a block is about four times as large.
BLOCK_BYTES = 16 << 20
_SIEVE_BITS = 20


class WindowSet:
    """Windows of test items by length and hash: for each length the sorted
    hashes and the first word of each, over the items' words as plain text."""

    def __init__(self, items: list[tuple[str | None, str]], width: int = WIDTH):
        raw = [(t or "").encode("utf-8") for _, t in items]
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        starts, ends, first = spans(data, offsets, WORD_BYTES)
        hashes = Hasher(data, LOWER_BYTES)(starts, ends)
        n_words, size = np.diff(first), ends - starts
        self.ids = [x for x, _ in items]
        self.item = rows_of(first).astype(np.int32)
        # the words in lower case, each followed by a blank
        self.begin = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int32)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        words = np.full(int(self.begin[-1]), 32, np.uint8)
        words[np.repeat(self.begin[:-1].astype(np.int64), size) + inside] = data[np.repeat(starts, size) + inside]
        self.words = words.tobytes().lower()
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({min(int(n), width) for n in np.unique(n_words) if n}):
            at, h = windows(hashes, first, length)
            good = n_words[self.item[at]] == length if length < width else np.ones(len(at), bool)
            order = np.argsort(h[good], kind="stable")
            self.windows[length] = h[good][order], at[good][order].astype(np.int32)

    @property
    def nbytes(self) -> int:
        """Of the arrays, of which all but the ids are made."""
        return self.item.nbytes + self.begin.nbytes + len(self.words) + sum(k.nbytes + a.nbytes for k, a in self.windows.values())

    def sieve(self, length: int) -> np.ndarray:
        out = np.zeros(1 << _SIEVE_BITS, bool)
        out[self.windows[length][0] >> np.uint64(64 - _SIEVE_BITS)] = True
        return out

    def said(self, word: int, length: int) -> bytes:
        return self.words[self.begin[word] : self.begin[word + length] - 1]


class Searcher:
    """A set, and a sieve before each of its lengths."""

    def __init__(self, known: WindowSet):
        self.known, self.sieves = known, {n: known.sieve(n) for n in known.windows}

    def search(self, data: np.ndarray, offsets: np.ndarray):
        """Spans of words, each row's first, whether a word is hit, and the items of each row."""
        starts, ends, first = spans(data, offsets, WORD_BYTES)
        edge = np.zeros(len(starts) + 1, np.int64)
        found: dict[int, set[int]] = defaultdict(set)
        known = self.known
        if known.windows and len(starts):
            hashes = Hasher(data, LOWER_BYTES)(starts, ends)
            row, lower = rows_of(first), None
            for length, (keys, words) in known.windows.items():
                at, h = windows(hashes, first, length)
                near = np.flatnonzero(self.sieves[length][h >> np.uint64(64 - _SIEVE_BITS)])
                lo, hi = (np.searchsorted(keys, h[near], side) for side in ("left", "right"))
                same = lo < hi
                if same.any() and lower is None:
                    lower = data.tobytes().lower()
                for a, x, y in zip(at[near[same]].tolist(), lo[same].tolist(), hi[same].tolist()):
                    own = b" ".join(lower[s:e] for s, e in zip(starts[a : a + length].tolist(), ends[a : a + length].tolist()))
                    alike = [w for w in words[x:y].tolist() if known.said(w, length) == own]
                    if alike:
                        edge[a] += 1
                        edge[a + length] -= 1
                        found[int(row[a])].update(known.item[alike].tolist())
        return starts, ends, first, np.cumsum(edge[:-1]) > 0, found


_SETS: dict[str, Searcher] = {}


def _held(token: str, known) -> Searcher:
    only("windows", _SETS.clear)
    if token not in _SETS:
        _SETS.clear()
        _SETS[token] = Searcher(known.value)
    return _SETS[token]


def _blocks(bench: DataFrame, item: str, text: str, width: int, block_bytes: int):
    """Broadcast sets of bounded blocks of items."""
    items = bench.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull()).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()
        yield bench.sparkSession.sparkContext.broadcast(WindowSet([tuple(r) for r in rows], width))


_RUNS = "array<struct<a:bigint,b:bigint,`from`:bigint,`to`:bigint>>"


def _searched(source: DataFrame, text: str, known, width: int) -> DataFrame:
    """``source`` with ``_words``, ``_runs`` and ``_items``."""
    token, names = uuid.uuid4().hex, source.columns
    run_type = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])

    def run(batches):
        held = _held(token, known)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch, text):
                starts, ends, first, hit, found = held.search(data, offsets)
                runs, items = [], []
                for r in range(hi - lo):
                    own = []
                    if r in found:
                        a, b = first[r], first[r + 1]
                        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit[a:b], [False]]).astype(np.int8)))
                        for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                            own.append({"a": x, "b": y, "from": int(starts[a + x] - offsets[r]), "to": int(ends[a + y - 1] - offsets[r])})
                    runs.append(own)
                    items.append(sorted({held.known.ids[i] for i in found.get(r, ()) if held.known.ids[i] is not None}))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns), pa.array(np.diff(first), pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(items, pa.list_(pa.string()))], names=[*names, "_words", "_runs", "_items"])

    return source.mapInArrow(run, f"{schema_of(source)}, _words bigint, _runs {_RUNS}, _items array<string>")


def _plain_hits(docs: DataFrame, bench: DataFrame, text: str, item: str, item_text: str, width: int, block_bytes: int) -> DataFrame:
    """Columns c0, c1, ... of ``docs`` with what is found in them."""
    ship(docs.sparkSession)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    own = f"c{docs.columns.index(text)}"
    blocks = list(_blocks(bench, item, item_text, width, block_bytes))
    if len(blocks) == 1:
        return _searched(plain, own, blocks[0], width)
    # several passes over rows that are numbered once; only rows with hits are brought together
    numbered = cut(plain.withColumn("_row", F.monotonically_increasing_id()), "numbered", shared_folder(docs.sparkSession))
    found = None
    for block in blocks:
        part = _searched(numbered.select(own, "_row"), own, block, width).where(F.size("_runs") > 0).drop(own, "_words")
        found = part if found is None else found.unionByName(part)
    found = found.groupBy("_row").agg(F.flatten(F.collect_list("_runs")).alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("i"))

    def merge(acc, x):
        last = F.element_at(acc, -1)
        joined = F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"), last["from"].alias("from"), F.greatest(last["to"], x["to"]).alias("to"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["b"] >= x["a"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(x)))

    found = found.select("_row", F.aggregate(F.array_sort("r"), F.array().cast(_RUNS), merge).alias("r"), "i")
    words = _searched(numbered, own, docs.sparkSession.sparkContext.broadcast(WindowSet([], width)), width).drop("_runs", "_items")
    return words.join(found, "_row", "left").select(*plain.columns, "_words", F.coalesce("r", F.array().cast(_RUNS)).alias("_runs"), F.coalesce("i", F.array().cast("array<string>")).alias("_items"))


def hits(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_runs`` (index of the first word and of
    the one after the last, and the same as byte offsets) and ``hit_items``."""
    added = {"n_words": "_words", "hit_runs": "_runs", "hit_items": "_items"}
    found = _plain_hits(docs, bench, text, item, item_text, width, block_bytes)
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added]
    return found.select(*own, *(F.col(v).alias(k) for k, v in added.items()))


def digests(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of words, hit words and items, the items' SHA-256, contaminated."""
    found = hits(docs.select(key, text), bench, text)
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("bigint"), lambda n, r: n + r["b"] - r["a"])
    listed = F.array_join("hit_items", ",")
    return found.select(key, "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"), F.sha2(listed.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, bench: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the text from the first to the last word of each hit run
    (a blank stands for it); rows and columns as before."""
    found = _plain_hits(docs, bench, text, "item_id", "text", WIDTH, block_bytes)
    at, n = docs.columns.index(text), F.size("_runs")
    own = F.col(f"c{at}")
    raw = own.cast("binary")

    def kept(i):
        """What stands between two runs.  Columns do this, not Python: a second Python
        pass in a task would leave twice as many workers for later stages to fill."""
        start = F.coalesce(F.get("_runs", i - 1)["to"], F.lit(0))
        end = F.coalesce(F.get("_runs", i)["from"], F.octet_length(own))
        return F.substring(raw, (start + 1).cast("int"), (end - start).cast("int")).cast("string")

    rest = F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n), kept), " ")).otherwise(own)
    return found.select(*((rest if i == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)))
