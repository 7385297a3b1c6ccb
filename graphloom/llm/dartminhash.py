"""Near-duplicate groups by DartMinHash (Christiani, 2020).

A text is the set of its runs of five words.  Darts are thrown at (element,
weight, rank) space: each cell of an element and a doubling interval of ranks
holds a Poisson number of them, all drawn from hashes, so equal cells hold equal
darts whatever the text.  Darts within the text's weights fall on coordinates;
the earliest of each coordinate is its signature, a weighted minhash in time
that does not depend on the product of elements and coordinates.

Texts with equal sets are one class from the start.  Bands of coordinates bring
classes together in buckets, and groups are contracted in two steps.  First every
class is compared, exactly, with the leader of each of its buckets: the class that
meets most others.  Then the classes that share a leader but are not yet in one
component are compared with each other, whatever they share, unless the sizes of
their sets or their distances from the leader rule it out: Jaccard distance is a
metric.  So of two similar classes that share a band, either both are in one
component already or their sets are compared, and no link is lost.  What a leader
has is dealt out in blocks of bounded size, and classes within the largest
component of a leader are never compared with each other.

Null texts count as empty.  Texts of one to four words are one run of them all.
Texts without words have no set: only equal ones are together.  Repeated rows
are in one class.  An empty table gives an empty result.  Columns of the input
are renamed inside, so no name of theirs clashes.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.components import components
from graphloom.llm.store import SIEVE, cut, parted, schema_of, shared_folder, ship
from graphloom.llm.texts import LOWER_BYTES, WORD_BYTES, Hasher, chunks, mix64, only, rows_of, spans, windows

SHINGLE, SIMILAR = 5, 0.8
BANDS, BAND_ROWS = 40, 8
#: Classes that are compared in one block with as many others, and elements of their sets.
PART, PART_ELEMENTS = 512, 1 << 19
#: Elements of a block that are counted at once.
_COLUMNS = 4096
#: Expected darts of an element of weight 1 in the first interval of ranks.
_FIRST = 1 / 16
_U = np.uint64


@functools.cache
def _poisson(interval: int) -> np.ndarray:
    """Cumulative Poisson probabilities for an interval of ranks."""
    mean = _FIRST * 2 ** max(interval - 1, 0)
    k = np.arange(int(mean + 12 * np.sqrt(mean) + 20))
    logs = k * np.log(mean) - mean - np.concatenate([[0], np.cumsum(np.log(k[1:]))])
    return np.cumsum(np.exp(logs))


def signatures(elements: np.ndarray, rows: np.ndarray, n_rows: int, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """One row of ``k`` 64-bit values for each row that has elements (zeros for
    others); the share of equal values estimates the weighted Jaccard similarity."""
    out = np.zeros((n_rows, k), _U)
    mass = np.bincount(rows, weights, n_rows)
    share = None
    if weights is not None:  # unit cells of an element; the last may be a part of one
        cells = np.ceil(weights).astype(np.int64)
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        share = np.minimum(np.repeat(weights, cells) - cell, 1.0)
        elements, rows = mix64(np.repeat(elements, cells) + cell.astype(_U) * _U(0xC2B2AE3D27D4EB4F)), np.repeat(rows, cells)
    wanted = k * (np.log(k) + 2)
    with np.errstate(divide="ignore"):
        last = np.where(mass > 0, np.maximum(np.ceil(np.log2(wanted / np.maximum(mass, 1e-9) / _FIRST)), 0), -1).astype(np.int64)
    todo = np.flatnonzero(last >= 0)
    while len(todo):
        place = np.full(n_rows, -1)
        place[todo] = np.arange(len(todo))
        best = np.full(len(todo) * k, np.iinfo(_U).max, _U)
        mine = np.flatnonzero(place[rows] >= 0)
        e, r = elements[mine], place[rows[mine]]
        part = None if share is None else share[mine]
        until = last[todo][r]
        for interval in range(int(last[todo].max()) + 1):
            on = until >= interval
            if not on.all():
                e, r, until = e[on], r[on], until[on]
                part = None if part is None else part[on]
            seed = mix64(e ^ mix64(np.array([interval + 1], _U)))
            number = np.searchsorted(_poisson(interval), (seed >> _U(11)).astype(np.float64) * 2.0**-53, "right")
            thrown = np.repeat(np.arange(len(e)), number)
            nth = np.arange(len(thrown)) - np.repeat(np.cumsum(number) - number, number)
            a = mix64(seed[thrown] + (nth.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
            b = mix64(a)
            if part is not None:  # the dart's place in its cell must lie within the weight
                inside = (mix64(b) >> _U(11)).astype(np.float64) * 2.0**-53 < part[thrown]
                thrown, a, b = thrown[inside], a[inside], b[inside]
            bits = 24 if interval == 0 else 23 + interval
            rank = (a >> _U(64 - bits)) + _U(0 if interval == 0 else 1 << bits)
            at = r[thrown] * k + (b % _U(k)).astype(np.int64)
            np.minimum.at(best, at, rank << _U(20) | (b >> _U(44)))
        best = best.reshape(-1, k)
        full = (best != np.iinfo(_U).max).all(1)
        out[todo[full]] = best[full]
        todo = todo[~full]
        last[todo] += 1
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct elements (48-bit hashes) of all rows, and each row's first."""
    n = len(offsets) - 1
    starts, ends, first = spans(data, offsets, WORD_BYTES)
    h = Hasher(data, LOWER_BYTES)(starts, ends)
    row = rows_of(first)
    at, full = windows(h, first, width)
    keys = [row[at].astype(_U) << _U(48) | full >> _U(16)]
    count = np.diff(first)
    for short in range(1, width):
        own = np.flatnonzero(count == short)
        if len(own):
            at, whole = windows(h, first, short)
            keep = count[row[at]] == short
            keys.append(row[at[keep]].astype(_U) << _U(48) | whole[keep] >> _U(16))
    both = np.unique(np.concatenate(keys))
    return both & _U((1 << 48) - 1), np.searchsorted(both >> _U(48), np.arange(n + 1))


def set_ids(data: np.ndarray, offsets: np.ndarray, elements: np.ndarray, first: np.ndarray) -> list[bytes]:
    """128 bits that name each row's set, or the bytes of a row without words."""
    sums = [np.concatenate([np.zeros(1, _U), np.cumsum(mix64(elements + _U(salt)), dtype=_U)]) for salt in (1, 1 << 60)]
    two = np.stack([mix64(s[first[1:]] - s[first[:-1]]) for s in sums], 1)
    bare = np.flatnonzero(first[1:] == first[:-1])
    if len(bare):
        whole = Hasher(data)(offsets[bare], offsets[bare + 1])
        two[bare] = np.stack([mix64(whole ^ _U(salt)) for salt in (0xB10B, 0xB1AB)], 1)
    raw = two.astype("<u8").tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def sketch(docs: DataFrame, text: str, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """``docs`` with ``_class`` (the set's name), ``_n`` (its size) and ``_bands``
    (the band values; none for texts without words)."""
    names = docs.columns

    def run(batches):
        only()
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch, text):
                elements, first = shingle_sets(data, offsets)
                named = set_ids(data, offsets, elements, first)
                s = signatures(elements, rows_of(first), hi - lo, bands * band_rows).reshape(hi - lo, bands, band_rows)
                value = np.arange(bands, dtype=_U)[None] + np.zeros((hi - lo, 1), _U)
                for i in range(band_rows):
                    value = mix64(value * _U(0x9E3779B97F4A7C15) + s[:, :, i])
                size = np.diff(first)
                where = np.concatenate([[0], np.cumsum((size > 0) * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(where), pa.array(value[size > 0].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns), pa.array(named, pa.binary()), pa.array(size, pa.int64()), lists], names=[*names, "_class", "_n", "_bands"])

    return docs.mapInArrow(run, schema_of(docs) + ", _class binary, _n bigint, _bands array<bigint>")


def _sieve(places: DataFrame) -> Broadcast:
    """The column ``p`` of ``places``, numbers below ``SIEVE``, as bits: 4 MB, however many there are."""
    at = F.col("p") + 1
    bits = places.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m"))
    table = np.zeros(SIEVE >> 3, np.uint8)
    for r in bits.collect():
        m = np.frombuffer(bytes(r.m), np.uint8)
        table[(r.b - 1) * 4096 : (r.b - 1) * 4096 + len(m)] = m
    return places.sparkSession.sparkContext.broadcast(table)


def _passes(sieve: Broadcast, p: np.ndarray) -> np.ndarray:
    return (sieve.value[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def _stars(sketches: DataFrame, folder: str) -> DataFrame:
    """``_lead, _class``: each class with the leaders of its buckets, and each leader with itself."""
    each = sketches.select("_class", F.explode("_bands").alias("_band"))
    # copies of a text are one class: a bucket counts if it has two of them
    name = F.xxhash64("_class")
    shared = each.groupBy("_band").agg(F.min(name).alias("x"), F.max(name).alias("y")).where("x != y").select("_band")
    shared = cut(shared, "shared", folder)
    sieve = _sieve(shared.select(F.pmod("_band", F.lit(SIEVE)).alias("p")))

    def sifted(batches):
        for batch in batches:
            names, lists = batch.columns
            band = lists.flatten().to_numpy()
            keep = _passes(sieve, band & (SIEVE - 1))
            if keep.any():
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                yield pa.RecordBatch.from_arrays([names.take(pa.array(row[keep])), pa.array(band[keep])], names=["_class", "_band"])

    # most bands are of one class and need not be sent again
    near = sketches.select("_class", "_bands").mapInArrow(sifted, "_class binary, _band bigint")
    # tables on both sides of the joins on bands, so that a hot bucket can be split
    members = cut(near.join(shared, "_band").distinct(), "members", folder)
    sizes = members.groupBy("_band").agg(F.count("*").alias("n"))
    members = cut(members.join(sizes, "_band"), "sized", folder)
    weight = members.groupBy("_class").agg(F.sum("n").alias("w"))
    heads = members.join(weight, "_class").groupBy("_band").agg(F.max(F.struct("w", "_class")).getField("_class").alias("_lead"))
    return cut(members.join(heads, "_band").select("_lead", "_class").distinct(), "stars", folder)


def _texts(sketches: DataFrame, wanted: DataFrame, folder: str) -> DataFrame:
    """``_class, _n, _z``: the packed text of each wanted class.  A sieve of fixed size, 4 MB of
    bits, keeps most others from being sent."""
    place = F.pmod(F.xxhash64("_class"), F.lit(SIEVE))
    sieve = _sieve(wanted.select(place.alias("p")))

    def pick(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            keep = _passes(sieve, batch.column(3).to_numpy())
            if keep.any():
                names, n, texts, _ = batch.filter(pa.array(keep)).columns
                yield pa.RecordBatch.from_arrays([names, n, pa.array([pack(t.as_buffer()) for t in texts.cast(pa.large_binary())], pa.binary())], names=["_class", "_n", "_z"])

    near = sketches.select("_class", "_n", "_text", place.alias("p")).mapInArrow(pick, "_class binary, _n bigint, _z binary")
    one = near.groupBy("_class").agg(F.first("_n").alias("_n"), F.first("_z").alias("_z"))
    return cut(one.join(wanted, "_class", "left_semi"), "texts", folder)


def _parts(n: str, size: str) -> Column:
    """Parts that hold at most about ``PART`` classes and ``PART_ELEMENTS`` elements each."""
    return F.greatest(F.ceil(F.col(n) / PART), F.ceil(F.col(size) / PART_ELEMENTS), F.lit(1)).cast("int")


def _star_links(stars: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """``_lead, _class, _n, like``: the similarity of each class and its leader."""
    sized = stars.join(texts.select("_class", "_n"), "_class")
    total = cut(sized.groupBy("_lead").agg(F.count("*").alias("n"), F.sum("_n").alias("size")).select("_lead", _parts("n", "size").alias("parts")), "led", folder)
    own = F.pmod(F.xxhash64("_class"), F.col("parts")).cast("int")
    head = F.col("_class") == F.col("_lead")
    dealt = stars.join(total, "_lead").select("_lead", "_class", head.alias("head"), F.explode(F.when(head, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))).alias("part"))
    ready = dealt.join(texts, "_class").repartition("_lead", "part").sortWithinPartitions("_lead", "part", F.desc("head"))

    def run(batches):
        only()
        lead, unpack = np.zeros(0, _U), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pa.array([unpack(z.as_buffer()) for z in batch.column(5)], pa.large_binary())], names=["t"])
            for lo, hi, data, offsets in chunks(texts, "t"):
                elements, first = shingle_sets(data, offsets)
                part, heads = (batch.column(i).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for i in (2, 3))
                like = np.ones(hi - lo)
                edge = np.unique(np.concatenate([[0], np.flatnonzero(heads), [hi - lo]]))
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    if heads[a]:
                        lead = elements[first[a] : first[a + 1]].copy()
                    x, size = elements[first[a] : first[b]], np.diff(first[a : b + 1])
                    inside = lead[np.minimum(np.searchsorted(lead, x), len(lead) - 1)] == x
                    both = np.bincount(np.repeat(np.arange(b - a), size), inside, b - a)
                    like[a:b] = both / (size + len(lead) - both)
                ready = pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in (0, 1, 4)), pa.array(like)], names=["_lead", "_class", "_n", "like"])
                yield ready.filter(pa.array(~heads | (part == 0)))

    found = ready.select("_lead", "_class", "part", "head", "_n", "_z").mapInArrow(run, "_lead binary, _class binary, _n bigint, like double")
    return cut(found, "star_links", folder)


def _shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``a`` has in common with each of ``b``."""
    out = np.zeros((len(a), len(b)), np.float32)
    row = np.concatenate([np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b]) + len(a)])
    values = np.concatenate([*a, *b])
    order = np.argsort(values, kind="stable")
    row, values = row[order], values[order]
    column = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]]))
    n = int(column[-1]) + 1
    # what is on one side only is in no intersection
    both = (np.bincount(column, row < len(a), n) > 0) & (np.bincount(column, row >= len(a), n) > 0)
    keep = both[column]
    row, column = row[keep], (np.cumsum(both) - 1)[column[keep]]
    edge = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else -1) + 1 + _COLUMNS, _COLUMNS))
    for k, (lo, hi) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
        part = np.zeros((len(a) + len(b), _COLUMNS), np.float32)
        part[row[lo:hi], column[lo:hi] - k * _COLUMNS] = 1
        out += part[: len(a)] @ part[len(a) :].T
    return out


def _judge(apart: bool, own: np.ndarray, kind: np.ndarray, n: np.ndarray, like: np.ndarray, texts: list[bytes], least: float) -> list[tuple[int, int]]:
    """Similar pairs of a block among those of different components."""
    left = np.flatnonzero(own == own.min()) if apart else np.arange(len(n))
    right = np.flatnonzero(own != own.min()) if apart else left
    if not len(left) or not len(right):
        return []
    x, y = left[:, None], right[None]
    todo = (kind[x] != kind[y]) & (np.minimum(n[x], n[y]) >= least * np.maximum(n[x], n[y])) & (np.abs(like[x] - like[y]) <= 1 - least + 1e-9)
    if not apart:
        todo &= x < y
    left, right, todo = left[todo.any(1)], right[todo.any(0)], todo[todo.any(1)][:, todo.any(0)]
    if not todo.any():
        return []
    used = np.union1d(left, right)
    unpack = zstandard.ZstdDecompressor().decompress
    raw = [unpack(texts[i]) for i in used.tolist()]
    elements, first = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    sets = dict(zip(used.tolist(), np.split(elements, first[1:-1])))
    i, j = np.nonzero(todo)
    a, b = left[i], right[j]
    if len(i) <= 64:
        both = np.array([len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for p, q in zip(a.tolist(), b.tolist())])
    else:
        both = _shared([sets[p] for p in left.tolist()], [sets[q] for q in right.tolist()])[i, j]
    hit = both >= least * (n[a] + n[b] - both) - 1e-9
    # one link for each two components is enough
    pairs = np.stack([np.minimum(kind[a[hit]], kind[b[hit]]), np.maximum(kind[a[hit]], kind[b[hit]])], 1)
    _, one = np.unique(pairs, axis=0, return_index=True)
    return list(zip(a[hit][one].tolist(), b[hit][one].tolist()))


def _open_links(starred: DataFrame, texts: DataFrame, least: float, folder: str) -> DataFrame:
    """``a, b``: labels of components joined by similar classes that share a
    leader, for ``starred`` of ``_lead, _class, _n, like, label``."""
    kinds = starred.groupBy("_lead", "label").agg(F.count("*").alias("n"), F.sum("_n").alias("size"), F.min("like").alias("low"), F.max("like").alias("high"))
    kinds = cut(kinds, "kinds", folder)
    led = kinds.groupBy("_lead").agg(F.max(F.struct("n", "label", "size")).alias("top"), F.sum("n").alias("n"), F.sum("size").alias("size"))
    rest = led.where(F.col("n") > F.col("top.n")).select("_lead", F.col("top.label").alias("main"), (F.col("n") - F.col("top.n")).alias("n"), (F.col("size") - F.col("top.size")).alias("size"), F.col("top.n").alias("mn"), F.col("top.size").alias("msize"))
    rest = rest.select("_lead", "main", _parts("n", "size").alias("f"), _parts("mn", "msize").alias("m"))
    # the main component's classes are only compared with others at a distance from the leader that allows it
    span = kinds.join(rest, "_lead").where("label != main").groupBy("_lead", "main", "f", "m").agg((F.min("low") - (1 - least) - 1e-9).alias("low"), (F.max("high") + (1 - least) + 1e-9).alias("high"))
    rest = cut(span, "open", folder)
    main, spread = F.col("label") == F.col("main"), F.xxhash64("_class")
    own = F.when(main, F.col("f") + F.pmod(spread, F.col("m"))).otherwise(F.pmod(spread, F.col("f"))).cast("int")
    last = F.when(main, F.col("f")).otherwise(F.col("f") + F.col("m")) - 1
    near = starred.join(rest, "_lead").where(~main | F.col("like").between(F.col("low"), F.col("high")))
    dealt = near.select("_lead", "_class", "label", "like", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    dealt = dealt.select("_lead", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "_class", "label", "like")
    dealt = dealt.join(texts, "_class").repartition("_lead", "p", "q").sortWithinPartitions("_lead", "p", "q")

    def run(batches):
        only()
        held, block = [], None

        def close():
            own, n, like = (np.array([h[i] for h in held]) for i in (0, 3, 4))
            names = [h[2] for h in held]
            kind = np.unique(np.array(names, object), return_inverse=True)[1].reshape(-1)
            pairs = _judge(block[1] != block[2], own, kind, n, like, [h[5] for h in held], least) if len(held) > 1 else []
            held.clear()
            return [(names[i], names[j]) for i, j in pairs]

        def table(pairs):
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(9))):
                if row[:3] != block:
                    if held and (pairs := close()):
                        yield table(pairs)
                    block = row[:3]
                held.append(row[3:])
        if held and (pairs := close()):
            yield table(pairs)

    found = dealt.select("_lead", "p", "q", "own", "_class", "label", "_n", "like", "_z").mapInArrow(run, "a binary, b binary")
    return cut(found.distinct(), "open_links", folder)


def _labels(sketches: DataFrame, least: float, folder: str) -> DataFrame:
    """``_class, label`` of the classes that share a band with others; a label is the least class of a group."""
    stars = _stars(sketches, folder)
    texts = _texts(sketches, stars.select("_class").distinct(), folder)
    near = _star_links(stars, texts, folder)
    first = components(near.where((F.col("like") >= least - 1e-9) & (F.col("_lead") != F.col("_class"))), "_lead", "_class")
    first = near.select("_class").distinct().join(first.withColumnRenamed("node", "_class"), "_class", "left").select("_class", F.coalesce("label", "_class").alias("label"))
    first = cut(first, "first", folder)
    more = components(_open_links(near.join(first, "_class"), texts, least, folder))
    return first.join(more.toDF("label", "to"), "label", "left").select("_class", F.coalesce("to", "label").alias("label"))


def _grouped(sketches: DataFrame, least: float, folder: str) -> DataFrame:
    """``_class, class_id, copy_id`` for ``sketches`` of ``_key, _text`` and what ``sketch`` adds."""
    classes = sketches.groupBy("_class").agg(F.min("_key").alias("copy_id"))
    classes = cut(classes.join(_labels(sketches, least, folder), "_class", "left"), "classes", folder)
    least_key = classes.where("label is not null").groupBy("label").agg(F.min("copy_id").alias("class_id"))
    single = classes.where("label is null").select("_class", F.col("copy_id").alias("class_id"), "copy_id")
    return single.unionByName(classes.join(least_key, "label").select("_class", "class_id", "copy_id"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILAR) -> DataFrame:
    """One row per document: key, ``class_id`` (the least key of its group) and
    ``copy_id`` (the least key with the same set of words)."""
    ship(docs.sparkSession)
    folder = shared_folder(docs.sparkSession)
    sketches = cut(sketch(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text"), "sketches", folder)
    return sketches.select("_key", "_class").join(_grouped(sketches, least, folder), "_class").select(F.col("_key").alias(key), "class_id", "copy_id")


def keep_one(docs: DataFrame, text: str = "text", least: float = SIMILAR) -> DataFrame:
    """``docs`` with one document of each group.  Rows are told apart by a number
    that is written with them once, so repeated or null keys do no harm."""
    ship(docs.sparkSession)
    folder = shared_folder(docs.sparkSession)
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    numbered = docs.toDF(*inner).withColumn("_key", F.monotonically_increasing_id()).withColumnRenamed(inner[names.index(text)], "_text")
    sketches = cut(sketch(numbered, "_text"), "sketches", folder)
    found = _grouped(sketches, least, folder)
    # the class of a group's first row stays, with its first row: texts are sent only where a row may have to go
    several = sketches.groupBy("_class").agg(F.count("*").alias("n")).where("n > 1").select("_class")
    moved = found.where("class_id != copy_id").select("_class")
    going, staying = parted(sketches.drop("_bands", "_n"), "_class", cut(several.unionByName(moved).distinct(), "touched", folder))
    kept = staying.unionByName(going.join(found.select(F.col("class_id").alias("_key")).distinct(), "_key", "left_semi").select(*staying.columns))
    return kept.select(*("_text" if n == text else c for c, n in zip(inner, names))).toDF(*names)
