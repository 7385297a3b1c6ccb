"""Quality classification by co-training (Blum and Mitchell, 1998).

Two views of a document: its content (words, symbol runs and shape) and its
metadata (language, source, length).  A classifier for each view is fitted on
labelled documents.  In each round both score all unlabelled documents, where they
are, and each labels those that it is most certain of, at most ``PICKS`` in the
shares of the classes, for the other.  Both are then calibrated on labelled
documents that were held back, and a combination of the calibrated views scores
every document.

The classifiers are fitted on at most about ``MOST_LABELLED`` labelled documents,
taken by the hash of the id, and the documents that they gave each other; every
unlabelled document takes part in every round, and every document is scored,
whole.  A document is good if its quality is 1 and it is not toxic.
Documents with contradicting labels take the worst.  Without labels of both
kinds all documents score the share of good ones, 1.0 if there are no labels.  A
null text has no words; null metadata are a value of their own; rows without an
id are scored but give no labels; equally certain documents go by the id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import cut, schema_of, shared_folder, ship
from graphloom.llm.texts import LOWER_BYTES, WORD_BYTES, Hasher, chunks, mix64, only, rows_of, spans

MOST_LABELLED = 16_000
#: Documents that a view labels for the other in a round.
PICKS = 1_000
#: Buckets of hashed content features, and how many of them a document may be sampled with.
BUCKETS = 1 << 18
ROUNDS, CERTAIN = 4, 0.98
_LOGIT = float(np.log(CERTAIN / (1 - CERTAIN)))
SHAPES = 8
_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[[b for b in range(33, 127) if not WORD_BYTES[b]]] = True
_FAMILY = {"word": np.uint64(0x1234567), "symbol": np.uint64(0x89ABCDE)}


def content_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed features of all rows, each row's first, and a table of shapes."""
    n = len(offsets) - 1
    exact = Hasher(data, LOWER_BYTES)
    keys, counts = [], []
    for family, member in (("word", WORD_BYTES), ("symbol", _SYMBOL_BYTES)):
        starts, ends, first = spans(data, offsets, member)
        h = mix64(exact(starts, ends) ^ _FAMILY[family]) & np.uint64(BUCKETS - 1)
        keys.append(rows_of(first).astype(np.uint64) << np.uint64(32) | h)
        counts.append((np.diff(first), np.bincount(rows_of(first), ends - starts, n)))
    both = np.unique(np.concatenate(keys))
    row = (both >> np.uint64(32)).astype(np.int64)
    first = np.searchsorted(row, np.arange(n + 1))
    (words, word_bytes), (symbols, symbol_bytes) = counts
    distinct = np.diff(np.searchsorted(np.unique(keys[0]) >> np.uint64(32), np.arange(n + 1)))
    size = np.maximum(np.diff(offsets), 1)
    some = np.maximum(words, 1)
    lines = np.bincount(np.searchsorted(offsets, np.flatnonzero(data == 10), "right") - 1, minlength=n)[:n] if len(data) else np.zeros(n)
    digits = (data >= 48) & (data < 58)
    sums = np.concatenate([[0], np.cumsum(digits)])
    shape = np.stack([np.log1p(words), word_bytes / some / 5, distinct / some, symbols / some, symbol_bytes / size * 5, lines / some * 10, (sums[offsets[1:]] - sums[offsets[:-1]]) / size * 5, np.minimum(symbols / some, 0.5) * 4], 1)
    return (both & np.uint64(0xFFFFFFFF)).astype(np.int32), first, shape.astype(np.float32)


class Content:
    """Logistic regression on the features that occur in ``least`` documents and
    whose share of bad ones is ``clear`` deviations off the mean."""

    def __init__(self, least: int = 8, most: int = 20_000, clear: float = 4.0):
        self.least, self.most, self.clear = least, most, clear

    def fit(self, docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray) -> Content:
        flat = np.concatenate([d[0] for d in docs]) if docs else np.zeros(0, np.int32)
        df = np.bincount(flat, minlength=BUCKETS)
        bad = np.bincount(np.concatenate([d[0] for d, good in zip(docs, y) if not good] or [flat[:0]]), minlength=BUCKETS)
        share = 1 - y.mean()
        score = np.abs(bad - df * share) / np.sqrt(df * share * (1 - share) + 1)
        chosen = np.flatnonzero((df >= self.least) & (score > self.clear))
        self.chosen = np.sort(chosen[np.argsort(-score[chosen], kind="stable")[: self.most]])
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[self.chosen] = np.arange(len(self.chosen))
        shape = np.stack([d[1] for d in docs])
        self.mean, self.scale = shape.mean(0), shape.std(0) + 1e-3
        rows = [(p := self.place[d[0]])[p >= 0] for d in docs]
        self.w, self.v, self.b = _logistic(rows, (shape - self.mean) / self.scale, len(self.chosen), y, weight)
        self.table = np.zeros(BUCKETS, np.float32)
        self.table[self.chosen] = self.w
        return self

    def logits(self, features: np.ndarray, first: np.ndarray, shape: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.table[features], dtype=np.float64)])
        return sums[first[1:]] - sums[first[:-1]] + ((shape - self.mean) / self.scale) @ self.v + self.b


class Metadata:
    """Logistic regression on one-hot language, source and size of the text."""

    SIZE = 512

    @classmethod
    def rows(cls, lang: list, source: list, n_chars: np.ndarray) -> list[np.ndarray]:
        import zlib

        size = np.log2(np.maximum(n_chars, 1)).astype(int)
        return [np.array([zlib.crc32(f"l{a}".encode()) % cls.SIZE, cls.SIZE + zlib.crc32(f"s{b}".encode()) % cls.SIZE, 2 * cls.SIZE + min(int(c), 63)]) for a, b, c in zip(lang, source, size)]

    def fit(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> Metadata:
        self.w, _, self.b = _logistic(rows, np.zeros((len(rows), 1), np.float32), 3 * self.SIZE, y, weight)
        return self

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.w[r].sum() for r in rows]) + self.b if rows else np.zeros(0)


def _logistic(rows: list[np.ndarray], dense: np.ndarray, n: int, y: np.ndarray, weight: np.ndarray, steps: int = 400, rate: float = 0.1, decay: float = 1e-5):
    """Full-batch Adam on sparse binary and dense features."""
    size = np.array([len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), size)
    w = np.zeros(n + dense.shape[1] + 1)
    m, s = np.zeros_like(w), np.zeros_like(w)
    total = weight.sum()
    for t in range(1, steps + 1):
        z = np.bincount(owner, w[flat], len(rows)) + dense @ w[n:-1] + w[-1]
        d = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.concatenate([np.bincount(flat, d[owner], n), dense.T @ d, [d.sum()]]) / total
        g[:-1] += decay * w[:-1]
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return w[:n], w[n:-1], w[-1]


class CoTrained:
    """Both views and their calibrated combination."""

    def fit(self, labelled, y: np.ndarray, unlabelled, rounds: int = ROUNDS) -> CoTrained:
        """``labelled``: a list of (features, shape, metadata row).  ``unlabelled``: such a
        list, or what ``Pool`` offers."""
        if isinstance(unlabelled, list):
            unlabelled = Pool(unlabelled)
        self.constant = float(y.mean()) if len(y) else 1.0
        self.usable = len(y) >= 10 and 0 < y.sum() < len(y)
        if not self.usable:
            return self
        held = np.arange(len(y)) % 4 == 3
        if not 0 < y[held].sum() < held.sum() or not 0 < y[~held].sum() < (~held).sum():
            held = np.zeros(len(y), bool)
        base = [d for d, h in zip(labelled, held) if not h]
        y_base = y[~held].astype(float)
        given: list[dict] = [{}, {}]  # documents and labels that each view is given by the other
        for turn in range(rounds + 1):
            views = []
            for k in (0, 1):
                more = [given[k][i] for i in sorted(given[k])]
                docs = base + [d for d, _ in more]
                target = np.concatenate([y_base, [label for _, label in more]])
                weight = np.concatenate([np.ones(len(base)), np.full(len(more), 0.5)])
                views.append(Content().fit([(d[0], d[1]) for d in docs], target, weight) if k == 0 else Metadata().fit([d[2] for d in docs], target, weight))
            self.content, self.metadata = views
            if turn == rounds or not unlabelled.size:
                break
            unlabelled.show(self)
            picks, wanted = [], min(PICKS, unlabelled.size // (2 * rounds))
            for k in (0, 1):
                for good in (1.0, 0.0):
                    quota = int(wanted * (self.constant if good else 1 - self.constant))
                    best = [i for i in unlabelled.surest(k, good, quota + len(given[1 - k])) if i not in given[1 - k]][:quota]
                    picks += [(1 - k, i, good) for i in best]
            known = unlabelled.documents({i for _, i, _ in picks})
            for k, i, good in picks:
                given[k][i] = known[i], good
        fold = [d for d, h in zip(labelled, held) if h] or labelled
        y_fold = y[held] if held.any() else y
        z = np.clip(self._views(fold), -20, 20)
        calibrated = []
        self.scales = []
        for k in (0, 1):
            _, v, b = _logistic([np.zeros(0, np.int64)] * len(fold), z[:, k : k + 1], 0, y_fold, np.ones(len(fold)))
            self.scales.append((float(v[0]), float(b)))
            calibrated.append(z[:, k] * v[0] + b)
        _, self.mix, self.shift = _logistic([np.zeros(0, np.int64)] * len(fold), np.stack(calibrated, 1), 0, y_fold, np.ones(len(fold)))
        return self

    def _views(self, docs) -> np.ndarray:
        first = np.concatenate([[0], np.cumsum([len(d[0]) for d in docs])])
        flat = np.concatenate([d[0] for d in docs])
        return np.stack([self.content.logits(flat, first, np.stack([d[1] for d in docs])), self.metadata.logits([d[2] for d in docs])], 1)

    def combine(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        z = np.clip(np.stack([content, metadata], 1), -20, 20)
        z = z * [s[0] for s in self.scales] + [s[1] for s in self.scales]
        return 1 / (1 + np.exp(-np.clip(z @ self.mix + self.shift, -30, 30)))


class Pool:
    """Unlabelled documents in memory; ids are places in the list."""

    def __init__(self, docs: list):
        self.docs, self.size = docs, len(docs)

    def show(self, model: CoTrained) -> None:
        self.z = model._views(self.docs)

    def surest(self, view: int, good: float, most: int) -> list:
        """Ids of the documents that a view gives a label with certainty, the surest first."""
        z = self.z[:, view] if good else -self.z[:, view]
        return [i for i in np.argsort(-z, kind="stable").tolist() if z[i] >= _LOGIT][:most]

    def documents(self, ids: set) -> dict:
        return {i: self.docs[i] for i in ids}


class Table:
    """The unlabelled documents of a table, which stay where they are: of each
    round only the surest ids and their features come to the driver."""

    def __init__(self, base: DataFrame, named: DataFrame):
        self.base, self.named = base.where("_id is not null"), named
        self.folder, self.turn = shared_folder(base.sparkSession), 0
        self.size = self.base.select("_id").join(named, "_id", "left_anti").count()

    def show(self, model: CoTrained) -> None:
        held = self.base.sparkSession.sparkContext.broadcast(model)

        def run(batches):
            only()
            for batch in batches:
                for lo, hi, data, offsets in chunks(batch, "_text"):
                    lang, source = (batch.column(i).slice(lo, hi - lo).to_pylist() for i in (1, 2))
                    z = held.value.content.logits(*content_features(data, offsets)), held.value.metadata.logits(Metadata.rows(lang, source, np.diff(offsets)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, z)], names=["_id", "z0", "z1"])

        scored = self.base.mapInArrow(run, "_id bigint, z0 double, z1 double")
        self.z = cut(scored.join(self.named, "_id", "left_anti"), f"views{self.turn}", self.folder)
        self.turn += 1

    def surest(self, view: int, good: float, most: int) -> list:
        z = F.col(f"z{view}") if good else -F.col(f"z{view}")
        return [r[0] for r in self.z.where(z >= _LOGIT).groupBy("_id").agg(F.min(z).alias("z")).orderBy(F.desc("z"), "_id").limit(most).collect()]

    def documents(self, ids: set) -> dict:
        # at most 2 * PICKS ids
        wanted = self.base.sparkSession.createDataFrame([(i,) for i in sorted(ids)], "_id bigint")
        found = _featurised(self.base.join(F.broadcast(wanted), "_id"), []).toArrow().sort_by("_id")
        return dict(zip(found["_id"].to_pylist(), _rows(found)))


def _rows(found: pa.Table) -> list:
    meta = Metadata.rows(found["_lang"].to_pylist(), found["_source"].to_pylist(), found["size"].to_numpy())
    features, shapes = found["f"].combine_chunks(), found["s"].combine_chunks()
    edge, flat = features.offsets.to_numpy(), features.values.to_numpy()
    table = shapes.flatten().to_numpy().reshape(-1, SHAPES)
    return [(flat[a:b], table[i], m) for i, (a, b, m) in enumerate(zip(edge[:-1], edge[1:], meta))]


def _featurised(docs: DataFrame, extra: list[str]) -> DataFrame:
    """``_id, _lang, _source, _text`` to bounded rows of features: at most ``BUCKETS`` ids each."""
    kept = docs.select("_id", "_lang", "_source", *extra, "_text")

    def run(batches):
        only()
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch, "_text"):
                features, first, shape = content_features(data, offsets)
                n = hi - lo
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(features))
                shapes = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * SHAPES), pa.array(shape.ravel()))
                own = [batch.column(i).slice(lo, n) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*own, lists, shapes, pa.array(np.diff(offsets))], names=["_id", "_lang", "_source", *extra, "f", "s", "size"])

    return kept.mapInArrow(run, "_id bigint, _lang string, _source string, " + "".join(f"{c} int, " for c in extra) + "f array<int>, s array<float>, size bigint")


def _columns(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias("_id"), F.col("lang").cast("string").alias("_lang"), F.col("source").cast("string").alias("_source"), F.col(text).alias("_text"))


def _sample(table: DataFrame, ids: str, most: int) -> DataFrame:
    """About ``most`` rows (never over a tenth more but by chance), by hash of the id."""
    n = table.count()
    if n <= most:
        return table
    return table.where(F.pmod(F.xxhash64(ids), F.lit(1 << 30)) < int((1 << 30) * (most / n)))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most_labelled: int = MOST_LABELLED) -> CoTrained:
    ship(docs.sparkSession)
    toxic = F.coalesce("toxic", F.lit(0)) == 1
    named = labels.where(F.col(key).isNotNull() & (F.col("quality").isNotNull() | toxic)).groupBy(F.col(key).cast("bigint").alias("_id"))
    named = named.agg(F.min(F.when((F.col("quality") == 1) & ~toxic, 1).otherwise(0)).cast("int").alias("good"))
    known = _sample(named, "_id", most_labelled)
    base = _columns(docs, key, text)
    # a bounded number of ids, so the join can be a broadcast
    taken = _featurised(base.join(F.broadcast(known), "_id").dropDuplicates(["_id"]), ["good"]).toArrow().sort_by("_id")
    return CoTrained().fit(_rows(taken), taken["good"].to_numpy(), Table(base, named.select("_id")))


def score(docs: DataFrame, model: CoTrained, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the probability that each is good."""
    ship(docs.sparkSession)
    kept = docs.select(*(c for c in docs.columns if c != out))
    lang, source, at = (kept.columns.index(c) for c in ("lang", "source", text))
    inner = [f"c{i}" for i in range(len(kept.columns))]
    plain = kept.toDF(*inner)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        only()
        m = held.value
        for batch in batches:
            parts = []
            for lo, hi, data, offsets in chunks(batch, f"c{at}"):
                if not m.usable:
                    parts.append(np.full(hi - lo, m.constant))
                    continue
                meta = Metadata.rows(batch.column(lang).slice(lo, hi - lo).to_pylist(), batch.column(source).slice(lo, hi - lo).to_pylist(), np.diff(offsets))
                parts.append(m.combine(m.content.logits(*content_features(data, offsets)), m.metadata.logits(meta)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=[*inner, "out"])

    return plain.mapInArrow(run, schema_of(plain) + ", out double").toDF(*kept.columns, out)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``quality_score`` and ``keep``."""
    return score(docs, fit(docs, labels, key, text), text).withColumn("keep", F.col("quality_score") >= threshold)
