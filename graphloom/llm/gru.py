"""Scoring texts with a gated recurrent language model written in numpy.

Every text is a sequence of word tokens and one end token.  Token counts cover
all training texts.  The model has the most frequent tokens as its vocabulary,
cut into classes by frequency; one more class holds all other tokens, whose
probability within it comes from their counts, with one share for unseen ones.
The output softmax is factored: the class, then the word within the class, both
given the recurrent state.  The biases start at the unigram distribution.

Training: the training texts, as word ids, are dealt by hash to shards of about
a million tokens, and the shards to rounds.  In a round every shard of it runs
truncated backpropagation from the same weights over all its texts, laid side by
side in lanes; the results are averaged by tokens and are the start of the next
round.  So every training text is learnt from once (in a small corpus several
times), and neither shards nor rounds depend on how the table is stored.
Scoring: the state goes on from window to window through the whole text, so the
score is the log-likelihood of all of it.

Counts of the most frequent tokens (a fixed number of them) are held by every
task; the rest are joined by a shuffle.  A null text counts as empty and is its
end token; equal texts have equal scores; with no training texts all tokens are
unseen.  A null id is trained on like the id of an empty string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import cut, shared_folder, ship
from graphloom.llm.texts import LOWER_BYTES, SOLID_BYTES, Hasher, chunks, spans

#: The end token's hash; a word with it would be one in 2**64.
END = 0x5851F42D4C957F2D
#: Tokens whose counts every task holds.
HELD = 1 << 17
#: Least and most classes, words in a class and twice the width of the state; between them they follow the number of distinct tokens.
LEAST_SIDE, MOST_SIDE = 16, 48
#: Steps of a window of backpropagation; lanes side by side; step size.
STEPS, ABREAST, RATE = 16, 512, 0.02
#: Tokens of a shard; rounds; tokens that are learnt from at least, by several passes over each shard, and most passes.
SHARD_TOKENS, ROUNDS, LEAST_TOKENS, MOST_PASSES = 1 << 20, 4, 1 << 21, 8
#: Tokens of a task that wait to be scored together, so that long texts run side by side.
TOGETHER = 4 << 20
_GROUPS = 8
#: Leading bits of a token's hash by which it is looked up.
_INDEX_BITS = 18


def training(key: str) -> Column:
    """Whether a row is trained on: crc32 of the id as text, modulo 7, is not 2."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(7)) != 2


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows with an end each, and each row's first."""
    starts, ends, first = spans(data, offsets, SOLID_BYTES)
    h = Hasher(data, LOWER_BYTES)(starts, ends)
    return np.insert(h, first[1:], np.uint64(END)), first + np.arange(len(first))


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``token, n`` over the training texts."""
    kept = docs.where(training(key)).select(text)

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in chunks(batch, text, 8 << 20):
                h, n = np.unique(token_hashes(data, offsets)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    return kept.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The held counts, and ids of the model's words: the rank by count, or
    ``words`` for all other tokens.  ``side`` classes of as many words."""

    def __init__(self, top: list[tuple[int, int]], total: int, types: int):
        self.side = min(max(round(types**0.5 / 8), LEAST_SIDE), MOST_SIDE)
        self.words = self.side**2
        h = np.array([t for t, _ in top], np.int64).view(np.uint64)
        n = np.array([c for _, c in top], np.int64)
        order = np.argsort(h)
        self.keys, self.counts, self.total, self.types = h[order], n[order], total, types
        # where the keys with each beginning of _INDEX_BITS bits are
        self.index = np.searchsorted(self.keys, np.arange(1 << _INDEX_BITS, dtype=np.uint64) << np.uint64(64 - _INDEX_BITS)).astype(np.int32)
        rank = np.minimum(np.arange(len(h)), self.words)
        self.rank = rank[order].astype(np.int32)
        first = np.zeros(self.words, np.float64)
        first[: min(self.words, len(n))] = n[:self.words]
        self.first = first
        self.rest = total - int(first.sum())
        self.rest_types = types - min(types, self.words)

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word id, count, or -1 where it is not held)."""
        if not len(self.keys):
            return np.full(len(h), self.words, np.int32), np.full(len(h), -1, np.int64)
        at = np.minimum(self.index[(h >> np.uint64(64 - _INDEX_BITS)).astype(np.int64)], len(self.keys) - 1)
        behind = np.flatnonzero(self.keys[at] < h)
        while len(behind):
            behind = behind[at[behind] + 1 < len(self.keys)]
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < h[behind]]
        held = self.keys[at] == h
        return np.where(held, self.rank[at], self.words).astype(np.int32), np.where(held, self.counts[at], -1)


def initial(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Small random weights; biases at the logarithms of the unigram shares."""
    rng = np.random.default_rng(7)
    side, width = vocabulary.side, vocabulary.side // 2
    words = (vocabulary.first + 0.5).reshape(side, side)
    classes = np.append(words.sum(1), vocabulary.rest + vocabulary.rest_types + 1.0)
    w = {
        "embed": rng.normal(0, 0.1, (side**2 + 2, width)),
        "in": rng.normal(0, 0.25, (width, 3 * width)),
        "gates": rng.normal(0, 0.25, (width, 2 * width)),
        "state": rng.normal(0, 0.25, (width, width)),
        "bias": np.zeros(3 * width),
        "class": rng.normal(0, 0.05, (width, side + 1)),
        "class_bias": np.log(classes / classes.sum()),
        "word": rng.normal(0, 0.05, (side, width, side)),
        "word_bias": np.log(words / words.sum(1, keepdims=True)),
    }
    return {k: v.astype(np.float32) for k, v in w.items()}


def pack(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def unpack(flat: np.ndarray, like: dict[str, np.ndarray], taken=lambda x: x.astype(np.float32)) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = taken(flat[at : at + like[k].size].reshape(like[k].shape))
        at += like[k].size
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _step(w: dict[str, np.ndarray], x: np.ndarray, h: np.ndarray):
    """One step of the recurrence; ``x`` is the input already multiplied."""
    n = h.shape[1]
    gates = h @ w["gates"]
    gates += x[:, : 2 * n]
    _sigmoid(gates)
    z, r = gates[:, :n], gates[:, n:]
    c = (r * h) @ w["state"]
    c += x[:, 2 * n :]
    np.tanh(c, out=c)
    return h + z * (c - h), z, r, c


def _with_one(x: np.ndarray) -> np.ndarray:
    """A last column of ones, which takes the biases."""
    out = np.empty((*x.shape[:-1], x.shape[-1] + 1), x.dtype)
    out[..., :-1], out[..., -1] = x, 1
    return out


def _heads(w: dict[str, np.ndarray], h: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Weights over biases of classes and of words, and whether exponentials of all
    logits of states like ``h`` are far from what single precision can't hold."""
    far, calm = np.abs(h).max(initial=1), True
    for x, bias in ((w["class"], w["class_bias"]), (w["word"], w["word_bias"])):
        reach = np.abs(x).sum(-2) * far
        calm &= bool((bias + reach).max() < 80 and (bias - reach).max(-1).min() > -20)
    return np.concatenate([w["class"], w["class_bias"][None]]), np.concatenate([w["word"], w["word_bias"][:, None]], 1), calm


def _exponentials(x: np.ndarray, calm: bool) -> tuple[np.ndarray, np.ndarray]:
    """In place, with their sums by row; logits are lowered first unless they are ``calm``."""
    if not calm:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], x.dtype)


def _log_share(x: np.ndarray, at: np.ndarray, calm: bool) -> np.ndarray:
    """The logarithm of the softmax of each row at one place; ``x`` is used up."""
    if not calm:
        x -= x.max(1, keepdims=True)
    own = x[np.arange(len(x)), at]
    return own - np.log(_exponentials(x, True)[1])


def _by_class(ids: np.ndarray, kind: np.ndarray, on: np.ndarray, classes: int):
    """Places of the ids that are ``on`` and in a class of words, in order of classes, and their edges."""
    known = np.flatnonzero(on & (kind < classes))
    known = known[np.argsort(kind[known].astype(np.uint8), kind="stable")]
    return known, np.searchsorted(kind[known], np.arange(classes + 1)).tolist()


def log_output(w: dict[str, np.ndarray], h: np.ndarray, ids: np.ndarray, block: int = 1 << 10) -> np.ndarray:
    """Natural log-probability of each id (of the class alone for the rest)."""
    classes, _, size = w["word"].shape
    kind, flat = ids // size, _with_one(h)
    head, words, calm = _heads(w, h)
    out = np.empty(len(ids), head.dtype)
    for a in range(0, len(ids), block):
        out[a : a + block] = _log_share(flat[a : a + block] @ head, kind[a : a + block], calm)
    known, edge = _by_class(ids, kind, np.ones(len(ids), bool), classes)
    own, at = flat[known], ids[known] % size
    for c, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
        for lo in range(a, b, block):
            hi = min(lo + block, b)
            out[known[lo:hi]] += _log_share(own[lo:hi] @ words[c], at[lo:hi], calm)
    return out


def _gradients(w, h0, inputs, targets, live, opens):
    """Loss, gradients and last state of one window; ``live`` masks what is past
    the end, ``opens`` the first tokens of texts, before which the state is zero."""
    (steps, n), number = targets.shape, w["embed"].dtype
    classes, width, size = w["word"].shape
    g = {k: np.zeros_like(v) for k, v in w.items()}
    x = _with_one(np.take(w["embed"], inputs, 0))
    xw = x @ np.concatenate([w["in"], w["bias"][None]])
    before, z, r, c = (np.empty((steps, n, width), number) for _ in range(4))
    states = np.ones((steps, n, width + 1), number)
    h = h0
    for t in range(steps):
        before[t] = h
        before[t][opens[t]] = 0
        h, z[t], r[t], c[t] = _step(w, xw[t], before[t])
        states[t, :, :width] = h
    flat = states.reshape(-1, width + 1)
    ids, on = targets.ravel(), live.ravel()
    kind, whole = ids // size, bool(on.all())
    head, words, calm = _heads(w, flat)
    # steps, and classes of words, one after the other: what is worked on stays in the cache
    dh, loss, total, every = np.empty((steps, n, width), number), 0.0, np.zeros_like(head), np.arange(n)
    head_back = w["class"].T.copy()
    for t in range(steps):
        p, sums = _exponentials(states[t] @ head, calm)
        p *= (1 / sums)[:, None]
        at = every, kind[t * n : (t + 1) * n]
        loss -= np.log(p[at] + 1e-30)[live[t]].sum()
        p[at] -= 1
        if not whole:
            p *= live[t][:, None]
        total += states[t].T @ p
        np.matmul(p, head_back, out=dh[t])
    g["class"], g["class_bias"] = total[:-1], total[-1]
    known, edge = _by_class(ids, kind, on, classes)
    own, spot, back = flat[known], ids[known] % size, np.empty((len(known), width), number)
    for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
        if a < b:
            q, sums = _exponentials(own[a:b] @ words[k], calm)
            q *= (1 / sums)[:, None]
            at = np.arange(b - a), spot[a:b]
            loss -= np.log(q[at] + 1e-30).sum()
            q[at] -= 1
            total = own[a:b].T @ q
            g["word"][k], g["word_bias"][k] = total[:-1], total[-1]
            np.matmul(q, w["word"][k].T, out=back[a:b])
    dh.reshape(-1, width)[known] += back
    # what a change of the state means for gates and candidate, for all steps at once
    to_z, to_c, to_r, stay = (c - before) * z * (1 - z), z * (1 - c * c), before * r * (1 - r), 1 - z
    kept = r * before
    carry, own, total = np.zeros((n, width), number), np.empty((n, 3 * width), number), np.zeros((width + 1, 3 * width), number)
    dx = np.empty((steps, n, width), number)
    gates_back, state_back, in_back = (w[k].T.copy() for k in ("gates", "state", "in"))
    for t in range(steps - 1, -1, -1):
        d = dh[t] + carry
        np.multiply(d, to_z[t], out=own[:, :width])
        np.multiply(d, to_c[t], out=own[:, 2 * width :])
        back = own[:, 2 * width :] @ state_back
        np.multiply(back, to_r[t], out=own[:, width : 2 * width])
        carry = own[:, : 2 * width] @ gates_back
        carry += d * stay[t]
        carry += back * r[t]
        carry[opens[t]] = 0
        g["state"] += kept[t].T @ own[:, 2 * width :]
        g["gates"] += before[t].T @ own[:, : 2 * width]
        total += x[t].T @ own
        np.matmul(own, in_back, out=dx[t])
    g["in"], g["bias"] = total[:-1], total[-1]
    order = np.argsort(inputs.ravel().astype(np.uint16), kind="stable")
    sorted_ = inputs.ravel()[order]
    head = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    g["embed"][sorted_[head]] = np.add.reduceat(np.take(dx.reshape(-1, width), order, 0), head)
    return loss, g, h


class Trainer:
    """Adam over windows of lanes side by side."""

    def __init__(self, w: dict[str, np.ndarray], rate: float = RATE):
        self.flat = pack(w)
        self.w = unpack(self.flat, w, np.ndarray.view)
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.rate, self.t, self.tokens, self.loss = rate, 0, 0, 0.0

    def learn(self, ids: np.ndarray, first: np.ndarray) -> None:
        """One pass over whole texts, put one after the other and cut into
        ``ABREAST`` lanes of one length; a lane's state goes on from window to window."""
        n, start = len(ids), len(self.w["embed"]) - 1
        if not n:
            return
        lanes = min(ABREAST, n)
        length = -(-n // lanes)
        opens = np.zeros(n, bool)
        opens[first[:-1][np.diff(first) > 0]] = True
        inputs = np.where(opens, start, np.concatenate([[0], ids[:-1]]))
        at = np.minimum(np.arange(length)[:, None] + np.arange(lanes)[None] * length, n)
        pad = lambda a, x: np.append(a, np.array(x, a.dtype))
        inputs, targets, opens = pad(inputs, start), pad(ids, 0), pad(opens, True)
        h = np.zeros((lanes, self.w["state"].shape[0]), np.float32)
        for lo in range(0, length, STEPS):
            own = at[lo : lo + STEPS]
            live = own < n
            loss, g, h = _gradients(self.w, h, inputs[own], targets[own], live, opens[own])
            k = int(live.sum())
            self.tokens, self.loss, self.t = self.tokens + k, self.loss + float(loss), self.t + 1
            d = pack(g)
            d /= np.float32(k)
            np.clip(d, -1, 1, out=d)
            self.m *= 0.9
            self.m += np.float32(0.1) * d
            d *= d
            d *= np.float32(0.01)
            self.v *= 0.99
            self.v += d
            np.divide(self.v, np.float32(1 - 0.99**self.t), out=d)
            np.sqrt(d, out=d)
            d += np.float32(1e-4)
            np.divide(self.m, d, out=d)
            d *= np.float32(self.rate / (1 - 0.9**self.t))
            self.flat -= d


def encoded(docs: DataFrame, vocabulary: Vocabulary, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``shard, at, ids``: the word ids of each training text, packed in 16 bits;
    shard and place follow from id and text."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    place = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    kept = docs.where(training(key)).select(place.alias("at"), F.col(text).alias("_text"))

    def run(batches):
        for batch in batches:
            at = batch.column(0).to_numpy()
            for lo, hi, data, offsets in chunks(batch, "_text", 4 << 20):
                h, first = token_hashes(data, offsets)
                raw = known.value.look(h)[0].astype("<u2").tobytes()
                own = at[lo:hi]
                texts = [raw[2 * a : 2 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(((own >> 8) % shards).astype(np.int64)), pa.array(own), pa.array(texts, pa.binary())], names=["shard", "at", "ids"])

    return kept.mapInArrow(run, "shard bigint, at bigint, ids binary")


def train(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, folder: str | None = None) -> dict[str, np.ndarray]:
    """Weights after all rounds."""
    w = initial(vocabulary)
    context = docs.sparkSession.sparkContext
    shards = max(rounds, -(-vocabulary.total // SHARD_TOKENS))
    passes = min(MOST_PASSES, max(1, -(-LEAST_TOKENS // max(vocabulary.total, 1))))
    tasks = min(-(-shards // rounds), 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = cut(encoded(docs, vocabulary, shards, key, text), "encoded", folder)
    for turn in range(rounds):
        held = context.broadcast(w)

        def run(batches, held=held):
            total, tokens, trainer, shard, waiting, n = 0.0, 0, None, None, [], 0

            def learnt():
                nonlocal waiting, n
                if n:
                    size = np.array([len(x) for x in waiting])
                    ids = np.concatenate(waiting).astype(np.int64)
                    for _ in range(passes):
                        trainer.learn(ids, np.concatenate([[0], np.cumsum(size)]))
                waiting, n = [], 0

            def closed():
                nonlocal total, tokens
                if trainer is not None:
                    learnt()
                    total, tokens = total + pack(trainer.w).astype(np.float64) * trainer.tokens, tokens + trainer.tokens

            for batch in batches:
                for own, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
                    if own != shard:
                        closed()
                        trainer, shard = Trainer(held.value), own
                    waiting.append(np.frombuffer(ids.as_buffer(), "<u2"))
                    n += len(waiting[-1])
                    if n >= 2 * SHARD_TOKENS:  # very long texts
                        learnt()
            closed()
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % _GROUPS], pa.int32()), pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["g", "tokens", "weights"])

        def added(batches):
            total, tokens = 0.0, 0
            for batch in batches:
                for t, b in zip(batch.column(1).to_pylist(), batch.column(2)):
                    total, tokens = total + np.frombuffer(b.as_buffer(), np.float64), tokens + t
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["g", "tokens", "weights"])

        own = rows.where(F.pmod("shard", F.lit(rounds)) == turn).repartition(tasks, "shard").sortWithinPartitions("shard", "at", "ids")
        schema = "g int, tokens bigint, weights binary"
        # at most _GROUPS rows of one model each come back
        parts = own.mapInArrow(run, schema).repartition(_GROUPS, "g").mapInArrow(added, schema).collect()
        if parts:
            w = unpack(sum(np.frombuffer(r.weights, np.float64) for r in parts) / sum(r.tokens for r in parts), w)
    return w


def score_rows(w: dict[str, np.ndarray], ids: np.ndarray, first: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """Natural log-likelihood of each row under the model."""
    size = np.diff(first)
    total = np.zeros(len(size))
    order = np.argsort(-size, kind="stable")
    longest_first = size[order]
    table = w["embed"] @ w["in"] + w["bias"]
    h = np.zeros((len(size), w["state"].shape[0]), np.float32)
    states, targets, rows, waiting = [], [], [], 0
    last = int(longest_first[0]) if len(size) else 0
    # how many rows are still running at each step
    running = np.searchsorted(-longest_first, -np.arange(last), "left") if last else []

    def flush():
        i, r = np.concatenate(targets), np.concatenate(rows)
        np.add.at(total, r, log_output(w, np.concatenate(states), i).astype(np.float64))

    for t in range(last):
        n = int(running[t])
        own = order[:n]
        at = first[own] + t
        before = ids[at - 1] if t else np.full(n, len(w["embed"]) - 1)
        h, _, _, _ = _step(w, table[before], h[:n])
        states.append(h)
        targets.append(ids[at])
        rows.append(own)
        waiting += n
        if waiting >= block:
            flush()
            states, targets, rows, waiting = [], [], [], 0
    if waiting:
        flush()
    return total


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", held: int = HELD, rounds: int = ROUNDS, folder: str | None = None):
    """(counts table, vocabulary, weights)."""
    ship(docs.sparkSession)
    counts = cut(token_counts(docs, key, text), "counts", folder)
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = [tuple(r) for r in counts.orderBy(F.desc("n"), "token").limit(held).collect()]
    vocabulary = Vocabulary(top, int(total), int(types))
    return counts, vocabulary, train(docs, vocabulary, key, text, rounds, folder)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", held: int = HELD, rounds: int = ROUNDS) -> DataFrame:
    """Learn from the training rows and score all rows."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    counts, vocabulary, weights = learn(docs, key, text, held, rounds, folder)
    known, model = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(weights)
    kept = docs.select(key, (~training(key)).alias("held_out"), text)
    named = ["held_out", "n_tokens", "known", "n_rest", "base", "model", "rare", "rare_n"]

    def run(batches):
        v = known.value
        held, parts, n = [], [], 0

        def table():
            ids, size, have, rest, base, base_rest, rare, times, n_rare = (np.concatenate(x) for x in zip(*parts))
            first = np.concatenate([[0], np.cumsum(size)])
            own = score_rows(model.value, ids, first) / np.log(10) + base_rest
            where = np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32)
            columns = [pa.array(size), pa.array(have.astype(np.int64)), pa.array(rest.astype(np.int64)), pa.array(base), pa.array(own)]
            columns += [pa.ListArray.from_arrays(pa.array(where), pa.array(x)) for x in (rare.view(np.int64), times.astype(np.int64))]
            keys = [pa.concat_arrays(x) for x in zip(*held)]
            held.clear(), parts.clear()
            return pa.RecordBatch.from_arrays([*keys, *columns], names=[key, *named])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.columns[:2])
            for _, _, data, offsets in chunks(batch, text):
                h, first = token_hashes(data, offsets)
                ids, count = v.look(h)
                row = np.repeat(np.arange(len(first) - 1), np.diff(first))
                have = count >= 0
                # tokens that are not held: distinct in each row, with their numbers
                other = np.flatnonzero(~have)
                own = np.lexsort((h[other], row[other]))
                r, t = row[other][own], h[other][own]
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (t[1:] != t[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(r)))
                logs = np.log10(np.maximum(count, 0) + 1.0)
                width = len(first) - 1
                rest = ids == v.words
                parts.append((ids, np.diff(first), np.bincount(row, have, width), np.bincount(row, rest, width), np.bincount(row, logs, width), np.bincount(row, logs * rest, width), t[at], times, np.bincount(r[at], minlength=width)))
                n += len(h)
            if n > TOGETHER:
                yield table()
                n = 0
        if held:
            yield table()

    kind = kept.schema[0].dataType.simpleString()
    rows = cut(kept.mapInArrow(run, f"`{key}` {kind}, held_out boolean, n_tokens bigint, known bigint, n_rest bigint, base double, model double, rare array<bigint>, rare_n array<bigint>"), "scored", folder)
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    base, model_part, known_n = F.col("base"), F.col("model"), F.col("known")
    if vocabulary.types > held:
        each = rows.select("_row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("_row", F.col("x.rare").alias("token"), F.col("x.rare_n").alias("times"))
        found = each.join(counts, "token").groupBy("_row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
        rows = rows.drop("rare", "rare_n").join(found, "_row", "left")
        logs = F.coalesce("logs", F.lit(0.0))
        base, model_part, known_n = base + logs, model_part + logs, known_n + F.coalesce("more", F.lit(0))
    v = vocabulary
    return rows.select(
        key,
        "held_out",
        "n_tokens",
        known_n.cast("bigint").alias("n_known"),
        F.lit(v.total).cast("bigint").alias("train_tokens"),
        (base - F.col("n_tokens") * float(np.log10(v.total + v.types + 1))).alias("base_score"),
        (model_part - F.col("n_rest") * float(np.log10(v.rest + v.rest_types + 1))).alias("score"),
    )
