"""The two trained models: definitions, gradients, held-out results, edge cases."""

import random
import re
import zlib
from collections import Counter
from math import exp, log, log10, tanh

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import cotrain, gru

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


@pytest.mark.parametrize("held", [gru.HELD, 20])
def test_base_score_is_the_definition(docs, rows, held):
    out = [zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 7 == 2 for r in rows]
    counts = Counter(t for r, o in zip(rows, out) if not o for t in tokens(r[1]))
    total = sum(counts.values())

    def expected(r, o):
        own = tokens(r[1])
        base = sum(log10((counts[t] + 1) / (total + len(counts) + 1)) for t in own)
        return r[0], o, len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)

    got = gru.score(docs, held=held).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == Counter(expected(r, o) for r, o in zip(rows, out))
    assert all(r.score < 0 for r in got)


def vocabulary(n=1500):
    return gru.Vocabulary([(i * 7919 + 3, max(1, 5000 // (i + 1))) for i in range(n)], sum(max(1, 5000 // (i + 1)) for i in range(n)) + 50, n + 40)


def shape(v):
    """Words and width of a model."""
    return v.words, v.side // 2


def test_probabilities_sum_to_one():
    v = vocabulary()
    w, (words, width) = gru.initial(v), shape(v)
    h = np.random.default_rng(0).normal(size=(3, width)).astype(np.float32)
    ids = np.arange(words + 1)
    for k in range(3):
        p = np.exp(gru.log_output(w, np.repeat(h[k : k + 1], len(ids), 0), ids))
        assert p.sum() == pytest.approx(1, abs=1e-3)


def test_gradients_are_those_of_the_loss():
    v = vocabulary()
    words, width = shape(v)
    w = {k: x.astype(np.float64) for k, x in gru.initial(v).items()}
    rng = np.random.default_rng(1)
    targets = rng.integers(0, words + 1, (5, 4))
    inputs = rng.integers(0, words + 2, (5, 4))
    live = np.arange(5)[:, None] < np.array([5, 3, 5, 1])[None]
    opens = rng.random((5, 4)) < 0.3
    h0 = rng.normal(size=(4, width))
    _, g, _ = gru._gradients(w, h0, inputs, targets, live, opens)
    for key in w:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w[key].shape)
            if key == "embed":
                at = (int(inputs[0, 0]), at[1])
            kept, e = w[key][at], 1e-5
            w[key][at] = kept + e
            up = gru._gradients(w, h0, inputs, targets, live, opens)[0]
            w[key][at] = kept - e
            down = gru._gradients(w, h0, inputs, targets, live, opens)[0]
            w[key][at] = kept
            assert g[key][at] == pytest.approx((up - down) / (2 * e), abs=2e-3)


def test_tokens_are_looked_up_by_leading_bits():
    crowded = np.concatenate([np.arange(40), np.arange(40) + (2**63 - 41), np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 500)]).astype(np.int64)
    v = gru.Vocabulary([(int(t), 600 - k) for k, t in enumerate(crowded)], 200_000, len(crowded))
    h = np.concatenate([crowded, crowded + 1, [-1, 0, 2**62]]).astype(np.int64)
    counts = {int(t): 600 - k for k, t in enumerate(crowded)}
    ids, n = v.look(h.view(np.uint64))
    assert n.tolist() == [counts.get(int(t), -1) for t in h]
    assert ids.tolist() == [min(600 - counts[int(t)], v.words) if int(t) in counts else v.words for t in h]


@pytest.mark.parametrize("scale", [1, 300])
def test_large_weights_do_not_overflow(scale):
    v = vocabulary()
    w, (words, width) = gru.initial(v), shape(v)
    for k in ("class", "word"):
        w[k] = w[k] * np.float32(scale)
    h = np.random.default_rng(4).uniform(-1, 1, (1, width)).astype(np.float32)
    with np.errstate(all="raise", under="ignore"):
        logs = gru.log_output(w, np.repeat(h, words + 1, 0), np.arange(words + 1))
    assert np.isfinite(logs).all() and np.exp(logs.astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)
    exact = h[0].astype(np.float64) @ w["class"] + w["class_bias"]
    assert logs[-1] == pytest.approx(exact[-1] - np.logaddexp.reduce(exact), rel=1e-4, abs=1e-4)


def test_a_trainer_learns_in_one_vector():
    v = vocabulary()
    start = gru.initial(v)
    trainer = gru.Trainer(start)
    ids = np.random.default_rng(5).integers(0, v.words + 1, 4000)
    trainer.learn(ids, np.array([0, 1500, 4000]))
    assert all(np.shares_memory(x, trainer.flat) for x in trainer.w.values())
    assert np.array_equal(gru.pack(trainer.w), trainer.flat) and not np.array_equal(gru.pack(start), trainer.flat)


def test_state_is_carried_through_long_texts():
    v = vocabulary()
    w, (words, width) = gru.initial(v), shape(v)
    ids = np.random.default_rng(2).integers(0, words + 1, 3000)
    whole = gru.score_rows(w, ids, np.array([0, 3000]), block=64)[0]
    h, total, before = np.zeros((1, width), np.float32), 0.0, words + 1
    for i in ids:
        h = gru._step(w, w["embed"][[before]] @ w["in"] + w["bias"], h)[0]
        total += gru.log_output(w, h, np.array([i]))[0]
        before = i
    assert whole == pytest.approx(total, rel=1e-4)


def said(text, w, v, counts, total, types):
    """The score of a text, number by number, from the weights."""
    width, side = v.side // 2, v.side
    order = sorted(counts, key=lambda t: (-counts[t], t))[: v.words]
    place, rest = {t: i for i, t in enumerate(order)}, total - sum(counts[t] for t in order)
    h, before, out = [0.0] * width, v.words + 1, 0.0
    one = lambda x: 1 / (1 + exp(-x))
    for t in text:
        x = [sum(float(w["embed"][before][i]) * float(w["in"][i][j]) for i in range(width)) + float(w["bias"][j]) for j in range(3 * width)]
        z = [one(x[j] + sum(h[i] * float(w["gates"][i][j]) for i in range(width))) for j in range(width)]
        r = [one(x[width + j] + sum(h[i] * float(w["gates"][i][width + j]) for i in range(width))) for j in range(width)]
        c = [tanh(x[2 * width + j] + sum(r[i] * h[i] * float(w["state"][i][j]) for i in range(width))) for j in range(width)]
        h = [h[j] + z[j] * (c[j] - h[j]) for j in range(width)]
        before = place.get(t, v.words)
        kind, at = divmod(before, side)
        scores = [sum(h[i] * float(w["class"][i][j]) for i in range(width)) + float(w["class_bias"][j]) for j in range(side + 1)]
        out += (scores[kind] - log(sum(map(exp, scores)))) / log(10)
        if before == v.words:
            out += log10((counts.get(t, 0) + 1) / (rest + types - len(order) + 1))
        else:
            scores = [sum(h[i] * float(w["word"][kind][i][j]) for i in range(width)) + float(w["word_bias"][kind][j]) for j in range(side)]
            out += (scores[at] - log(sum(map(exp, scores)))) / log(10)
    return out


def test_scores_are_those_of_the_model_written_out(spark, docs, rows, monkeypatch):
    made, learn = [], gru.learn
    monkeypatch.setattr(gru, "learn", lambda *a: made.append(learn(*a)) or made[-1])
    got = Counter((r.doc_id, r.n_tokens, round(r.score, 2)) for r in gru.score(docs).collect())
    table, v, w = made[0]
    by_hash = {r.token: r.n for r in table.collect()}
    total, types = sum(by_hash.values()), len(by_hash)

    def hashes(text):
        raw = (text or "").encode()
        h, _ = gru.token_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        return h.view(np.int64).tolist()

    some = [r for r in rows if len(r[1] or "") < 900][:12]
    for r in some:
        want = said(hashes(r[1]), w, v, by_hash, total, types)
        assert any(k[0] == r[0] and abs(k[2] - want) < 0.02 + 1e-3 * abs(want) for k in got), (r[0], want)


def test_scores_do_not_hang_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    sums = []
    for n in (1, 8, 64):
        got = gru.score(docs.repartition(n)).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
        sums.append(got[0])
        assert got[0] > got[1]
    assert max(sums) - min(sums) < 1e-4 * abs(sums[0])


def test_learning_beats_counts_on_held_out_texts(spark):
    rng = random.Random(4)
    cycle = [f"w{i}" for i in range(30)]
    rows = []
    for k in range(900):
        at, words = rng.randrange(30), []
        for _ in range(60):
            words.append(cycle[at])
            at = (at + rng.choice((1, 1, 1, 2))) % 30
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(2)
    got = gru.score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.9 * got[1]


def test_every_training_text_teaches(spark, docs):
    rows = gru.token_counts(docs)
    v = gru.Vocabulary([tuple(r) for r in rows.collect()], rows.agg(F.sum("n")).first()[0], rows.count())
    taught = gru.encoded(docs, v, 5).collect()
    assert sum(len(r.ids) // 2 for r in taught) == v.total
    assert len(taught) == docs.where(gru.training("doc_id")).count()
    assert {r.shard for r in taught} == set(range(5))


def test_empty_and_untrained(spark, empty):
    assert gru.score(empty).count() == 0
    only = spark.createDataFrame([(k, "some words") for k in range(40)], "doc_id int, text string").where(~gru.training("doc_id"))
    got = gru.score(only).collect()
    assert got and all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in got)


def labelled(n=1200, seed=6):
    rng = random.Random(seed)
    good, bad = [f"good{i}" for i in range(80)], ["insult", "junk", "spam"]
    docs, labels = [], []
    for k in range(n):
        is_bad = rng.random() < 0.25
        words = [rng.choice(good) for _ in range(rng.randint(20, 90))]
        if is_bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((k, " ".join(words), "en" if rng.random() < 0.9 else None, "noisy" if is_bad and rng.random() < 0.4 else "src", len(words)))
        if k % 2:
            labels.append((k, int(not is_bad), int(is_bad and k % 3 == 0)))
    return docs, labels


def test_classifier_on_unlabelled_documents(spark):
    docs, labels = labelled()
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = cotrain.classify(d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    truth = {r[0]: not any(w in r[1].split() for w in ("insult", "junk", "spam")) for r in docs}
    unseen = [r for r in got if r.doc_id % 2 == 0]
    assert np.mean([r.keep == truth[r.doc_id] for r in unseen]) > 0.97


def test_views_help_each_other():
    rng = np.random.default_rng(0)
    x = [(np.array([1 if y else 2, 10 + k % 5], np.int32), np.zeros(cotrain.SHAPES, np.float32), np.array([3 if y else 4, 600, 1030])) for k, y in enumerate(rng.integers(0, 2, 300))]
    y = np.array([d[0][0] == 1 for d in x]).astype(int)
    model = cotrain.CoTrained().fit(x[:200], y[:200], x[200:])
    z = model._views(x[200:])
    assert ((z > 0) == y[200:, None]).mean() > 0.95


def test_classifier_edge_cases(spark, docs, empty):
    schema = "doc_id bigint, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    assert {r.quality_score for r in cotrain.classify(docs, none).collect()} == {1.0}
    one_sided = spark.createDataFrame([(3 * i, 1, 0) for i in range(20)] + [(None, 0, 0), (6, None, None)], schema)
    assert {r.quality_score for r in cotrain.classify(docs, one_sided).collect()} == {1.0}
    mixed = spark.createDataFrame([(3 * i, i % 2, 0) for i in range(40)] + [(3, 0, 1)], schema)
    got = cotrain.classify(docs, mixed)
    assert got.count() == docs.count() and set(docs.columns) < set(got.columns)
    assert cotrain.classify(empty, mixed).count() == 0
