"""Secrets, decontamination, repeated strings, near duplicates and fingerprints against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import dartminhash, decontaminate, secrets, spotsigs, suffix
from graphloom.llm.components import components
from graphloom.llm.store import shared_folder
from graphloom.llm.texts import Hasher, mix64

KINDS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def found_secrets(text):
    out = [(m.start(), k, m.end(), kind) for k, (kind, p, g, least) in enumerate(KINDS) for m in p.finditer(text or "") if len(m[g]) >= least]
    return sorted(out)


def test_secrets(docs, rows):
    def expected(doc_id, text):
        found = found_secrets(text)
        spans = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in found)
        return (doc_id, *(sum(f[1] == k for f in found) for k in range(3)), sha(spans), spans)

    assert Counter(map(tuple, secrets.findings(docs).collect())) == Counter(expected(r[0], r[1]) for r in rows)


def test_ledger_scans_only_what_is_new(spark, docs, rows):
    path = shared_folder(spark) + "/ledger"
    old, new = docs.where("doc_id < 60"), docs
    secrets.update(old, path, fresh=True)
    first = spark.read.schema(secrets.LEDGER).parquet(path)
    n = first.count()
    assert n == old.select("text").na.fill("").distinct().count()
    secrets.update(new, path)
    after = spark.read.schema(secrets.LEDGER).parquet(path)
    assert after.count() == len({r[1] or "" for r in rows}) == after.select("_blob").distinct().count()
    raised = (*secrets.RULES[:2], secrets.Rule("hex", r"[0-9a-f]{40,}", 0, 40, version=2))
    secrets.update(new, path, rules=raised)
    ids = spark.read.schema(secrets.LEDGER).parquet(path).select(F.explode("_rules").alias("r")).groupBy("r").count().collect()
    assert {r["r"]: r["count"] for r in ids} == dict.fromkeys(("assign@1", "access@1", "hex@1", "hex@2"), after.count())
    got = secrets.findings(new, ledger=path, rules=raised).agg(F.sum("n_hex")).first()[0]
    assert got == sum(f[3] == "hex" and f[2] - f[0] >= 40 for r in rows for f in found_secrets(r[1]))


def test_redaction(docs, rows):
    got = {(r.doc_id, r.text) for r in secrets.redact(docs).collect()}

    def masked(text):
        if text is None:
            return None
        out, at = "", 0
        for s, _, e, _ in found_secrets(text):
            if s >= at:
                out += text[at:s] + "[SECRET]"
            at = max(at, e)
        return out + text[at:]

    assert got == {(r[0], masked(r[1])) for r in rows}
    assert secrets.redact(docs).columns == docs.columns


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def bench(spark, rows):
    texts = [rows[5][1].split()[3:30], rows[9][1].split()[:10], rows[9][1].split()[4:14], ["one"], rows[6][1].split()[:4], [], ["absent"] * 12]
    items = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(None, " ".join(rows[7][1].split()[2:9])), (0, " ".join(texts[0])), (50, None)]
    return spark.createDataFrame(items, "item_id bigint, text string, doc_id string"[: -len(", doc_id string")]), items


@pytest.mark.parametrize("block", [16 << 20, 60])
def test_decontamination(docs, rows, bench, block):
    table, items = bench
    windows = [(i, w[k : k + 10]) for i, t in items for w in [words(t)] if w for k in range(max(len(w) - 9, 1))]

    def expected(doc_id, text):
        own, hit, ids = words(text), set(), set()
        for i, w in windows:
            for k in range(len(own) - len(w) + 1):
                if own[k : k + len(w)] == w:
                    hit |= set(range(k, k + len(w)))
                    ids |= {str(i)} if i is not None else set()
        return doc_id, len(own), len(hit), tuple(sorted(ids))

    found = decontaminate.hits(docs, table, block_bytes=block)
    assert set(docs.columns) < set(found.columns)
    got = Counter((r.doc_id, r.n_words, sum(x.b - x.a for x in r.hit_runs), tuple(r.hit_items)) for r in found.collect())
    assert got == Counter(expected(r[0], r[1]) for r in rows)


def test_decontamination_digests_and_removal(docs, rows, bench):
    table, _ = bench
    got = decontaminate.digests(docs, table).collect()
    assert all(r.contaminated == (r.n_hit > 0) for r in got) and any(r.contaminated for r in got)
    clean = decontaminate.remove_spans(docs, table)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert decontaminate.digests(clean, table).where("contaminated").count() == 0


@pytest.mark.parametrize("block", [16 << 20, 60])
def test_decontamination_leaves_columns_of_any_name(docs, rows, bench, block):
    table, _ = bench
    odd = docs.withColumnsRenamed({"_row": "n_words", "shard": "hit_runs", "label": "_items", "source": "_row"}).withColumn("hit_items", F.lit("mine"))
    clean = decontaminate.remove_spans(odd, table, block_bytes=block)
    assert clean.columns == odd.columns
    assert Counter((r.doc_id, r.n_words, r.hit_runs, r["_items"], r["_row"], r.hit_items) for r in clean.collect()) == Counter((r[0], r[5], r[6], r[7], r[3], "mine") for r in rows)
    assert Counter(r.text for r in clean.collect()) == Counter(r.text for r in decontaminate.remove_spans(docs, table).collect())
    found = decontaminate.hits(odd, table, block_bytes=block)
    assert Counter((r["_row"], r["_items"]) for r in found.collect()) == Counter((r[3], r[7]) for r in rows)
    assert decontaminate.hits(docs.limit(0), table, block_bytes=block).count() == 0


def test_spans_are_cut_without_a_second_python_pass(spark):
    item = " ".join(f"w{i}" for i in range(12))
    table = spark.createDataFrame([("a", item)], "item_id string, text string")
    texts = [None, "", "none", item, f"é {item} ü, {item}. ß", f"x{item}, {item[:-4]} €"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    clean = decontaminate.remove_spans(docs, table)
    assert clean._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = [r.text for r in clean.orderBy("doc_id").collect()]
    assert got == [None, "", "none", " ", "é   ü,  . ß", "xw0   €"]


def test_a_block_is_a_few_times_its_items():
    rng = np.random.default_rng(1)
    items = [(str(k), " ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 200))) for k in range(2000)]
    known = decontaminate.WindowSet(items)
    assert known.nbytes < 4 * sum(len(t) for _, t in items)


def repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    at = defaultdict(list)
    for i, t in enumerate(raw):
        for s in range(len(t) - length + 1):
            at[t[s : s + length]].append((i, s))
    on = [np.zeros(len(t), bool) for t in raw]
    for places in at.values():
        if len(places) > 1:
            for i, s in places:
                on[i][s : s + length] = True
    return raw, on


@pytest.mark.parametrize("window", [(400, 32, 16), (60, 8, 4), (30, 30, 3)])
@pytest.mark.parametrize("passage", [(50, 4, 8), (7, 2, 2)])
def test_repeated_strings(docs, rows, window, passage):
    raw, on = repeats([r[1] for r in rows], window[0])
    names = [(r[0], r[1]) for r in rows]
    at = defaultdict(set)
    own = [words(t) for _, t in names]
    for i, w in enumerate(own):
        for s in range(len(w) - passage[0] + 1):
            at[tuple(w[s : s + passage[0]])].add((names[i], i, s))
    shared = [np.zeros(len(w), bool) for w in own]
    for places in at.values():
        if len({p[0] for p in places}) > 1:
            for _, i, s in places:
                shared[i][s : s + passage[0]] = True
    want = Counter()
    for r, t, m, w in zip(rows, raw, on, shared):
        n, k = (int(x[:1].sum() + (x[1:] & ~x[:-1]).sum()) for x in (m, w))
        want[r[0], len(t), int(m.sum()), n, hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest(), int(w.sum()), k] += 1
    got = Counter(map(tuple, suffix.digests(docs, window=suffix.Scale(*window), passage=suffix.Scale(*passage)).collect()))
    assert got == want


def test_repeated_strings_are_cut_out(docs, rows):
    cut_out = suffix.remove(docs, window=suffix.Scale(60, 8, 4))
    assert cut_out.columns == docs.columns
    raw, on = repeats([r[1] for r in rows], 60)
    kept = [None if r[1] is None else np.frombuffer(t, np.uint8)[~m].tobytes().decode("utf-8", "ignore") for r, t, m in zip(rows, raw, on)]
    assert Counter(map(tuple, cut_out.collect())) == Counter((r[0], k, *r[2:]) for r, k in zip(rows, kept))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_near_duplicates(docs, rows):
    got = dartminhash.groups(docs.withColumn("doc_id", F.monotonically_increasing_id()).cache()).join(docs.withColumn("doc_id", F.monotonically_increasing_id()).select("doc_id", "text"), "doc_id").collect()
    sets = [shingles(r.text) for r in got]
    parent = list(range(len(got)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(got)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            alike = both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) if sets[i] and sets[j] else (got[i].text or "") == (got[j].text or "")
            if alike:
                parent[root(i)] = root(j)
    want, found = defaultdict(set), defaultdict(set)
    for i, r in enumerate(got):
        want[root(i)].add(r.doc_id)
        found[r.class_id].add(r.doc_id)
    assert {frozenset(x) for x in want.values()} == {frozenset(x) for x in found.values()}
    assert all(min(v) == k for k, v in found.items())
    kept = dartminhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(want)


@pytest.mark.parametrize("weights", [None, "some"])
def test_signatures_estimate_similarity(weights):
    rng = np.random.default_rng(3)
    a, b = {}, {}
    for i in range(300):
        w = rng.choice([0.5, 1.0, 2.5]) if weights else 1.0
        if rng.random() < 0.9:
            a[i] = w
        if rng.random() < 0.9:
            b[i] = w * (2 if weights and rng.random() < 0.3 else 1)
    union = set(a) | set(b)
    true = sum(min(a.get(i, 0), b.get(i, 0)) for i in union) / sum(max(a.get(i, 0), b.get(i, 0)) for i in union)
    ids = np.random.default_rng(9).integers(0, 2**62, 300).astype(np.uint64)
    e = np.concatenate([ids[list(a)], ids[list(b)]])
    r = np.repeat([0, 1], [len(a), len(b)])
    s = dartminhash.signatures(e, r, 2, 2000, np.array([*a.values(), *b.values()]) if weights else None)
    assert abs((s[0] == s[1]).mean() - true) < 0.04


def test_chains_of_links_are_one_component(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("x", "y"), ("y", "x"), ("z", "z")]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"{i:03}"] for i in range(41)} == {"000"} and got["y"] == "x" and got["z"] == "z"


def test_a_star_of_near_copies_is_one_group(spark):
    """Copies that are near the first text but not near each other."""
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base))]
    for k in range(1, 30):
        own = base.copy()
        for j in range(7):
            own[(k * 13 + j * 57) % 400] = f"n{k}x{j}"
        rows.append((k, " ".join(own)))
    got = dartminhash.groups(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {r.class_id for r in got} == {0}


@pytest.mark.parametrize("part", [512, 2])
def test_a_bridge_between_two_families(spark, part, monkeypatch):
    """Every similar pair is judged: two families of near copies are joined by one pair of texts that each belongs to one of them."""
    base = [f"w{i}" for i in range(1000)]

    def changed(words, places, tag):
        return [f"{tag}{i}" if i in places else w for i, w in enumerate(words)]

    x = changed(base, range(10, 110, 10), "x")
    y = changed(x, range(510, 610, 10), "y")
    left = [changed(x, range(710 + k, 860 + k, 10), f"a{k}_") for k in range(6)]
    right = [changed(y, range(210 + k, 360 + k, 10), f"b{k}_") for k in range(6)]
    texts = [" ".join(t) for t in [*left, *right, x, y]]
    monkeypatch.setattr(dartminhash, "PART", part)
    got = {r.doc_id: r for r in dartminhash.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    sets = [shingles(t) for t in texts]
    alike = [[i != j and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    assert alike[12][13] and not any(alike[i][j] for i in (*range(6), 12) for j in (*range(6, 12), 13) if (i, j) != (12, 13))
    assert {r.class_id for r in got.values()} == {0}


@pytest.mark.parametrize("part", [512, 16])
def test_many_near_copies_of_one_text(spark, part, monkeypatch):
    """Copies with one in a hundred to one in eight words changed: some have no similar copy at all, yet groups are those of all pairs."""
    monkeypatch.setattr(dartminhash, "PART", part)
    rng = np.random.default_rng(17)
    base, texts = [f"w{i}" for i in range(150)], []
    for k in range(120):
        own = base.copy()
        for i in rng.choice(150, rng.integers(1, 19), replace=False):
            own[i] = f"n{k}x{i}"
        texts.append(" ".join(own))
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert 10 < len(set(label)) < 110
    got = {r.doc_id: r.class_id for r in dartminhash.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == label


def test_names_of_the_input_do_not_clash(spark):
    rows = [(1, "a b c d e f", "k", "c", "n", "t"), (2, "a b c d e f", "k", "c", "n", "t"), (3, None, "k3", "c", "n", "t")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, _key string, _class string, _n string, _text string")
    assert [tuple(r) for r in dartminhash.keep_one(docs).orderBy("doc_id").collect()] == [rows[0], rows[2]]
    assert {(r.doc_id, r.class_id, r.copy_id) for r in dartminhash.groups(docs).collect()} == {(1, 1, 1), (2, 1, 1), (3, 3, 3)}


def test_spotsigs(docs, rows):
    got = spotsigs.compared(docs).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    texts = Counter((r[0], len(r[1] or "")) for r in rows)
    assert Counter((r.doc_id, r.n_chars) for r in got) == texts
    ordered = sorted({r[0]: (r[1] or "") for r in rows if r[0] is not None and r[0] not in (3, 15)}.items())
    for (k, own), (k2, following) in zip(ordered, ordered[1:]):
        if k2 - k == 3:
            half = len(own) // 2
            edited = own[: len(own) - half] + following[:half]
            assert [r.edited_sha256 for r in got if r.doc_id == k] == [sha(edited)]
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == pytest.approx(spotsigs.likeness(spotsigs.parse(r.fingerprint), spotsigs.parse(r.edited_fingerprint)))
    prints = {(r.doc_id, r.text): r.fingerprint for r in spotsigs.fingerprints(docs).collect()}
    for (_, text), p in prints.items():
        by_text[text or ""].add(p)
    assert all(len(v) == 1 for v in by_text.values())


def test_all_signatures_of_long_texts_are_compared(spark):
    own = [f"the alpha{i} beta{i}" for i in range(600)]
    other = own[:300] + [f"the gamma{i} delta{i}" for i in range(300)]
    texts = [" ".join(own), " ".join(other)]
    got = spotsigs.compared(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert [r.near_next for r in got] == [pytest.approx(300 / 900)] * 2
    assert all(len(spotsigs.parse(r.fingerprint)[0]) == 600 for r in got)


def test_one_document_follows_itself(spark):
    got = spotsigs.compared(spark.createDataFrame([(7, "the cat sat on the mat")], "doc_id bigint, text string")).collect()
    assert len(got) == 1 and got[0].near_next == 1.0


def test_empty_tables(spark, empty, bench):
    assert secrets.findings(empty).count() == 0 and secrets.redact(empty).count() == 0
    assert decontaminate.digests(empty, bench[0]).count() == 0
    assert suffix.digests(empty).count() == 0
    assert dartminhash.groups(empty).count() == 0 and dartminhash.keep_one(empty).count() == 0
    assert spotsigs.compared(empty).count() == 0


def test_no_benchmark_items(spark, docs, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = decontaminate.digests(docs, none)
    assert got.count() == len(rows) and got.where("contaminated").count() == 0


def test_ranges_are_brought_together_once(spark, monkeypatch):
    """Before, all ranges were sent and written once to tell them apart and once more to group them."""
    names, cut = [], suffix.cut
    monkeypatch.setattr(suffix, "cut", lambda df, name, *more, **options: names.append(name) or cut(df, name, *more, **options))
    text = "".join(chr(97 + int(x)) for x in np.random.default_rng(8).integers(0, 26, 900))
    docs = spark.createDataFrame([(1, text), (1, text), (2, "x" + text[:450]), (3, text[::-1])], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_removed, r.n_spans) for r in suffix.digests(docs).collect())
    assert got == [(1, 900, 1), (1, 900, 1), (2, 450, 1), (3, 0, 0)]
    assert "grouped" in names and "ranges" not in names


def test_spans_of_one_width_at_all_starts():
    data = np.random.default_rng(9).integers(0, 256, 5000).astype(np.uint8)
    for symbols in (data, mix64(data.astype(np.uint64))):
        exact, at = Hasher(symbols), np.arange(5000 - 32 + 1)
        assert np.array_equal(exact.every(32), exact(at, at + 32))
    assert mix64(np.array([1]))[0] == np.uint64(0x5692161D100B05E5)
