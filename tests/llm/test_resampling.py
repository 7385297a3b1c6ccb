"""Importance resampling, line removal and conversation repair against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from graphloom.llm import conversations, importance, lines

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def features(text, longest):
    w = WORD.findall(lower(text))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def resampled(rows, target, longest, percent):
    """What the contract says, in plain Python."""
    docs, wanted = [(r[0], *features(r[1], longest)) for r in rows], [features(t, longest)[1] for t in target]
    s, t = Counter(x for d in docs for x in d[2]), Counter(x for f in wanted for x in f)
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (S + 10000) / ((s[k] + 1) * (T + 10000)))) for k in range(10000)]
    out, able = [], []
    for key, n, f in docs:
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        if n >= 20:
            able.append(len(out) - 1)
    able.sort(key=lambda i: (-out[i][3], out[i][0] is not None, out[i][0] or 0))
    places = {i: k + 1 for k, i in enumerate(able[: len(able) * percent // 100])}
    return out, places


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (1, 60), (3, 25)])
def test_resampling(spark, docs, rows, longest, percent):
    target = [rows[5][1], None, "", rows[5][1].upper(), "é漢字😀 ñ", rows[30][1]]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    want, places = resampled(rows, target, longest, percent)
    got = importance.resample(docs, bench, longest=longest, percent=percent).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(want)
    ranked = {r["rank"]: tuple(r)[:4] for r in got if r["rank"] is not None}
    assert sorted(ranked) == list(range(1, len(places) + 1))
    for i, k in places.items():  # repeated ids with equal scores may change places
        assert ranked[k][3] == want[i][3] and ranked[k][0] == want[i][0]
    assert importance.drawn(docs, bench, longest=longest, percent=percent).columns == docs.columns


def test_resampling_of_nothing(spark, docs, empty):
    assert importance.resample(empty, docs).count() == 0
    alone = importance.resample(docs, empty)
    assert alone.count() == docs.count() and alone.where("rank is not null").count() > 0


def test_crc32_of_spans():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.concatenate([rng.integers(0, 4000, 300), [0, 7, 4999, 0]])
    ends = np.concatenate([starts[:300] + rng.integers(0, 200, 300), [0, 8, 5000, 5000]])
    assert importance.crc32_of_spans(data, starts, ends).tolist() == [zlib.crc32(data[a:b]) for a, b in zip(starts, ends)]
    assert importance.crc32_of_spans(data, starts[:0], ends[:0]).tolist() == []


def test_run_lengths():
    value, n = importance.run_lengths(np.array([5, 1, 5, 5, 0], np.uint16))
    assert value.tolist() == [0, 1, 5] and n.tolist() == [1, 1, 3]
    assert importance.run_lengths(np.zeros(0, np.uint16))[0].tolist() == []


WHITE = " \t\n\x0b\x0c\r"


def stripped(rows, least_chars, least_docs):
    """Rows as (id, lines, dropped, text) after the removal, in plain Python."""
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = defaultdict(list)
    for r, (i, own) in enumerate(split):
        for k in {lower(x.strip(WHITE)) for x in own}:
            if len(k) >= least_chars:
                holders[k].append(r)
    out = []
    for i, own in split:
        kept = []
        for x in own:
            have = holders.get(lower(x.strip(WHITE)), [])
            ids = [split[r][0] for r in have if split[r][0] is not None]
            if len(have) < least_docs or i == (max(ids) if ids else None):
                kept.append(x)
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def with_lines(rows):
    shared = ["A line that many documents have, with É and 漢字, and a number 12345", "another shared line of the corpus that is long enough to count", "short"]
    out = []
    for k, r in enumerate(rows):
        t = r[1]
        if t and k % 2:
            t = f"{t}\n \t{shared[0].upper() if k % 4 == 1 else shared[0]}\r\nown {k}\n{shared[0]}\n{shared[2]}"
        if t and k % 3 == 0:
            t = f"{shared[1]}\n{t}\n{shared[1]}\n"
        out.append((*r[:1], t, *r[2:]))
    return out


@pytest.fixture(scope="module")
def lined(spark, docs, rows):
    own = with_lines(rows)
    return spark.createDataFrame(own, docs.schema).repartition(3), own


@pytest.mark.parametrize(("least_chars", "least_docs"), [(40, 5), (1, 2), (40, 1000)])
def test_line_removal(lined, least_chars, least_docs):
    table, own = lined
    want = stripped([r[:2] for r in own], least_chars, least_docs)
    got = lines.digests(table, least_chars=least_chars, least_docs=least_docs)
    assert Counter(map(tuple, got.collect())) == Counter((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in want)
    whole = lines.remove_lines(table, least_chars=least_chars, least_docs=least_docs)
    assert whole.columns == table.columns
    texts = Counter((w[0], None if r[1] is None else w[3], r[5]) for w, r in zip(want, own))
    assert Counter((r.doc_id, r.text, r["_row"]) for r in whole.collect()) == texts


def test_line_removal_in_small_shards(lined, monkeypatch):
    table, own = lined
    monkeypatch.setattr(lines, "SHARD_KEYS", 3)
    monkeypatch.setattr(lines, "COPY_PROBES", 4)
    want = stripped([r[:2] for r in own], 1, 2)
    got = lines.digests(table, least_chars=1, least_docs=2)
    assert Counter(tuple(r)[:3] for r in got.collect()) == Counter(w[:3] for w in want)


def test_line_removal_of_nothing(empty):
    assert lines.digests(empty).count() == 0
    assert lines.remove_lines(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, 2 * n).astype(np.uint64) for _ in range(2))
    a[: n // 2] = a[0] if n else 0  # equal in one word only
    index = lines.PerfectHash.of(a[:n], b[:n])
    assert sorted(index(a[:n], b[:n])) == list(range(n))
    arrays = lines.LineArrays.unpacked(lines.LineArrays.of(a[:n], b[:n], np.arange(1, n + 1), -np.arange(n)).packed())
    counts, keepers = arrays.probe(a, b)
    assert counts[:n].tolist() == list(range(1, n + 1)) and keepers[:n].tolist() == (-np.arange(n)).tolist()
    assert not counts[n:].any()


INITIALS = re.compile("(s?(ua)+)?", re.A)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit, lines) over all edits of a short conversation, without any states: all strings of edits are tried."""
    most = 2 * len(rows) + 2
    found = []

    def go(i, inserted, cost, audit, lines):
        if found and cost > min(found)[0]:
            return
        if i == len(rows):
            if INITIALS.fullmatch("".join(r[:1] if r else "?" for r, _ in lines)):
                found.append((cost, audit, tuple(lines)))
        else:
            role, text, must, off = rows[i]
            go(i + 1, 0, cost + 3, audit + "D", lines)
            if not must:
                go(i + 1, 0, cost + off, audit + "K", [*lines, (role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, 0, cost + 2 + off, audit + "R", [*lines, (r, text)])
        if inserted < 2 and len(lines) < most:
            for r in ("user", "assistant"):
                go(i, inserted + 1, cost + 2, audit + "I", [*lines, (r, "")])

    go(0, 0, 0, "", [])
    return min(found)


def repaired(rows, damaging=True):
    after = defaultdict(list)
    for r in damage(rows) if damaging else rows:
        after[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(after[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, judged, faults = set(), [], Counter()
        for _, _, role, text in own:
            visible = text.strip(WHITE)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines_ = cheapest(judged)
        body = "\n".join(f"{r}:{t}" for r, t in lines_)
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())
    return out


TALK = "conv_id bigint, turn bigint, role string, text string, c string, n string, rank string, cost string, _kind string"


def talks():
    rng = random.Random(11)
    texts = ["Hello there.", "What now?", "no end", "", " \t\n", None, "It is so!", "Fine. ", " ", "é漢字。"]
    out = []
    for conv in [*range(70), None]:
        for turn in range(rng.randint(0, 4)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            out.append((conv, rng.choice([turn, turn, turn, turn * 3, None, 1]), role, rng.choice(texts)))
    return [(*r, "x", "y", "z", "w", "v") for r in [*out, out[5], out[5]]]


@pytest.mark.parametrize("damaging", [True, False])
def test_conversation_repair(spark, damaging):
    rows = talks()
    table = spark.createDataFrame(rows, TALK).repartition(3)
    plain = [r[:4] for r in rows]
    want = repaired(plain if damaging else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in plain], damaging)
    got = {r[0]: tuple(r)[1:] for r in conversations.digests(table, damage=damaging).collect()}
    assert got == want


def state_walk(rows):
    """Least cost and audit by a plain walk over the states, for long conversations."""
    best = {0: (0, "")}
    for _, _, x, must, off in rows:
        new = {}
        for p, (cost, audit) in best.items():
            for (x2, m2, o2, p2, q), (c, a) in conversations.steps().items():
                if (x2, m2, o2, p2) == (x, must, off, p):
                    new[q] = min(new.get(q, (1 << 60, "")), (cost + c, audit + a))
        best = new
    return min((c + 2 * len(conversations.CLOSING[q]), a + conversations.CLOSING[q]) for q, (c, a) in best.items())


def test_long_conversations_in_segments(spark):
    rng = random.Random(2)
    rows = [(conv, turn, rng.choice(["user", "assistant"]), f"{rng.random()}{rng.choice(['.', ''])}") for conv, n in ((1, 700), (2, 64), (3, 65), (4, 1), (5, 4097)) for turn in range(n)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in conversations.digests(table, damage=False).collect()}
    texts = defaultdict(list)
    for r in conversations.repair(table).collect():
        texts[r.conv_id].append((r.pos, r.k, r.role, r.text))
    for conv in got:
        own = [r for r in rows if r[0] == conv]
        cost, audit = state_walk([(0, 0, r[2][0], False, not r[3].endswith(".")) for r in own])
        assert (got[conv].cost, got[conv].audit) == (cost, audit)
        lines_ = [(r, t) for _, _, r, t in sorted(texts[conv])]
        assert INITIALS.fullmatch("".join(r[0] for r, _ in lines_))
        assert len(lines_) == len(audit) - audit.count("D")
        assert got[conv].repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines_).encode()).hexdigest()


def test_conversations_of_nothing(spark):
    none = spark.createDataFrame([], TALK)
    assert conversations.digests(none).count() == 0
    assert conversations.repair(none).count() == 0
