"""Encoding, decoding, token files and shards against the libraries and definitions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from graphloom.llm import bpe, dac, shards, texts
from graphloom.llm.queries import vocabulary
from graphloom.llm.store import shared_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = vocabulary("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_digests_equal_the_library(docs, rows, library):
    def expected(doc_id, text):
        ids = library.encode_ordinary(text or "")
        return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    got = Counter(map(tuple, bpe.digests(docs, RANKS).collect()))
    assert got == Counter(expected(r[0], r[1]) for r in rows)


def test_round_trip_keeps_columns(docs, rows):
    back = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert set(back.columns) == set(docs.columns)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r[0], r[1] or "") for r in rows)


def test_random_pieces_equal_the_library(library):
    rng = random.Random(2)
    letters = ["a", "b", "s", "t", "'", "'s", "'ll", " ", "  ", "\n", "1", "é", "漢字", "😀", "!", "　", "\x1c", "\x85", "²", "Ⅷ", " don't", "'S", "\r\n", "﻿", "مرحبا"]
    encoder, decoder = bpe.codec(RANKS)
    for text in ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + ["zq" * 900, "=-" * 400]:
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder(raw, np.array([0, len(raw)]))
        assert ids.tolist() == library.encode_ordinary(text)
        assert "".join(decoder.texts(ids, block=3)) == text


def test_states_are_built_anew_beyond_the_limit(library):
    machine = bpe.Transducer(bpe.load_ranks(RANKS), most_states=50)
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 14)))
        assert machine.encode(word.encode()) == library.encode_ordinary(word)


@pytest.mark.parametrize("bad", [b"\xc3(", b"\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xc0\xaf"])
def test_ill_formed_bytes_are_refused(bad):
    with pytest.raises(ValueError):
        stream = bpe.Utf8Stream()
        stream.feed(bad)
        stream.close()


def test_utf8_stream_at_every_cut():
    raw = "aé漢😀z".encode()
    for i in range(len(raw) + 1):
        stream = bpe.Utf8Stream()
        assert stream.feed(raw[:i]) + stream.feed(raw[i:]) == raw.decode()
        stream.close()


@pytest.mark.parametrize("bits", [8, 16])
def test_codes_give_any_slice(bits):
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.choice([0, 3, 255, 256, 50_256, 70_000, 2**31], n)
        reader = dac.DacReader(dac.dac_encode(ids, bits))
        for lo, hi in ((0, n), (n // 3, n // 2), (n, n), (max(n - 1, 0), n)):
            assert reader.slice(lo, hi).tolist() == ids[lo:hi].tolist()
        assert all(reader[i] == ids[i] for i in range(0, n, 97))


def test_token_files(spark, docs, rows):
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    got = dac.tokens(docs, path).collect()
    want = Counter()
    for doc_id, text in ((r[0], r[1]) for r in rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))


def test_token_files_with_added_tokens(spark):
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["plain text", "a <|endoftext|> b", "<|endo", "ftext|> x", "<|endoftext|><|endoftext|>é", "", "é <|endoftext|", "last"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = [(r.n_tokens, r.ids_crc32) for r in sorted(dac.tokens(rows, path).collect(), key=lambda r: r.doc_id)]
    want = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert 50256 in want[1]
    assert got == [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in want]


def test_shards(docs, rows):
    placed = shards.number_slots(shards.assign(docs, 8)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert all(r.grown_shard in (r.shard, 8) for r in placed)
    for s in range(8):
        slots = sorted(r.slot for r in placed if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(len({r.shard for r in placed if r.doc_id == k}) == 1 for k in {r.doc_id for r in placed})


def test_slots_of_a_key_that_holds_most_rows(spark):
    many = spark.range(6000).repartition(6).select(F.when(F.col("id") < 5000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    slots = {}
    for r in shards.number_slots(shards.assign(many, 8)).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == 6000 and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_jump_hash_is_even_and_moves_little():
    keys = np.arange(80_000, dtype=np.uint64)
    a, b = shards.jump_hash(keys, 8), shards.jump_hash(keys, 9)
    assert abs(np.bincount(a) / 10_000 - 1).max() < 0.05
    assert set(b[a != b]) == {8} and abs((a != b).mean() - 1 / 9) < 0.01


def test_write_shards_keeps_rows(spark, docs):
    path = shared_folder(spark) + "/shards"
    shards.write_shards(docs.drop("shard"), path)
    assert spark.read.parquet(path).count() == docs.count()


def test_empty_tables(empty):
    assert bpe.digests(empty, RANKS).count() == 0
    assert dac.tokens(empty, vocabulary("byte_bpe_50k.json")).count() == 0
    assert shards.number_slots(shards.assign(empty)).where(F.col("slot") >= 0).count() == 0


def test_a_worker_holds_the_tables_of_one_operator():
    a, b = {"x": 1}, {"y": 2}
    texts.only("first", a.clear)
    texts.only("first", a.clear)
    assert a
    texts.only("second", b.clear)
    assert not a and b
    texts.only()
    assert not b
