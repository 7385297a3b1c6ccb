import hashlib

import pytest
from pyspark.sql import functions as F

from graphloom.functions import text as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("x")).first().x


@pytest.mark.parametrize(
    "value,slug",
    [("Hello, World!", "hello-world"), ("  A_b/C|d ", "a-b-c-d"), ("数与 代数", "数与-代数"), ("", "da39a3ee5e6b"), ("!!!", hashlib.sha1(b"!!!").hexdigest()[:12]), (None, hashlib.sha1(b"None").hexdigest()[:12]), ("　x　", "x")],
)
def test_slugify(spark, value, slug):
    assert one(spark, value, T.slugify) == slug


def test_slug_is_stable(spark):
    assert one(spark, "a b", lambda c: T.slugify(T.slugify(c))) == "a-b"


@pytest.mark.parametrize("value,grade", [("3-4年级", 3), ("三年级", 3), ("none", 7), (None, 7), (" ", 7), ("９年", 9)])
def test_parse_grade(spark, value, grade):
    assert one(spark, value, lambda c: T.parse_grade(c, 7)) == grade


def test_symmetric_edges_have_one_id(spark):
    df = spark.createDataFrame([("related_to", "b", "a"), ("related_to", "a", "b"), ("requires", "b", "a"), ("requires", "a", "b")], "t string, s string, d string")
    ids = [r.x for r in df.select(T.edge_id(F.col("t"), F.col("s"), F.col("d")).alias("x")).collect()]
    assert ids[0] == ids[1] == "edge:related_to:a:b:" + hashlib.sha1(b"related_to|a|b").hexdigest()[:10]
    assert ids[2] != ids[3]


def test_term_count_does_not_overlap(spark):
    assert one(spark, "aaaa aa", lambda c: T.search_score(c, "AA x")) == 3


@pytest.mark.parametrize("value,out", [("a  b\n c", "a b c"), ("x" * 12, "x" * 9 + "…"), ("12345678  abc", "12345678…")])
def test_compact_text(spark, value, out):
    assert one(spark, value, lambda c: T.compact_text(c, 10)) == out


def test_clean_text(spark):
    assert one(spark, " a\x07 \r\n\r\n\r\n b ", T.clean_text) == "a\n\nb"


@pytest.mark.parametrize("line,noise", [("12", True), ("1234", False), ("义务教育课程标准", True), ("续表", True), ("—— |", True), ("", True), ("text", False)])
def test_noise(spark, line, noise):
    assert one(spark, line, T.is_noise) is noise


def test_ocr_fixups_keep_their_order(spark):
    assert one(spark, "【教学提示了】（1）", T.ocr_fixups) == "【教学提示】】(1)"


def test_clean_statement_cuts_at_sentences(spark):
    assert one(spark, "(1) 认识 数", T.clean_statement) == "认识数"
    long = "甲" * 70 + "。" + "乙" * 200
    assert one(spark, long, T.clean_statement) == "甲" * 70 + "。"
    assert one(spark, "甲" * 300, T.clean_statement) == "甲" * 180 + "。"


def test_confidence_bounds(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.1,), (float("nan"),), (None,)], "c double")
    assert [r.x for r in df.select(T.in_unit(F.col("c")).alias("x")).collect()] == [True, True, False, False, None]


@pytest.mark.parametrize("score,grade", [(90.0, "A"), (89.99, "B"), (70.0, "C"), (60.0, "D"), (1.0, "F")])
def test_quality_grade(spark, score, grade):
    assert one(spark, score, T.quality_grade, "double") == grade
