"""The pipeline's stages in turn, on a small table with every kind of fault."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm import decontaminate

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_stages_keep_the_columns(stages):
    for df in stages[:-1]:
        assert set(df.columns) == set(corpus_pipeline.COLUMNS)
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_decisions_take_effect(spark, stages):
    counts = [s.count() for s in stages]
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4] == counts[5]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.digests(stages[2], bench).where("contaminated").count() > 0
    assert decontaminate.digests(stages[3], bench).where("contaminated").count() == 0
    assert stages[3].where(F.col("text").rlike("AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}")).count() > 0
    assert stages[4].where(F.col("text").rlike("AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}")).count() == 0
    got = stages[4].join(stages[5], "doc_id").where(F.sha2(F.col("text").cast("binary"), 256) != F.col("decoded_sha256"))
    assert got.count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_no_secret_is_named_in_the_mask():
    assert not re.search("[0-9a-f]{16,}", "[SECRET]")
