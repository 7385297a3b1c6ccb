"""Every registered query with SQL gives the rows of that SQL on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from graphloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def norm(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    return tuple(map(norm, x)) if isinstance(x, list | tuple) else x


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(registry.oracle_sql()[name])
    named = [d[0] for d in result.description]
    assert sorted(named) == columns
    want = Counter(tuple(norm(row[named.index(c)]) for c in columns) for row in result.fetchall())
    assert got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
