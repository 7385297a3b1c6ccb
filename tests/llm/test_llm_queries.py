"""The registered SQL of this subpackage on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from graphloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = c.execute(queries.oracle_sql()[name])
    named = [d[0] for d in result.description]
    assert sorted(named) == columns
    assert Counter(tuple(r[x] for x in columns) for r in df.collect()) == Counter(tuple(row[named.index(x)] for x in columns) for row in result.fetchall())
