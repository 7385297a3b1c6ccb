"""Page ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def parse_page_range(value: str, last: int | None = None) -> list[int]:
    """``1-3,8`` as distinct pages in the order named; pages must exist."""
    out: list[int] = []
    for part in (p.strip() for p in value.split(",")):
        if not part:
            continue
        a, _, b = part.partition("-")
        first, end = int(a), int(b or a)
        if first < 1 or end < first or (last is not None and end > last):
            raise ValueError(f"no such pages: {part}")
        out += range(first, end + 1)
    if not out:
        raise ValueError("no pages named")
    return list(dict.fromkeys(out))


def page_range(spark: SparkSession, value: str, last: int | None = None) -> DataFrame:
    return spark.createDataFrame([(p,) for p in parse_page_range(value, last)], "page bigint")
