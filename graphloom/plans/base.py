"""How queries are registered: a function of views, and SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.plans.views import VIEWS, duck, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Inputs:
    """Tables and views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return view(self.spark, self.sf_dir, name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register ``f(inputs)`` under its name, with SQL that gives the same rows."""

    def add(f: Callable[[Inputs], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if sql:
            SQL[key] = duck(sql)
        return f

    return add


# -- DuckDB spellings of the text functions ------------------------------------


def TRIM(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def TXT(x: str) -> str:
    return f"nullif({TRIM(f'CAST({x} AS VARCHAR)')}, '')"


def FT(*x: str) -> str:
    return f"coalesce({', '.join(map(TXT, x))}, '')"


def SLUGB(x: str) -> str:
    a = rf"regexp_replace(lower({TRIM(f'coalesce({x}, {chr(39) * 2})')}), '[\s\p{{Z}}_/|:;,.()\[\]{{}}]+', '-', 'g')"
    b = rf"regexp_replace({a}, '[^0-9a-z\-\x{{4e00}}-\x{{9fff}}]+', '', 'g')"
    return f"regexp_replace(regexp_replace({b}, '-+', '-', 'g'), '^-|-$', '', 'g')"


def SLUG(x: str) -> str:
    return f"CASE WHEN {SLUGB(x)} <> '' THEN {SLUGB(x)} ELSE substr(sha1(coalesce({x}, 'None')), 1, 12) END"


def COMPACT(x: str) -> str:
    return TRIM(rf"regexp_replace({x}, '[\s\p{{Z}}]+', ' ', 'g')")


def REFS(x: str = "source_refs") -> str:
    return f"list_filter({x}, r -> {TRIM('r')} <> '')"


STATE = "coalesce(" + TRIM("review_state") + ", '')"


def NSLUG(x: str, cases: str = "", fallback: str = "''") -> str:
    own = TXT(x)
    return f"CASE WHEN {own} IS NULL THEN {fallback} {cases.replace('@@', own)} WHEN regexp_full_match(lower({own}), '[a-z][a-z0-9_-]*') THEN lower({own}) ELSE {SLUG(own)} END"


def EDGE_ID(t: str, s: str, d: str) -> str:
    sym = f"{t} IN ('confuses_with', 'related_to', 'same_as') AND {s} > {d}"
    a, b = f"CASE WHEN {sym} THEN {d} ELSE {s} END", f"CASE WHEN {sym} THEN {s} ELSE {d} END"
    return f"concat('edge:', {t}, ':', {SLUG(f'({a})')}, ':', {SLUG(f'({b})')}, ':', substr(sha1(concat({t}, '|', {a}, '|', {b})), 1, 10))"


def TERMS(hay: str, query: str) -> str:
    return " + ".join(f"CAST((length({hay}) - length(replace({hay}, '{t}', ''))) / {len(t)} AS BIGINT)" for t in query.lower().split())
