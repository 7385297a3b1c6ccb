"""All registered queries of the graph, map and text operators."""

from __future__ import annotations

from graphloom.plans import base, build_queries, graph_queries, map_queries, text_queries  # noqa: F401  (they register)


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
