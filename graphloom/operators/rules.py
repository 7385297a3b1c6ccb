"""Rules as frames of ``rule, severity, entity, id, detail``; a validator is
their union.  Row rules are found in one pass over a table; referential rules
are anti-joins, which stay distributed whatever the size of either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import in_unit, name_key, text, trim_u

#: The types and review states that graphs may use.
NODE_TYPES = ("concept", "skill", "procedure", "misconception", "task", "assessment", "resource", "curriculum", "source_chunk")
EDGE_TYPES = ("requires", "part_of", "extends", "applies_to", "procedure_step_of", "confuses_with", "misconception_of", "assesses", "remediates", "same_as", "related_to")
REVIEW_STATES = ("accepted", "needs_review", "rejected", "draft")
GROUP_EDGE_TYPES = ("part_of", "requires", "extends", "related_to", "applies_to")


def row_rules(df: DataFrame, entity: str, id_: Column, checks: list[tuple[str, str, Column, Column | None]]) -> DataFrame:
    """``checks``: (rule, severity, condition, detail); one scan for all."""
    found = [F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))).alias("detail"))) for rule, severity, bad, detail in checks]
    rows = df.select(id_.alias("id"), F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v"))
    return rows.select("v.rule", "v.severity", F.lit(entity).alias("entity"), F.coalesce("id", F.lit("")).alias("id"), "v.detail")


def violations(df: DataFrame, rule: str, severity: str, entity: str, id_: Column, detail: Column | None = None) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(entity).alias("entity"), F.coalesce(id_.cast("string"), F.lit("")).alias("id"), (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))).alias("detail"))


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def summary(found: DataFrame) -> DataFrame:
    """One row: valid, error_count, warning_count."""
    errors, warnings = (F.coalesce(F.sum(F.when(F.col("severity") == s, 1)), F.lit(0)).cast("bigint") for s in "EW")
    return found.agg(errors.alias("error_count"), warnings.alias("warning_count")).withColumn("valid", F.col("error_count") == 0)


def gate(frame: DataFrame, found: DataFrame) -> DataFrame:
    """``frame`` if ``found`` has no error, else no rows."""
    bad = found.where("severity = 'E'").limit(1).select(F.lit(1).alias("_bad"))
    return frame.withColumn("_one", F.lit(1)).join(F.broadcast(bad), F.col("_one") == F.col("_bad"), "left_anti").drop("_one")


# -- parts of several validators ---------------------------------------------


def duplicate_values(df: DataFrame, column: str = "id") -> DataFrame:
    """Values that occur more than once, with their number."""
    return df.where(F.coalesce(column, F.lit("")) != "").groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def later_occurrences(df: DataFrame, column: str = "id", order: str = "pos") -> DataFrame:
    """All rows with a value but the first of each."""
    rank = F.row_number().over(W.partitionBy(column).orderBy(order))
    return df.where(F.coalesce(column, F.lit("")) != "").withColumn("_n", rank).where("_n > 1").drop("_n")


def missing(df: DataFrame, column: str, known: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose ``column`` is not a ``key`` of ``known``."""
    return df.join(known.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def exploded(df: DataFrame, column: str, out: str = "ref") -> DataFrame:
    """One row for each entry with text."""
    return df.withColumn(out, F.explode(column)).where(text(F.col(out)).isNotNull())


def refs(c: str = "source_refs") -> Column:
    """Entries with text in them."""
    return F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda r: trim_u(r) != "")


def known_refs(sources: DataFrame) -> DataFrame:
    """Both forms of reference: the source, and the source with a chunk."""
    whole = sources.select(F.col("source_id").alias("ref"))
    return whole.unionByName(sources.select(F.concat_ws("#", "source_id", "chunk_id").alias("ref"))).distinct()


def unknown_refs(df: DataFrame, sources: DataFrame) -> DataFrame:
    """``id, ref`` of references to nothing known; none if nothing is known at all."""
    known = known_refs(sources)
    any_known = F.broadcast(known.limit(1).select(F.lit(1).alias("_any")))
    rows = exploded(df, "source_refs").select("id", "ref").join(known, "ref", "left_anti")
    return rows.withColumn("_any", F.lit(1)).join(any_known, "_any", "left_semi").select("id", "ref")


def duplicate_names(nodes: DataFrame) -> DataFrame:
    """``name_key, ids, n`` of names that several nodes have; ids in input order."""
    keyed = nodes.withColumn("name_key", name_key(*(F.col(c) for c in ("subject", "stage", "curriculum", "name"))))
    grouped = keyed.groupBy("name_key").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("x"), F.count("*").alias("n")).where("n > 1")
    return grouped.select("name_key", F.array_join(F.col("x.id"), ", ").alias("ids"), "n")


def state_checks(state: Column, conf: Column) -> list[tuple[str, str, Column, Column | None]]:
    return [
        ("invalid_review_state", "E", (state != "") & ~state.isin(*REVIEW_STATES), state),
        ("missing_confidence", "E", conf.isNull(), None),
        ("confidence_range", "E", ~in_unit(conf), conf),
    ]


def state() -> Column:
    return F.coalesce(trim_u(F.col("review_state")), F.lit(""))


def node_checks() -> list:
    kind = F.coalesce("type", F.lit(""))
    return [
        ("missing_id", "E", F.coalesce("id", F.lit("")) == "", None),
        ("invalid_type", "E", ~kind.isin(*NODE_TYPES), kind),
        ("missing_name", "E", text(F.col("name")).isNull(), None),
        *state_checks(state(), F.col("confidence")),
        ("missing_refs", "E", (kind != "source_chunk") & (F.size(refs()) == 0), None),
    ]


def edge_checks(types: tuple[str, ...] = EDGE_TYPES) -> list:
    kind = F.coalesce("type", F.lit(""))
    return [
        ("missing_id", "E", F.coalesce("id", F.lit("")) == "", None),
        ("invalid_type", "E", ~kind.isin(*types), kind),
        ("self_loop", "E", F.col("source") == F.col("target"), F.col("source")),
        ("no_evidence", "E", text(F.col("evidence")).isNull() & text(F.col("reason")).isNull(), None),
        ("missing_refs", "E", F.size(refs()) == 0, None),
        *state_checks(state(), F.col("confidence")),
    ]


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    ids = nodes.select("id").distinct()
    return union(*(violations(edges.join(ids, F.col(end) == ids["id"], "left_anti"), f"{end}_missing", "E", "edge", F.col("id"), F.col(end)) for end in ("source", "target")))


def validate_graph(nodes: DataFrame, edges: DataFrame, sources: DataFrame, cycle: DataFrame | None = None) -> DataFrame:
    """All rules of a graph; ``cycle`` has a row with its text if it has one."""
    edge_rules = [*edge_checks(), ("accepted_related_to", "W", (F.col("type") == "related_to") & (state() == "accepted"), None)]
    out = [
        row_rules(nodes, "node", F.col("id"), node_checks()),
        row_rules(edges, "edge", F.col("id"), edge_rules),
        violations(duplicate_values(nodes), "duplicate_id", "E", "node", F.col("id")),
        violations(duplicate_values(edges), "duplicate_id", "E", "edge", F.col("id")),
        dangling(edges, nodes),
        violations(unknown_refs(nodes, sources), "unknown_ref", "W", "node", F.col("id"), F.col("ref")),
        violations(unknown_refs(edges, sources), "unknown_ref", "W", "edge", F.col("id"), F.col("ref")),
        violations(duplicate_names(nodes), "duplicate_name", "W", "node", F.col("name_key"), F.col("ids")),
    ]
    if cycle is not None:
        out.append(violations(cycle, "requires_cycle", "E", "graph", F.lit(""), F.col("cycle")))
    return union(*out)


def validate_candidates(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rules of a batch: every later copy of an id is an error; ends need only be there."""
    base = [c for c in node_checks() if c[0] != "missing_refs"] + [("missing_refs", "E", F.size(refs()) == 0, None)]
    kind = F.coalesce("type", F.lit(""))
    own = [
        ("invalid_type", "E", ~kind.isin(*EDGE_TYPES), kind),
        ("missing_end", "E", text(F.col("source")).isNull() | text(F.col("target")).isNull(), None),
        ("self_loop", "E", F.col("source") == F.col("target"), F.col("source")),
        ("missing_refs", "E", F.size(refs()) == 0, None),
        *state_checks(state(), F.col("confidence")),
        ("related_to_unreviewed", "W", (kind == "related_to") & (state() != "needs_review"), None),
    ]
    return union(
        row_rules(nodes, "node", F.col("id"), base),
        row_rules(edges, "edge", F.col("id"), own),
        violations(later_occurrences(nodes), "duplicate_id", "E", "node", F.col("id")),
        violations(later_occurrences(edges), "duplicate_id", "E", "edge", F.col("id")),
    )


def validate_product(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rules of a product graph (of ``id, name, grade, definition`` and so on)."""
    checks = [
        ("missing_id", "E", text(F.col("id")).isNull(), None),
        ("missing_name", "E", text(F.col("name")).isNull(), None),
        ("missing_grade", "E", F.col("grade").isNull(), None),
        ("empty_definition", "W", text(F.col("definition")).isNull(), None),
    ]
    ends = [("self_loop", "E", F.col("source") == F.col("target"), None), ("confidence_range", "E", ~in_unit(F.col("confidence")), F.col("confidence"))]
    key = W.partitionBy("source", "target", "type").orderBy("pos")
    twice = edges.withColumn("_n", F.row_number().over(key)).where("_n > 1")
    named = edges.withColumn("id", F.concat_ws("->", "source", "target"))
    return union(
        row_rules(nodes, "node", F.col("id"), checks),
        violations(later_occurrences(nodes), "duplicate_id", "E", "node", F.col("id")),
        row_rules(named, "edge", F.col("id"), ends),
        dangling(named, nodes),
        violations(twice, "duplicate_edge", "E", "edge", F.concat_ws("->", "source", "target"), F.col("type")),
    )


def untouched_groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Groups without a semantic edge at either end and without a note."""
    semantic = edges.where("type <> 'part_of'")
    touched = semantic.select(F.col("source").alias("id")).unionByName(semantic.select(F.col("target").alias("id"))).distinct()
    return nodes.where((F.col("type") == "knowledge_group") & text(F.col("note")).isNull()).join(touched, "id", "left_anti")


def validate_groups(nodes: DataFrame, edges: DataFrame, cycle: DataFrame | None = None) -> DataFrame:
    """All rules of a group map; ``cycle`` has a row with its text if its ``requires`` edges have one."""
    group = F.col("type") == "knowledge_group"
    checks = [
        ("invalid_type", "E", ~F.col("type").isin("domain", "knowledge_group"), F.col("type")),
        ("missing_name", "E", text(F.col("name")).isNull(), None),
        ("missing_domain", "E", text(F.col("domain")).isNull(), None),
        ("missing_refs", "E", F.size(refs()) == 0, None),
        ("missing_points", "E", group & (F.size(refs("points")) == 0), None),
        ("sparse_detail", "W", group & text(F.col("summary")).isNull(), None),
        *state_checks(state(), F.col("confidence")),
    ]
    edges = edges.withColumn("reason", F.lit(None).cast("string"))
    looped = [] if cycle is None else [violations(cycle, "requires_cycle", "E", "graph", F.lit(""), F.col("cycle"))]
    return union(
        *looped,
        row_rules(nodes, "node", F.col("id"), checks),
        violations(later_occurrences(nodes.withColumn("pos", F.col("ord"))), "duplicate_id", "E", "node", F.col("id")),
        row_rules(edges, "edge", F.col("id"), edge_checks(GROUP_EDGE_TYPES)),
        dangling(edges, nodes),
        violations(untouched_groups(nodes, edges), "no_semantic_edge", "E", "node", F.col("id")),
    )
