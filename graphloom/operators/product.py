"""Projection of graph nodes and edges onto the product graph, and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import STAGE_SLUGS, SUBJECT_SLUGS, compact, first_text, normalize_slug, parse_grade, text
from graphloom.operators.graph import first_of, selected, with_both_ends

#: What is exported unless other sets are named.
NODE_TYPES = ("concept", "skill", "procedure", "task", "assessment")
EDGE_TYPES = ("requires", "part_of", "extends", "applies_to", "procedure_step_of", "assesses", "related_to")
STATES = ("accepted", "needs_review", "draft", "")


def csv_set(value: str | None, default: tuple[str, ...]) -> tuple[str, ...]:
    """A comma list as a set; nothing given is the default, and blank has no way to be named."""
    return default if not value else tuple(dict.fromkeys(x.strip() for x in value.split(",") if x.strip()))


def product_id() -> Column:
    return first_text(F.col("ext_map"), F.col("ext_product"), F.col("id"))


def definition() -> Column:
    return compact(first_text(F.col("definition"), F.col("summary")))


def skills(c: str = "skills") -> Column:
    """Trimmed, not blank, each once, in order."""
    own = F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: first_text(x))
    return F.array_distinct(F.filter(own, lambda x: x != ""))


def english_name() -> Column:
    """The first alias in plain Latin letters."""
    own = F.filter(F.transform("aliases", lambda x: first_text(x)), lambda x: x.rlike("^[A-Za-z0-9 ,;:()/_-]+$"))
    return F.coalesce(F.try_element_at(own, F.lit(1)), F.lit(""))


def domain(fallback: str = "") -> Column:
    """The domain, else the first tag that is not a mere anchor."""
    tag = F.try_element_at(F.filter("tags", lambda t: text(t).isNotNull() & (text(t) != "lesson-anchor")), F.lit(1))
    return normalize_slug(F.coalesce(text(F.col("domain")), tag), None, fallback)


def difficulty(fallback: int = 3) -> Column:
    return F.coalesce(F.col("difficulty").try_cast("bigint"), F.lit(fallback).cast("bigint"))


def product_nodes(nodes: DataFrame, default_subject: str = "", default_stage: str = "", default_grade: int = 0, default_curriculum: str = "", default_domain: str = "", default_difficulty: int = 3) -> DataFrame:
    subject, stage = normalize_slug(F.col("subject"), SUBJECT_SLUGS, default_subject), normalize_slug(F.col("stage"), STAGE_SLUGS, default_stage)
    curriculum = first_text(F.col("curriculum"), F.lit(default_curriculum))
    name = first_text(F.col("name"), F.col("id"))
    path = F.when((curriculum != "") & (subject != ""), F.concat(curriculum, F.lit("/"), subject, F.lit(".json"))).otherwise("")
    return nodes.select(
        product_id().alias("id"),
        F.col("id").alias("internal_id"),
        name.alias("name"),
        english_name().alias("name_en"),
        first_text(F.col("type")).alias("type"),
        subject.alias("subject"),
        parse_grade(F.col("grade"), default_grade).alias("grade"),
        domain(default_domain).alias("domain"),
        difficulty(default_difficulty).alias("difficulty"),
        definition().alias("definition"),
        F.array_join(skills(), ",").alias("skills"),
        stage.alias("stage"),
        curriculum.alias("curriculum"),
        path.alias("tree_path"),
        name.alias("display_name"),
        "confidence",
        "pos",
    )


def export_nodes(nodes: DataFrame, types=NODE_TYPES, states=STATES, least: float = 0.0, require_definition: bool = False) -> DataFrame:
    out = selected(nodes.where(text(F.col("id")).isNotNull()), types, states, least)
    return out.where(definition() != "") if require_definition else out


def export_edges(edges: DataFrame, chosen: DataFrame, types=EDGE_TYPES, states=STATES, least: float = 0.0) -> DataFrame:
    """Edges of the types and states between exported nodes, without loops."""
    return with_both_ends(selected(edges, types, states, least).where("source <> target"), chosen)


def looked_up(edges: DataFrame, products: DataFrame) -> DataFrame:
    """Ends by product id.  An internal id that occurs twice stands for its last row."""
    last = products.groupBy("internal_id").agg(F.max_by("id", "pos").alias("pid"))
    a, b = last.toDF("source", "_a"), last.toDF("target", "_b")
    return edges.join(a, "source").join(b, "target").withColumns({"source": F.col("_a"), "target": F.col("_b")}).drop("_a", "_b")


def product_edges(edges: DataFrame, chosen: DataFrame, products: DataFrame, **kw) -> DataFrame:
    return first_of(looked_up(export_edges(edges, chosen, **kw), products), "source", "target", "type")


def cross_subject(edges: DataFrame, products: DataFrame) -> DataFrame:
    """Edges between science and another named subject."""
    by_id = products.groupBy("id").agg(F.max_by("subject", "pos").alias("s"))
    a, b = by_id.toDF("source", "_s"), by_id.toDF("target", "_t")
    both = edges.join(a, "source").join(b, "target")
    return both.where("(_s = 'science' and _t not in ('', 'science')) or (_t = 'science' and _s not in ('', 'science'))").drop("_s", "_t")


def product_stats(products: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of totals, with the subjects and grades as sorted lists of ``name:count``."""

    def listed(column: str, name: str) -> DataFrame:
        counts = products.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("v")).agg(F.count("*").alias("n"))
        pairs = F.array_sort(F.collect_list(F.struct("v", "n")))
        return counts.agg(F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["v"], p["n"])), ",").alias(name))

    unified = F.coalesce(F.sum(F.when(F.col("curriculum") == "cn-unified", 1)), F.lit(0)).cast("bigint")
    science = F.coalesce(F.sum(F.when((F.col("subject") == "science") & (F.col("stage") == "elementary"), 1)), F.lit(0)).cast("bigint")
    totals = products.agg(F.count("*").alias("total_nodes"), unified.alias("cn_unified"), science.alias("sci_elementary"))
    totals = totals.withColumn("international", F.col("total_nodes") - F.col("cn_unified"))
    # each side is one row of aggregates
    for one in (edges.agg(F.count("*").alias("total_edges")), cross_subject(edges, products).agg(F.count("*").alias("sci_cross_edges")), listed("subject", "by_subject"), listed("grade", "by_grade")):
        totals = totals.join(F.broadcast(one))
    return totals
