"""Maps of knowledge groups: selection, layout, export and the quality report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import first_text, quality_grade, ratio, slug_base, text
from graphloom.operators.graph import _stored, degrees, first_of, repeats, review_state, with_both_ends
from graphloom.operators.ordered import ranked
from graphloom.operators.rules import refs, state

#: Weights of the parts of the score.
WEIGHTS = {"source_refs": 15, "points": 20, "summary": 15, "progression": 10, "teaching": 10, "relations": 15, "evidence": 10, "review": 5}
#: Heights of domains and numbers of columns that have their own.
DOMAIN_Y = {"number-algebra": 5.2, "geometry": 1.7, "statistics-probability": -1.8, "synthesis-practice": -5.0}
COLUMNS = {"number-algebra": 9, "geometry": 7}


def chosen_nodes(nodes: DataFrame, states: tuple[str, ...] = ("accepted",)) -> DataFrame:
    return nodes.where(F.col("type").isin("domain", "knowledge_group") & review_state().isin(*states))


def layout(nodes: DataFrame, domain_x: float = -12.0, x_start: float = -9.5, width: float = 20.0, row_gap: float = 1.18, columns: int = 8, profile: DataFrame | None = None) -> DataFrame:
    """``id, x, y``: domains in a column, their groups in rows beside them.  A
    ``profile`` (``pos, domain, y, columns``) places domains and says how many
    columns they have; a domain in it without a height comes below the last by
    its place, one that is not in it as without a profile."""
    y, n = F.lit(0.0), F.lit(columns)
    for name, value in DOMAIN_Y.items():
        y = F.when(F.col("domain") == name, F.lit(value)).otherwise(y)
    for name, value in COLUMNS.items():
        n = F.when(F.col("domain") == name, F.lit(value)).otherwise(n)
    if profile is not None:
        own = profile.select("domain", F.coalesce(F.col("y").cast("double"), F.lit(5.2) - F.col("pos") * F.lit(3.2)).alias("_py"), F.nullif(F.col("columns").cast("int"), F.lit(0)).alias("_pn"))
        nodes = nodes.join(own, "domain", "left")
        y, n = F.coalesce("_py", y), F.coalesce("_pn", n)
    place = F.row_number().over(W.partitionBy("domain", "type").orderBy("ord", "id")) - 1
    own = nodes.withColumns({"_i": place, "_n": n, "_y": y})
    x = F.lit(x_start) + F.lit(width) / F.greatest(F.col("_n") - 1, F.lit(1)) * (F.col("_i") % F.col("_n"))
    row = F.floor(F.col("_i") / F.col("_n"))
    return own.select("id", "domain", F.when(F.col("type") == "domain", F.lit(domain_x)).otherwise(x).alias("x"), F.when(F.col("type") == "domain", F.col("_y")).otherwise(F.col("_y") - row * row_gap).alias("y"))


def on_circle(index: Column, total: Column) -> tuple[Column, Column]:
    """Where the node of a number (from 0) stands, if nothing places it: on a
    circle whose radius grows with the root of their number."""
    n = F.greatest(total, F.lit(1)).cast("double")
    angle, radius = F.lit(6.283185307179586) * index / n, F.greatest(F.lit(4.0), F.sqrt(n))
    return F.cos(angle) * radius, F.sin(angle) * radius


def fallback_positions(nodes: DataFrame, store=None) -> DataFrame:
    """``id, x, y`` of all nodes on a circle, in the order of their ids."""
    store = store or _stored(nodes)
    placed = ranked(nodes.select("id"), store, "id")
    total = placed.agg(F.count("*").alias("_total"))
    x, y = on_circle(F.col("rank") - 1, F.col("_total"))
    return placed.join(F.broadcast(total)).select("id", x.alias("x"), y.alias("y"))


def export_edges(edges: DataFrame, nodes: DataFrame, types: tuple[str, ...], states: tuple[str, ...] = ("accepted",)) -> tuple[DataFrame, DataFrame]:
    """(the first edge of each pair of ends, the others, to be warned about)."""
    own = with_both_ends(edges.where(F.col("type").isin(*types) & review_state().isin(*states)), nodes)
    return first_of(own, "source", "target"), repeats(own, "source", "target")


def quality(nodes: DataFrame, edges: DataFrame, n_errors: DataFrame) -> DataFrame:
    """One row: counts, coverage, score and grade.  ``n_errors``: one row with
    ``error_count``."""
    groups = nodes.where("type = 'knowledge_group'")
    semantic = edges.where("type <> 'part_of'")
    touched = degrees(semantic).select("id", F.lit(1).alias("_touched"))
    own = groups.join(touched, "id", "left")
    yes = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")
    has_refs, has_points = F.size(refs()) > 0, F.size(refs("points")) > 0
    related = F.col("_touched").isNotNull() | text(F.col("note")).isNotNull()
    has_summary = text(F.col("summary")).isNotNull()
    g = own.agg(
        F.count("*").alias("groups"),
        yes(has_refs).alias("refs"),
        yes(has_points).alias("points"),
        yes(has_summary).alias("summaries"),
        yes(F.col("n_progression") > 0).alias("progressions"),
        (yes(F.col("n_tasks") > 0) + yes(F.col("n_misconceptions") > 0)).alias("teaching"),
        yes(related).alias("related"),
        yes(~(has_refs & has_points & has_summary & related)).alias("blocked_groups"),
    )
    proven = text(F.col("evidence")).isNotNull() & (F.size(refs()) > 0) & F.col("confidence").isNotNull()
    is_semantic = F.col("type") != "part_of"
    e = edges.agg(F.count("*").alias("edges"), yes(is_semantic).alias("semantic"), yes(is_semantic & proven).alias("proven"), yes(state() == "accepted").alias("_ea"))
    n = nodes.agg(F.count("*").alias("nodes"), yes(F.col("type") == "domain").alias("domains"), yes(state() == "accepted").alias("_na"))
    # four rows of aggregates, one each
    one = g.join(F.broadcast(e)).join(F.broadcast(n)).join(F.broadcast(n_errors.select("error_count")))
    c = F.col
    parts = {
        "source_refs": ratio(c("refs"), c("groups")),
        "points": ratio(c("points"), c("groups")),
        "summary": ratio(c("summaries"), c("groups")),
        "progression": ratio(c("progressions"), c("groups")),
        "teaching": ratio(c("teaching"), F.greatest(c("groups") * 2, F.lit(1))),
        "relations": ratio(c("related"), c("groups")),
        "evidence": ratio(c("proven"), c("semantic")),
        "review": ratio(c("_na") + c("_ea"), c("nodes") + c("edges")),
    }
    raw = F.lit(0.0)
    for k, v in parts.items():
        raw = raw + v * WEIGHTS[k]
    raw = F.round(raw, 2)
    score = F.when(c("error_count") > 0, F.greatest(F.lit(0.0), raw - F.least(F.lit(30), c("error_count") * 5))).otherwise(raw)
    ready = (c("error_count") == 0) & (c("blocked_groups") == 0) & (c("_na") + c("_ea") == c("nodes") + c("edges")) & (c("proven") == c("semantic"))
    density = F.round(c("semantic") / F.greatest(c("groups"), F.lit(1)), 3)
    out = one.select("domains", "groups", "edges", "semantic", "proven", "blocked_groups", "error_count", density.alias("density"), *(F.round(v * WEIGHTS[k], 2).alias(f"part_{k}") for k, v in parts.items()), score.alias("score"), ready.alias("release_ready"))
    return out.withColumn("grade", quality_grade(c("score")))


def definition(subject_title: str = "课程"):
    """The summary, or a sentence made of the name and the domain."""
    made = F.when(F.col("type") == "domain", F.concat("name", F.lit(f"是义务教育{subject_title}课程标准中的学习领域。"))).otherwise(F.concat("name", F.lit("是"), "domain", F.lit("领域下的知识点组。")))
    return F.when(text(F.col("summary")).isNotNull(), first_text(F.col("summary"))).otherwise(made)


def product_nodes(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """Group nodes as product nodes, with coordinates and at most 8 points as skills."""
    points = F.transform(refs("points"), lambda p: first_text(p))
    own = nodes.select("id", first_text(F.col("name"), F.col("id")).alias("name"), "type", "domain", definition().alias("definition"), F.array_join(F.slice(points, 1, 8), ",").alias("skills"))
    return own.join(placed.select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")), "id")


def group_id(domain: Column, theme: Column, name: Column) -> Column:
    """The id of a group that is seeded by domain, theme and name."""
    return F.concat(F.lit("kg:"), domain, F.lit(":"), slug_base(theme), F.lit(":"), slug_base(name))


def _names(nodes: DataFrame) -> DataFrame:
    return nodes.where("type = 'knowledge_group'").groupBy("name").agg(F.count("*").alias("n"), F.min("id").alias("id"))


def repeated_names(nodes: DataFrame) -> DataFrame:
    """``name, n`` of names that several groups have: none of them can stand for a group."""
    return _names(nodes).where("n > 1").select("name", "n")


def named_edges(relations: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, relations left over) of relations between names: ``source_name,
    target_name, type`` and what else they have.  A relation is left over if one
    of its names is of no group or of several."""
    known = _names(nodes).where("n = 1").select("name", "id")
    ends = relations
    for end in ("source", "target"):
        ends = ends.join(known.select(F.col("name").alias(f"{end}_name"), F.col("id").alias(end)), f"{end}_name", "left")
    made = F.concat(F.lit("kgrel:"), "type", F.lit(":"), slug_base(F.col("source_name")), F.lit(":"), slug_base(F.col("target_name")))
    both = F.col("source").isNotNull() & F.col("target").isNotNull()
    return ends.where(both).withColumn("id", made).drop("source_name", "target_name"), ends.where(~both).select(*relations.columns)


#: The bands that a group progresses through, and what is said of each and of its mistakes if nothing else is known.
PROGRESSION = (("1-2年级", "在直观情境中感知{}的基本对象或经验。"), ("3-4年级", "在具体问题中使用{}的表示、方法或规则。"), ("5-6年级", "逐步概括{}中的关系、性质和一般方法。"), ("7-9年级", "用更形式化的语言和模型理解并应用{}。"))
MISTAKES = ("只记结论，忽略适用条件。", "不能在具体情境中选择合适的表示方式。")
DETAIL = {"summary": "string", "core_understanding": "string", "grade_progression": "array<struct<band:string,focus:string>>", "typical_tasks": "array<string>", "misconceptions": "array<string>", "source_refs": "array<string>", "confidence": "double", "review_state": "string", "note": "string"}


def enriched(seeds: DataFrame, domains: DataFrame, source_ref: str, root: str = "数学") -> DataFrame:
    """Seeds (``pos, domain, theme, name, points`` and whatever of ``DETAIL`` they
    have) as full groups: what is not given, or empty, is made of name, theme,
    domain and first point.  A seed of an unknown domain is left out."""
    own = seeds
    for c, kind in DETAIL.items():
        if c not in own.columns:
            own = own.withColumn(c, F.lit(None).cast(kind))
    own = own.join(domains.select("domain", F.col("name").alias("domain_name")), "domain")
    point = F.coalesce(F.get("points", F.lit(0)), F.lit(""))
    given = lambda c, made: F.when(F.size(c) > 0, F.col(c)).otherwise(made)
    words = lambda *x: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in x))
    name = F.col("name")
    bands = F.array(*(F.struct(F.lit(b).alias("band"), words(t.split("{}")[0], name, t.split("{}")[1]).alias("focus")) for b, t in PROGRESSION))
    return own.select(
        group_id(F.col("domain"), F.col("theme"), name).alias("id"),
        F.lit("knowledge_group").alias("type"),
        "name",
        "domain",
        "theme",
        "points",
        F.coalesce(F.nullif(F.col("summary"), F.lit("")), words(name, "组织", F.col("domain_name"), " / ", F.col("theme"), "中的核心概念、方法和表达方式，支撑后续知识点的学习和应用。")).alias("summary"),
        F.coalesce(F.nullif(F.col("core_understanding"), F.lit("")), words("理解", name, "时，需要把", point, "等核心对象与情境、表示和方法联系起来。")).alias("core_understanding"),
        given("grade_progression", bands).alias("grade_progression"),
        given("typical_tasks", F.array(words("解释", point, "的意义或作用。"), words("用", name, "解决熟悉情境中的问题。"))).alias("typical_tasks"),
        given("misconceptions", F.array(*map(F.lit, MISTAKES))).alias("misconceptions"),
        F.array(F.lit(root), F.col("domain_name"), F.col("theme"), name).alias("framework_path"),
        given("source_refs", F.array(F.lit(source_ref))).alias("source_refs"),
        F.coalesce("confidence", F.lit(0.82)).alias("confidence"),
        F.coalesce("review_state", F.lit("accepted")).alias("review_state"),
        F.coalesce("note", F.lit("")).alias("note"),
        "pos",
    )


def seeded(domains: DataFrame, seeds: DataFrame, relations: DataFrame, source_ref: str, root: str = "数学", store=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, relations left over) of a seeded map.  ``domains``:
    ``domain, name, ord``; ``relations``: those of ``named_edges`` with
    ``evidence, source_refs, confidence``.  Groups are numbered in the order of
    ``pos`` over all; domains come at their order times 100."""
    store = store or _stored(seeds)
    groups = ranked(enriched(seeds, domains, source_ref, root), store, "pos", "id").withColumnRenamed("rank", "ord").drop("pos")
    none = {f.name: F.lit(None).cast(f.dataType) for f in groups.schema.fields}
    heads = domains.select("domain", F.col("name"), (F.col("ord") * 100).cast("bigint").alias("ord"))
    fixed = {
        "id": F.concat(F.lit("domain:"), "domain"), "type": F.lit("domain"), "name": F.col("name"), "domain": F.col("domain"), "points": F.array().cast("array<string>"), "summary": F.lit(""), "framework_path": F.array(F.lit(root), F.col("name")),
        "source_refs": F.array(F.lit(source_ref)), "confidence": F.lit(1.0), "review_state": F.lit("accepted"), "note": F.lit(""), "ord": F.col("ord"),
    }
    nodes = heads.select(*(fixed[c].alias(c) if c in fixed else none[c].alias(c) for c in groups.columns)).unionByName(groups)
    refs_ = F.array(F.lit(source_ref))
    belongs = groups.select(F.concat(F.lit("kgrel:part-of:"), slug_base(F.col("name")), F.lit(":"), slug_base(F.col("domain"))).alias("id"), F.lit("part_of").alias("type"), F.col("id").alias("source"), F.concat(F.lit("domain:"), "domain").alias("target"), F.lit("知识点组隶属于对应数学学习领域。").alias("evidence"), refs_.alias("source_refs"), F.lit(1.0).alias("confidence"), F.lit("anchor").alias("visibility"))
    named, rest = named_edges(relations, groups)
    named = named.select("id", "type", "source", "target", "evidence", F.when(F.size("source_refs") > 0, F.col("source_refs")).otherwise(refs_).alias("source_refs"), F.coalesce("confidence", F.lit(0.84)).alias("confidence"), F.lit("featured").alias("visibility"))
    edges = belongs.unionByName(named).withColumn("review_state", F.lit("accepted"))
    return nodes, edges, rest
