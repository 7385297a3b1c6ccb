"""Curriculum datasets: their rules, and their export as graph nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import first_text, mapped, slug_base, text
from graphloom.operators.graph import first_of
from graphloom.operators.rules import missing, union, violations

#: Graph types of the relations of a dataset.
RELATION_EDGES = {"part_of": "part_of", "prerequisite_for": "requires", "requires": "requires", "progresses_to": "extends", "extends": "extends", "applies_to": "applies_to", "supports_competency": "applies_to", "represented_by": "related_to", "contrasts_with": "confuses_with", "example_of": "related_to"}
MOST_CHUNKS = 5000


def objects(collections: dict[str, DataFrame]) -> DataFrame:
    """``collection, pos, id`` of all objects."""
    place = lambda df: F.col("pos") if "pos" in df.columns else F.lit(None).cast("bigint").alias("pos")
    frames = [df.select(F.lit(name).alias("collection"), place(df), "id") for name, df in collections.items()]
    return union(*frames)


def duplicate_ids(all_objects: DataFrame) -> DataFrame:
    return all_objects.where(F.coalesce("id", F.lit("")) != "").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def scalar_missing(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """Rows with text in ``column`` that is not an id of ``known``."""
    return missing(df.where(text(F.col(column)).isNotNull()), column, known)


def array_missing(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """``id, ref`` for each entry of ``column`` that is not an id of ``known``."""
    return missing(df.select("id", F.explode(column).alias("ref")), "ref", known)


def relation_missing(relations: DataFrame, all_objects: DataFrame) -> DataFrame:
    """``id, side, ref`` of ends that do not exist; a hint excuses the target."""
    source = scalar_missing(relations, "source_id", all_objects).select("id", F.lit("source_id").alias("side"), F.col("source_id").alias("ref"))
    target = scalar_missing(relations.where("hint is null"), "target_id", all_objects).select("id", F.lit("target_id").alias("side"), F.col("target_id").alias("ref"))
    return source.unionByName(target)


def without_evidence(concepts: DataFrame, evidence: DataFrame) -> DataFrame:
    return concepts.join(evidence.select(F.col("concept_id").alias("id")).distinct(), "id", "left_anti")


def validate(concepts: DataFrame, standards: DataFrame, frameworks: DataFrame, competencies: DataFrame, evidence: DataFrame, relations: DataFrame, curricula: DataFrame, tasks: DataFrame | None = None, alignments: DataFrame | None = None) -> DataFrame:
    """All rules of a curriculum dataset; every id that is named must be in its
    table.  ``tasks``: activities and assessments, with ``concept_ids`` and
    ``competency_ids``; ``alignments`` are relations to other frameworks."""
    more = {name: df for name, df in (("tasks", tasks), ("alignments", alignments)) if df is not None}
    everything = objects({"concepts": concepts, "standard_items": standards, "framework_nodes": frameworks, "competencies": competencies, "learning_evidence": evidence, "relations": relations} | more)
    further = [violations(scalar_missing(frameworks, "curriculum_id", curricula), "curriculum_id", "E", "framework", F.col("id"), F.col("curriculum_id"))]
    if "framework_node_ids" in standards.columns:
        further.append(violations(array_missing(standards, "framework_node_ids", frameworks), "framework_node_id", "E", "standard", F.col("id"), F.col("ref")))
    if tasks is not None:
        for column, known in (("concept_ids", concepts), ("competency_ids", competencies)):
            further.append(violations(array_missing(tasks, column, known), column[:-1], "E", "task", F.col("id"), F.col("ref")))
    if alignments is not None:
        further.append(violations(relation_missing(alignments, everything), "relation_end", "E", "alignment", F.col("id"), F.concat_ws(":", "side", "ref")))
        further.append(violations(alignments.where(text(F.col("rationale")).isNull()), "no_rationale", "W", "alignment", F.col("id")))
    conf = F.col("confidence")
    ranged = [df.where((conf < 0) | (conf > 1) | F.isnan(conf)).select("id", conf) for df in (concepts, competencies, evidence, relations)]
    unsaid = text(F.col("rationale")).isNull() & (F.coalesce(conf, F.lit(0.0)) < 0.9)
    return union(
        violations(everything.where(text(F.col("id")).isNull()), "missing_id", "E", "object", F.lit(""), F.col("collection")),
        violations(duplicate_ids(everything), "duplicate_id", "E", "object", F.col("id")),
        violations(concepts.where(F.coalesce("definition", F.lit("")) == ""), "missing_field", "E", "concept", F.col("id"), F.lit("definition")),
        violations(union(*ranged), "confidence_range", "E", "object", F.col("id"), conf),
        violations(scalar_missing(standards, "curriculum_id", curricula), "curriculum_id", "E", "standard", F.col("id"), F.col("curriculum_id")),
        violations(scalar_missing(frameworks, "parent_id", frameworks), "parent_id", "E", "framework", F.col("id"), F.col("parent_id")),
        violations(missing(standards, "framework_id", frameworks), "framework_node_id", "E", "standard", F.col("id"), F.col("framework_id")),
        violations(standards.where("source is null"), "no_source", "W", "standard", F.col("id")),
        violations(array_missing(concepts, "standard_ids", standards), "source_standard_id", "E", "concept", F.col("id"), F.col("ref")),
        violations(concepts.where("standard_ids is null"), "no_standards", "W", "concept", F.col("id")),
        violations(missing(evidence, "concept_id", concepts), "concept_id", "E", "evidence", F.col("id"), F.col("concept_id")),
        violations(without_evidence(concepts, evidence), "no_evidence", "W", "concept", F.col("id")),
        violations(relation_missing(relations, everything), "relation_end", "E", "relation", F.col("id"), F.concat_ws(":", "side", "ref")),
        violations(relations.where(unsaid), "no_rationale", "W", "relation", F.col("id")),
        *further,
    )


def validate_built(made: dict[str, DataFrame]) -> DataFrame:
    """The rules over the frames of a build."""
    relations = made["relations"].withColumn("hint", F.lit(None).cast("string"))
    return validate(*(made[x] for x in ("concepts", "standard_items", "framework_nodes", "competencies", "learning_evidence")), relations, made["curricula"])


def standard_refs(dataset: str, ids: Column) -> Column:
    """References to standards, or to the dataset if there are none."""
    return F.coalesce(F.array_join(F.transform(ids, lambda x: F.concat(F.lit(f"src:{dataset}#"), x)), ","), F.lit(f"src:{dataset}"))


def concept_nodes(concepts: DataFrame, dataset: str) -> DataFrame:
    return concepts.select("id", F.lit("concept").alias("type"), first_text(F.col("name"), F.col("id")).alias("name"), first_text(F.col("definition")).alias("definition"), first_text(F.col("subject")).alias("subject"), first_text(F.col("stage")).alias("stage"), first_text(F.col("domain")).alias("domain"), standard_refs(dataset, F.col("standard_ids")).alias("source_refs"), F.coalesce("confidence", F.lit(0.82)).alias("confidence"))


def competency_nodes(competencies: DataFrame, dataset: str) -> DataFrame:
    return competencies.select("id", F.lit("skill").alias("type"), first_text(F.col("name"), F.col("id")).alias("name"), first_text(F.col("description")).alias("definition"), first_text(F.col("subject")).alias("subject"), F.lit("").alias("stage"), F.lit("").alias("domain"), F.lit(f"src:{dataset}").alias("source_refs"), F.coalesce("confidence", F.lit(0.8)).alias("confidence"))


def evidence_nodes(evidence: DataFrame, concepts: DataFrame, dataset: str) -> DataFrame:
    """Evidence takes what it lacks from its concept."""
    c = first_of(concepts, "id").select(F.col("id").alias("concept_id"), *(F.col(x).alias(f"_{x}") for x in ("subject", "stage", "domain", "standard_ids")), F.lit(True).alias("_found"))
    both = evidence.join(c, "concept_id", "left")
    own = F.when(F.col("_found"), standard_refs(dataset, F.col("_standard_ids"))).otherwise(F.concat(F.lit(f"src:{dataset}#"), F.col("concept_id")))
    return both.select("id", F.lit("assessment").alias("type"), first_text(F.col("statement"), F.col("id")).alias("name"), first_text(F.col("statement")).alias("definition"), first_text(F.col("subject"), F.col("_subject")).alias("subject"), first_text(F.col("_stage")).alias("stage"), first_text(F.col("_domain")).alias("domain"), own.alias("source_refs"), F.coalesce("confidence", F.lit(0.75)).alias("confidence"))


def relation_edges(relations: DataFrame, exported: DataFrame, dataset: str) -> DataFrame:
    """Mapped relations between exported nodes; ``assessed_by`` is turned round."""
    turned = F.col("type") == "assessed_by"
    kind = F.when(turned, "assesses").otherwise(mapped(F.col("type"), RELATION_EDGES))
    own = relations.select(text(F.col("id")).alias("id"), kind.alias("type"), F.when(turned, F.col("target_id")).otherwise(F.col("source_id")).alias("source"), F.when(turned, F.col("source_id")).otherwise(F.col("target_id")).alias("target"), first_text(F.col("rationale"), F.lit("Derived from a typed relation.")).alias("evidence"), F.coalesce("confidence", F.lit(0.75)).alias("confidence"))
    ids = exported.select("id").distinct()
    own = own.where("type is not null and source <> target").join(ids.toDF("source"), "source", "left_semi").join(ids.toDF("target"), "target", "left_semi")
    made = F.concat(F.lit("edge:"), F.col("type"), F.lit(":"), slug_base(F.col("source")), F.lit(":"), slug_base(F.col("target")))
    return own.select(F.coalesce("id", made).alias("id"), "type", "source", "target", "evidence", "confidence")


def evidence_edges(evidence: DataFrame, exported: DataFrame) -> DataFrame:
    ids = exported.select("id").distinct()
    own = evidence.join(ids, "id", "left_semi").join(ids.toDF("concept_id"), "concept_id", "left_semi")
    made = F.concat(F.lit("edge:assesses:"), slug_base(F.col("id")), F.lit(":"), slug_base(F.col("concept_id")))
    return own.select(made.alias("id"), F.lit("assesses").alias("type"), F.col("id").alias("source"), F.col("concept_id").alias("target"), first_text(F.col("statement")).alias("evidence"), F.lit(0.8).alias("confidence"))


def source_chunks(standards: DataFrame, concepts: DataFrame, competencies: DataFrame, evidence: DataFrame, relations: DataFrame, most: int = MOST_CHUNKS) -> DataFrame:
    """``id, locator, text`` of the first object of each id over the collections
    in this order, and of those the first ``most``."""

    def one(rank: int, df: DataFrame, locator: Column, value: Column) -> DataFrame:
        return df.select(F.lit(rank).alias("rank"), "pos", text(F.col("id")).alias("id"), locator.alias("locator"), value.alias("text"))

    arrow = F.concat(F.coalesce("source_id", F.lit("")), F.lit(" -> "), F.coalesce("target_id", F.lit("")))
    everything = union(
        one(0, standards, first_text(F.col("id")), first_text(F.col("statement"))),
        one(1, concepts, first_text(F.col("name"), F.col("id")), first_text(F.col("definition"), F.col("name"))),
        one(2, competencies, first_text(F.col("name"), F.col("id")), first_text(F.col("description"), F.col("name"))),
        one(3, evidence, first_text(F.col("concept_id"), F.col("id")), first_text(F.col("statement"))),
        one(4, relations, first_text(F.col("type"), F.col("id")), first_text(F.col("rationale"), arrow)),
    ).where("id is not null").withColumn("at", F.struct("rank", "pos"))
    return first_of(everything, "id", order="at").orderBy("rank", "pos").limit(most).select("id", "locator", "text")


def stage_succession(topics: DataFrame) -> DataFrame:
    """Topics of ``domain, theme, stage_order, id`` joined to those one stage on."""
    a, b = topics.alias("a"), topics.alias("b")
    on = (F.col("a.domain") == F.col("b.domain")) & (F.col("a.theme") == F.col("b.theme")) & (F.col("a.stage_order") + 1 == F.col("b.stage_order"))
    return a.join(b, on).select(F.col("a.id").alias("source"), F.lit("progresses_to").alias("type"), F.col("b.id").alias("target"))


#: What a keyword of a statement says about its processes and dimensions, and what its section adds.
PROCESSES = (("认识", "recognize"), ("理解", "understand"), ("探索", "explore"), ("掌握", "master"), ("会", "apply"), ("解决", "solve"), ("解释", "explain"), ("描述", "describe"), ("比较", "compare"), ("估算", "estimate"), ("推理", "reason"))
DIMENSIONS = (("意义", "conceptual"), ("算法", "procedural"), ("方法", "procedural"), ("解决", "application"), ("情境", "application"), ("活动", "practice"), ("数据", "data"), ("图形", "spatial"))
SECTION_DIMENSIONS = {"academic_requirement": "evidence", "teaching_hint": "teaching"}


def infer_dimensions(statement: Column, section: Column) -> tuple[Column, Column]:
    """Distinct processes and dimensions, in the order of the keywords; one default each."""

    def named(table, default: str, *more: Column) -> Column:
        found = [F.when(statement.contains(word), F.lit(label)) for word, label in table]
        own = F.array_distinct(F.filter(F.array(*found, *more), lambda x: x.isNotNull()))
        return F.when(F.size(own) > 0, own).otherwise(F.array(F.lit(default)))

    added = [F.when(section == name, F.lit(label)) for name, label in SECTION_DIMENSIONS.items()]
    return named(PROCESSES, "understand"), named(DIMENSIONS, "conceptual", *added)
