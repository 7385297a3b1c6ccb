"""Queries over the curriculum and group views."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import curriculum as C
from graphloom.operators import graph as G
from graphloom.operators import groups as K
from graphloom.operators import ordered as O
from graphloom.operators import rules as R
from graphloom.plans.base import FT, REFS, SLUGB, STATE, TXT, query
from graphloom.plans.graph_queries import _RANGE, WITNESS, _common, _dup, _edge_rules, _ends, _later, _q, _row
from graphloom.sources.tables import cut, work_folder

_PARTS = ("ucs_concepts", "ucs_standards", "ucs_frameworks", "ucs_competencies", "ucs_evidence", "ucs_relations")
_NAMES = ("concepts", "standard_items", "framework_nodes", "competencies", "learning_evidence", "relations")
_OBJECTS = "objs AS (" + " UNION ALL ".join(f"SELECT '{n}' AS collection, pos, id FROM {p}" for p, n in zip(_PARTS, _NAMES)) + ")"


def _parts(v):
    return [getattr(v, p) for p in _PARTS]


@query(f"WITH {_OBJECTS} SELECT * FROM objs")
def set_union_objects(v):
    return C.objects(dict(zip(_NAMES, _parts(v))))


@query(f"WITH {_OBJECTS} SELECT name AS collection, count(o.collection) AS n FROM (VALUES {', '.join(f'({chr(39)}{n}{chr(39)})' for n in (*_NAMES, 'activities', 'alignments'))}) t(name) LEFT JOIN objs o ON o.collection = name GROUP BY 1")
def agg_collection_counts(v):
    names = v.spark.createDataFrame([(n,) for n in (*_NAMES, "activities", "alignments")], "collection string")
    counts = C.objects(dict(zip(_NAMES, _parts(v)))).groupBy("collection").agg(F.count("*").alias("n"))
    return names.join(counts, "collection", "left").select("collection", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"SELECT id, curriculum_id FROM ucs_standards WHERE {TXT('curriculum_id')} IS NOT NULL AND curriculum_id <> 'cur:main' UNION ALL SELECT id, parent_id FROM ucs_frameworks WHERE {TXT('parent_id')} IS NOT NULL AND parent_id NOT IN (SELECT id FROM ucs_frameworks)")
def jn_anti_fk_scalar(v):
    known = v.ucs_frameworks.select(F.col("curriculum_id").alias("id")).distinct()
    a = C.scalar_missing(v.ucs_standards, "curriculum_id", known).select("id", "curriculum_id")
    return a.unionByName(C.scalar_missing(v.ucs_frameworks, "parent_id", v.ucs_frameworks).select("id", F.col("parent_id").alias("curriculum_id")))


@query("SELECT id, ref FROM (SELECT id, unnest(standard_ids) AS ref FROM ucs_concepts) WHERE ref NOT IN (SELECT id FROM ucs_standards)")
def jn_anti_fk_array(v):
    return C.array_missing(v.ucs_concepts, "standard_ids", v.ucs_standards).select("id", "ref")


_RELMISS = f"SELECT id, 'source_id' AS side, source_id AS ref FROM ucs_relations WHERE {TXT('source_id')} IS NOT NULL AND source_id NOT IN (SELECT id FROM objs) UNION ALL SELECT id, 'target_id', target_id FROM ucs_relations WHERE hint IS NULL AND {TXT('target_id')} IS NOT NULL AND target_id NOT IN (SELECT id FROM objs)"


@query(f"WITH {_OBJECTS} {_RELMISS}")
def jn_anti_rel(v):
    return C.relation_missing(v.ucs_relations, C.objects(dict(zip(_NAMES, _parts(v)))))


@query("SELECT id FROM ucs_concepts WHERE id NOT IN (SELECT concept_id FROM ucs_evidence)")
def agg_evidence_per_concept(v):
    return C.without_evidence(v.ucs_concepts, v.ucs_evidence).select("id")


@query(f"WITH {_OBJECTS} " + " UNION ALL ".join([
    "SELECT 'missing_id' AS rule, 'E' AS severity, 'object' AS entity, '' AS id, collection AS detail FROM objs WHERE " + TXT("id") + " IS NULL",
    _dup("object", "objs"),
    "SELECT 'missing_field', 'E', 'concept', id, 'definition' FROM ucs_concepts WHERE coalesce(definition, '') = ''",
    *(f"SELECT 'confidence_range', 'E', 'object', id, CAST(confidence AS VARCHAR) FROM {t} WHERE {_RANGE}" for t in ("ucs_concepts", "ucs_competencies", "ucs_evidence", "ucs_relations")),
    f"SELECT 'curriculum_id', 'E', 'standard', id, curriculum_id FROM ucs_standards WHERE {TXT('curriculum_id')} IS NOT NULL AND curriculum_id <> 'cur:main'",
    f"SELECT 'parent_id', 'E', 'framework', id, parent_id FROM ucs_frameworks WHERE {TXT('parent_id')} IS NOT NULL AND parent_id NOT IN (SELECT id FROM ucs_frameworks)",
    "SELECT 'framework_node_id', 'E', 'standard', id, framework_id FROM ucs_standards WHERE framework_id NOT IN (SELECT id FROM ucs_frameworks)",
    "SELECT 'no_source', 'W', 'standard', id, '' FROM ucs_standards WHERE source IS NULL",
    "SELECT 'source_standard_id', 'E', 'concept', id, ref FROM (SELECT id, unnest(standard_ids) AS ref FROM ucs_concepts) WHERE ref NOT IN (SELECT id FROM ucs_standards)",
    "SELECT 'no_standards', 'W', 'concept', id, '' FROM ucs_concepts WHERE standard_ids IS NULL",
    "SELECT 'concept_id', 'E', 'evidence', id, concept_id FROM ucs_evidence WHERE concept_id NOT IN (SELECT id FROM ucs_concepts)",
    "SELECT 'no_evidence', 'W', 'concept', id, '' FROM ucs_concepts WHERE id NOT IN (SELECT concept_id FROM ucs_evidence)",
    f"SELECT 'relation_end', 'E', 'relation', id, concat(side, ':', ref) FROM ({_RELMISS})",
    f"SELECT 'no_rationale', 'W', 'relation', id, '' FROM ucs_relations WHERE {TXT('rationale')} IS NULL AND coalesce(confidence, 0) < 0.9",
]))
def val_ucs(v):
    return C.validate(*_parts(v), v.ucs_curricula)


# -- export ------------------------------------------------------------------------

_SREFS = "coalesce(array_to_string(list_transform({0}, x -> concat('src:ds#', x)), ','), 'src:ds')"
_CONCEPT = f"SELECT id, 'concept' AS type, {FT('name', 'id')} AS name, {FT('definition')} AS definition, {FT('subject')} AS subject, {FT('stage')} AS stage, {FT('domain')} AS domain, {_SREFS.format('standard_ids')} AS source_refs, coalesce(confidence, 0.82e0) AS confidence FROM ucs_concepts"
_COMPETENCY = f"SELECT id, 'skill' AS type, {FT('name', 'id')} AS name, {FT('description')} AS definition, {FT('subject')} AS subject, '' AS stage, '' AS domain, 'src:ds' AS source_refs, coalesce(confidence, 0.8e0) AS confidence FROM ucs_competencies"
_EVIDENCE = f"SELECT e.id, 'assessment' AS type, {FT('e.statement', 'e.id')} AS name, {FT('e.statement')} AS definition, {FT('e.subject', 'c.subject')} AS subject, {FT('c.stage')} AS stage, {FT('c.domain')} AS domain, CASE WHEN c.id IS NULL THEN concat('src:ds#', e.concept_id) ELSE {_SREFS.format('c.standard_ids')} END AS source_refs, coalesce(e.confidence, 0.75e0) AS confidence FROM ucs_evidence e LEFT JOIN ucs_concepts c ON c.id = e.concept_id"
_NODES = f"nodes AS ({_CONCEPT} UNION ALL {_COMPETENCY} UNION ALL {_EVIDENCE})"


@query(_CONCEPT)
def prj_concept_node(v):
    return C.concept_nodes(v.ucs_concepts, "ds")


@query(_COMPETENCY)
def prj_competency_node(v):
    return C.competency_nodes(v.ucs_competencies, "ds")


@query(_EVIDENCE, "prj_evidence_node")
@query(_EVIDENCE, "jn_left_concept")
def _evidence(v):
    return C.evidence_nodes(v.ucs_evidence, v.ucs_concepts, "ds")


def _nodes(v):
    return R.union(C.concept_nodes(v.ucs_concepts, "ds"), C.competency_nodes(v.ucs_competencies, "ds"), C.evidence_nodes(v.ucs_evidence, v.ucs_concepts, "ds"))


@query(f"WITH {_NODES} SELECT * FROM nodes")
def set_union_nodes(v):
    return _nodes(v)


_MAP = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in C.RELATION_EDGES.items())
_REL = f"""rel AS (SELECT {TXT('id')} AS id, CASE type {_MAP} WHEN 'assessed_by' THEN 'assesses' END AS type, CASE WHEN type = 'assessed_by' THEN target_id ELSE source_id END AS source, CASE WHEN type = 'assessed_by' THEN source_id ELSE target_id END AS target,
 coalesce({TXT('rationale')}, 'Derived from a typed relation.') AS evidence, coalesce(confidence, 0.75e0) AS confidence FROM ucs_relations),
redges AS (SELECT coalesce(id, concat('edge:', type, ':', {SLUGB('source')}, ':', {SLUGB('target')})) AS id, type, source, target, evidence, confidence FROM rel WHERE type IS NOT NULL AND source <> target AND source IN (SELECT id FROM nodes) AND target IN (SELECT id FROM nodes)),
eedges AS (SELECT concat('edge:assesses:', {SLUGB('id')}, ':', {SLUGB('concept_id')}) AS id, 'assesses' AS type, id AS source, concept_id AS target, {FT('statement')} AS evidence, 0.8e0 AS confidence FROM ucs_evidence WHERE concept_id IN (SELECT id FROM nodes) AND id IN (SELECT id FROM nodes))"""


@query(f"WITH {_NODES}, {_REL} SELECT * FROM redges")
def prj_relation_edge(v):
    return C.relation_edges(v.ucs_relations, _nodes(v), "ds")


@query(f"WITH {_NODES}, {_REL} SELECT * FROM eedges")
def prj_evidence_edge(v):
    return C.evidence_edges(v.ucs_evidence, _nodes(v))


@query(f"WITH {_NODES}, {_REL} SELECT * FROM redges UNION ALL SELECT * FROM eedges")
def set_union_edges(v):
    nodes = _nodes(v)
    return C.relation_edges(v.ucs_relations, nodes, "ds").unionByName(C.evidence_edges(v.ucs_evidence, nodes))


@query(f"WITH {_NODES}, {_REL} SELECT 'node' AS kind, type, count(*) AS n, round(sum(confidence), 3) AS total FROM nodes GROUP BY 2 UNION ALL SELECT 'edge', type, count(*), round(sum(confidence), 3) FROM (SELECT type, confidence FROM redges UNION ALL SELECT type, confidence FROM eedges) GROUP BY 2")
def prj_build_kg(v):
    nodes = _nodes(v)
    edges = C.relation_edges(v.ucs_relations, nodes, "ds").unionByName(C.evidence_edges(v.ucs_evidence, nodes))
    count = lambda df, kind: df.groupBy("type").agg(F.count("*").alias("n"), F.round(F.sum("confidence"), 3).alias("total")).select(F.lit(kind).alias("kind"), "type", "n", "total")
    return count(nodes, "node").unionByName(count(edges, "edge"))


@query(f"""WITH allc AS (SELECT 0 AS rank, pos, {TXT('id')} AS id, {FT('id')} AS locator, {FT('statement')} AS text FROM ucs_standards
UNION ALL SELECT 1, pos, {TXT('id')}, {FT('name', 'id')}, {FT('definition', 'name')} FROM ucs_concepts
UNION ALL SELECT 2, pos, {TXT('id')}, {FT('name', 'id')}, {FT('description', 'name')} FROM ucs_competencies
UNION ALL SELECT 3, pos, {TXT('id')}, {FT('concept_id', 'id')}, {FT('statement')} FROM ucs_evidence
UNION ALL SELECT 4, pos, {TXT('id')}, {FT('type', 'id')}, {FT('rationale', "concat(source_id, ' -> ', target_id)")} FROM ucs_relations)
SELECT id, locator, text FROM (SELECT * FROM allc WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank, pos) = 1) ORDER BY rank, pos LIMIT 5000""")
def win_first_wins_chunk(v):
    return C.source_chunks(v.ucs_standards, v.ucs_concepts, v.ucs_competencies, v.ucs_evidence, v.ucs_relations)


@query("SELECT a.id AS source, 'progresses_to' AS type, b.id AS target FROM topics a JOIN topics b ON a.domain = b.domain AND a.theme = b.theme AND a.stage_order + 1 = b.stage_order".replace("topics", "(SELECT DISTINCT concat(domain, '/', subject, '/', stage) AS id, domain, subject AS theme, CAST(substr(stage, 6, 1) AS BIGINT) AS stage_order FROM ucs_concepts)"))
def jn_stage_succession(v):
    topics = v.ucs_concepts.select(F.concat_ws("/", "domain", "subject", "stage").alias("id"), "domain", F.col("subject").alias("theme"), F.substring("stage", 6, 1).cast("bigint").alias("stage_order")).distinct()
    return C.stage_succession(topics)


@query("SELECT DISTINCT domain, subject AS theme FROM ucs_concepts")
def agg_set_distinct(v):
    return v.ucs_concepts.select("domain", F.col("subject").alias("theme")).distinct()


@query("SELECT stage, domain, subject AS theme, arg_min(id, pos) AS first_id, count(*) AS n FROM ucs_concepts GROUP BY 1, 2, 3")
def agg_standards_by_topic(v):
    return v.ucs_concepts.groupBy("stage", "domain", F.col("subject").alias("theme")).agg(F.min_by("id", "pos").alias("first_id"), F.count("*").alias("n"))


@query("SELECT stage, domain, subject, id FROM ucs_concepts ORDER BY stage, domain, subject, id")
def srt_contexts(v):
    return v.ucs_concepts.select("stage", "domain", "subject", "id").orderBy("stage", "domain", "subject", "id")


@query("SELECT id, name FROM ucs_concepts ORDER BY id")
def srt_by_id(v):
    return v.ucs_concepts.select("id", "name").orderBy("id")


@query(f"""WITH RECURSIVE base AS (SELECT id, {TXT('parent_id')} AS parent FROM ucs_frameworks),
walk(id, root, parent, depth, path) AS (SELECT id, id, parent, 0, id FROM base UNION ALL SELECT w.id, b.id, b.parent, w.depth + 1, concat(b.id, '/', w.path) FROM walk w JOIN base b ON b.id = w.parent WHERE w.depth < 60 AND w.parent <> w.id)
SELECT id, root, CAST(depth AS BIGINT) AS depth, path FROM walk WHERE parent IS NULL OR parent NOT IN (SELECT id FROM base)""")
def gr_hierarchy(v):
    return G.ancestors(v.ucs_frameworks)


# -- groups ------------------------------------------------------------------------

_ACC = f"{STATE} IN ('accepted')"
_GN = f"gn AS (SELECT * FROM group_nodes WHERE {_ACC} AND type IN ('domain', 'knowledge_group'))"
_GE = f"ge AS (SELECT * FROM group_edges WHERE type IN ({_q(R.GROUP_EDGE_TYPES)}) AND {_ACC} AND source IN (SELECT id FROM gn) AND target IN (SELECT id FROM gn))"
_LAY = """placed AS (SELECT id, type, domain, CASE WHEN type = 'domain' THEN -12.0e0 ELSE -9.5e0 + 20.0e0 / 7 * (i % 8) END AS x, CASE WHEN type = 'domain' THEN 0e0 ELSE 0e0 - floor(i / 8) * 1.18e0 END AS y
 FROM (SELECT *, row_number() OVER (PARTITION BY domain, type ORDER BY ord, id) - 1 AS i FROM gn))"""


@query(f"WITH {_GN} SELECT id, type FROM gn")
def flt_groups(v):
    return K.chosen_nodes(v.group_nodes).select("id", "type")


@query(f"WITH {_GN}, {_LAY} SELECT id, domain, round(x, 6) AS x, round(y, 6) AS y FROM placed")
def win_domain_layout(v):
    return K.layout(K.chosen_nodes(v.group_nodes)).select("id", "domain", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"""WITH {_GN}, {_LAY} SELECT n.id, {FT('n.name', 'n.id')} AS name, n.type, n.domain, CASE WHEN {TXT('n.summary')} IS NOT NULL THEN {FT('n.summary')} WHEN n.type = 'domain' THEN concat(n.name, '是义务教育课程课程标准中的学习领域。') ELSE concat(n.name, '是', n.domain, '领域下的知识点组。') END AS definition,
 array_to_string(list_transform({REFS('n.points')}, p -> {FT('p')})[1:8], ',') AS skills, round(x, 6) AS x, round(y, 6) AS y FROM gn n JOIN placed p ON p.id = n.id""")
def prj_group_product(v):
    nodes = K.chosen_nodes(v.group_nodes)
    return K.product_nodes(nodes, K.layout(nodes))


@query(f"WITH {_GN}, {_GE} SELECT kind, source, target, type, pos FROM (SELECT CASE WHEN row_number() OVER (PARTITION BY source, target ORDER BY pos) = 1 THEN 'kept' ELSE 'warned' END AS kind, source, target, type, pos FROM ge)")
def win_first_wins_pair(v):
    kept, others = K.export_edges(v.group_edges, K.chosen_nodes(v.group_nodes), R.GROUP_EDGE_TYPES)
    pick = lambda df, kind: df.select(F.lit(kind).alias("kind"), "source", "target", "type", "pos")
    return pick(kept, "kept").unionByName(pick(others, "warned"))


@query(f"WITH {_GN}, {_GE}, k AS (SELECT * FROM ge QUALIFY row_number() OVER (PARTITION BY source, target ORDER BY pos) = 1) SELECT (SELECT count(*) FROM gn) AS total_nodes, (SELECT count(*) FROM k) AS total_edges, (SELECT count(*) FROM k WHERE type <> 'part_of') AS semantic_edges")
def agg_group_stats(v):
    nodes = K.chosen_nodes(v.group_nodes)
    kept, _ = K.export_edges(v.group_edges, nodes, R.GROUP_EDGE_TYPES)
    counts = nodes.select(F.lit("n").alias("k")).unionByName(kept.select(F.when(F.col("type") == "part_of", "p").otherwise("s").alias("k")))
    n = lambda *k: F.coalesce(F.sum(F.when(F.col("k").isin(*k), 1)), F.lit(0)).cast("bigint")
    return counts.agg(n("n").alias("total_nodes"), n("p", "s").alias("total_edges"), n("s").alias("semantic_edges"))


@query(f"WITH {_GN} SELECT id, type, domain, rank FROM (SELECT id, type, domain, row_number() OVER (ORDER BY CASE type WHEN 'domain' THEN 0 ELSE 1 END, domain, id) AS rank FROM gn)")
def srt_groups(v):
    folder = work_folder(v.spark)
    rows = K.chosen_nodes(v.group_nodes).select("id", "type", "domain", F.when(F.col("type") == "domain", 0).otherwise(1).alias("k"))
    return O.ranked(rows, lambda t, name: cut(t, name, folder), "k", "domain", "id").drop("k")


_TOUCH = "id NOT IN (SELECT source FROM group_edges WHERE type <> 'part_of' UNION SELECT target FROM group_edges WHERE type <> 'part_of')"


@query(f"SELECT id FROM group_nodes WHERE type = 'knowledge_group' AND {TXT('note')} IS NULL AND {_TOUCH}")
def jn_semantic_touch(v):
    return R.untouched_groups(v.group_nodes, v.group_edges).select("id")


_VAL_GROUPS = " UNION ALL ".join([
    _row("invalid_type", "E", "node", "type NOT IN ('domain', 'knowledge_group')", "group_nodes", "type"),
    _row("missing_name", "E", "node", f"{TXT('name')} IS NULL", "group_nodes"),
    _row("missing_domain", "E", "node", f"{TXT('domain')} IS NULL", "group_nodes"),
    _row("missing_refs", "E", "node", f"len({REFS()}) = 0", "group_nodes"),
    _row("missing_points", "E", "node", f"type = 'knowledge_group' AND len({REFS('points')}) = 0", "group_nodes"),
    _row("sparse_detail", "W", "node", f"type = 'knowledge_group' AND {TXT('summary')} IS NULL", "group_nodes"),
    *_common("node", "group_nodes"),
    _later("node", "group_nodes", "ord"),
    *_edge_rules("group_edges", R.GROUP_EDGE_TYPES, reason=False),
    *_ends("group_edges", "group_nodes"),
    f"SELECT 'no_semantic_edge', 'E', 'node', id, '' FROM group_nodes WHERE type = 'knowledge_group' AND {TXT('note')} IS NULL AND {_TOUCH}",
    f"SELECT 'requires_cycle', 'E', 'graph', '', concat(string_agg(id, ' -> ' ORDER BY k), ' -> ', arg_min(id, k)) FROM ({WITNESS('group_edges')} SELECT k, id FROM ring WHERE id IS NOT NULL) HAVING count(*) > 0",
])


def _val_groups(v):
    return R.validate_groups(v.group_nodes, v.group_edges, G.requires_cycle(v.group_edges))


@query(_VAL_GROUPS)
def val_groups(v):
    return _val_groups(v)


@query(f"""WITH sem AS (SELECT source AS id FROM group_edges WHERE type <> 'part_of' UNION SELECT target FROM group_edges WHERE type <> 'part_of'),
g AS (SELECT *, len({REFS()}) > 0 AS r, len({REFS('points')}) > 0 AS p, {TXT('summary')} IS NOT NULL AS s, (id IN (SELECT id FROM sem) OR {TXT('note')} IS NOT NULL) AS rel FROM group_nodes WHERE type = 'knowledge_group'),
t AS (SELECT count(*) AS groups, count(*) FILTER (r) AS refs, count(*) FILTER (p) AS points, count(*) FILTER (s) AS sums, count(*) FILTER (n_progression > 0) AS prog, count(*) FILTER (n_tasks > 0) + count(*) FILTER (n_misconceptions > 0) AS teach, count(*) FILTER (rel) AS rel, count(*) FILTER (NOT (r AND p AND s AND rel)) AS blocked_groups FROM g),
e AS (SELECT count(*) AS edges, count(*) FILTER (type <> 'part_of') AS semantic, count(*) FILTER (type <> 'part_of' AND {TXT('evidence')} IS NOT NULL AND len({REFS()}) > 0 AND confidence IS NOT NULL) AS proven, count(*) FILTER ({STATE} = 'accepted') AS ea FROM group_edges),
n AS (SELECT count(*) AS nodes, count(*) FILTER (type = 'domain') AS domains, count(*) FILTER ({STATE} = 'accepted') AS na FROM group_nodes),
er AS (SELECT count(*) FILTER (severity = 'E') AS error_count FROM ({_VAL_GROUPS})),
x AS (SELECT *, refs / groups * 15e0 AS a1, points / groups * 20e0 AS a2, sums / groups * 15e0 AS a3, prog / groups * 10e0 AS a4, teach / (groups * 2) * 10e0 AS a5, rel / groups * 15e0 AS a6, proven / semantic * 10e0 AS a7, (na + ea) / (nodes + edges) * 5e0 AS a8 FROM t, e, n, er),
y AS (SELECT *, round(a1 + a2 + a3 + a4 + a5 + a6 + a7 + a8, 2) AS raw FROM x),
z AS (SELECT *, CASE WHEN error_count > 0 THEN greatest(0, raw - least(30, error_count * 5)) ELSE raw END AS score FROM y)
SELECT domains, groups, edges, semantic, proven, blocked_groups, error_count, round(semantic / groups, 3) AS density, round(a1, 2) AS part_source_refs, round(a2, 2) AS part_points, round(a3, 2) AS part_summary, round(a4, 2) AS part_progression, round(a5, 2) AS part_teaching, round(a6, 2) AS part_relations, round(a7, 2) AS part_evidence, round(a8, 2) AS part_review,
 score, error_count = 0 AND blocked_groups = 0 AND na + ea = nodes + edges AND proven = semantic AS release_ready, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade FROM z""")
def agg_quality(v):
    return K.quality(v.group_nodes, v.group_edges, R.summary(_val_groups(v)))


@query(f"SELECT id, concat('kg:', domain, ':', {SLUGB('summary')}, ':', {SLUGB('name')}) AS group_id FROM group_nodes WHERE type = 'knowledge_group'")
def fn_group_id(v):
    return v.group_nodes.where("type = 'knowledge_group'").select("id", K.group_id(F.col("domain"), F.col("summary"), F.col("name")).alias("group_id"))


@query("SELECT name, count(*) AS n FROM group_nodes WHERE type = 'knowledge_group' GROUP BY 1 HAVING count(*) > 1")
def gr_seed_unique(v):
    return K.repeated_names(v.group_nodes)


_TITLE = "CASE WHEN @.p_size % 4 = 0 THEN @.p_name ELSE concat(@.p_name, ' ', @.p_partkey) END"


@query(f"""WITH titled AS (SELECT concat('group:', p_partkey) AS id, {_TITLE.replace('@', 'part')} AS name FROM part),
named AS (SELECT name, min(id) AS id FROM titled GROUP BY 1 HAVING count(*) = 1),
rel AS (SELECT l_orderkey AS k, l_linenumber AS line, CASE l_linenumber % 2 WHEN 0 THEN 'requires' ELSE 'extends' END AS type, {_TITLE.replace('@', 'a')} AS source_name, CASE WHEN l_orderkey % 9 = 0 THEN 'no such group' ELSE {_TITLE.replace('@', 'b')} END AS target_name FROM lineitem JOIN part a ON l_partkey = a.p_partkey JOIN part b ON l_suppkey = b.p_partkey)
SELECT k, line, type, s.id AS source, t.id AS target, concat('kgrel:', type, ':', {SLUGB('source_name')}, ':', {SLUGB('target_name')}) AS id FROM rel JOIN named s ON s.name = source_name JOIN named t ON t.name = target_name
UNION ALL SELECT k, line, type, NULL, NULL, NULL FROM rel WHERE source_name NOT IN (SELECT name FROM named) OR target_name NOT IN (SELECT name FROM named)""")
def jn_name_to_id(v):
    # three in four groups have a name of their own
    title = lambda size, name, key: F.when(size % 4 == 0, name).otherwise(F.concat_ws(" ", name, key))
    nodes = v.group_nodes.where("type = 'knowledge_group'").withColumn("name", title(F.col("ord"), F.col("name"), F.substring("id", 7, 99)))
    parts = v.part.select("p_partkey", title(F.col("p_size"), F.col("p_name"), F.col("p_partkey")).alias("title"))
    rel = v.lineitem.join(parts.toDF("l_partkey", "source_name"), "l_partkey").join(parts.toDF("l_suppkey", "there"), "l_suppkey")
    target = F.when(F.col("l_orderkey") % 9 == 0, F.lit("no such group")).otherwise(F.col("there"))
    kind = F.when(F.col("l_linenumber") % 2 == 0, F.lit("requires")).otherwise(F.lit("extends"))
    edges, rest = K.named_edges(rel.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), kind.alias("type"), "source_name", target.alias("target_name")), nodes)
    none = F.lit(None).cast("string")
    return edges.select("k", "line", "type", "source", "target", "id").unionByName(rest.select("k", "line", "type", none.alias("source"), none.alias("target"), none.alias("id")))
