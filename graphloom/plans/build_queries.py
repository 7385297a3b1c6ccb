"""Queries over whole builds: curricula from lines, with one entry for each frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import builder as B
from graphloom.functions import text as T
from graphloom.operators import curriculum as C
from graphloom.operators import groups as K
from graphloom.operators import ordered as O
from graphloom.operators import qij, trees
from graphloom.operators import repository as P
from graphloom.operators.publish import GraphStore
from graphloom.plans.base import EDGE_ID, SLUGB, STATE, query
from graphloom.operators.graph import _stored
from graphloom.plans.text_queries import _BLOCKS, _CLEANED, _CUT, _NOISE, _fixed

from graphloom.sources import documents as D
from graphloom.sources.tables import work_folder


def _case(x: str, table: dict, i: int | None = None) -> str:
    value = lambda v: v if i is None else v[i]
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {repr(value(v))}" for k, v in table.items()) + " END"


def _first(tests: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {a} THEN '{b}'" for a, b in tests) + " END"


_HEAD = r"regexp_replace(regexp_replace(replace(regexp_replace(line, '^[0-9一二三四五六七八九十]+[.、][\s\p{Z}]*', ''), ' ', ''), '^[\s\p{Z}]+', ''), '[\s\p{Z}]+$', '')"
_D = _first([(f"contains(line, '{d}') AND (starts_with(line, '(') OR starts_with(line, '一') OR length(line) <= 18)", d) for d in B.DOMAINS])
_ST = _first([(f"contains(line, '{s}')", s) for s in B.STAGES])
_SE = _first([(f"contains(line, '{v[0]}')", k) for k, v in B.SECTIONS.items()])
_TH = f"CASE WHEN {_HEAD} IN ({', '.join(map(repr, B.THEMES))}) THEN {_HEAD} WHEN domain = '{B.PRACTICE}' THEN {_first([(f'contains({_HEAD}, {t!r})', t) for t in B.PRACTICE_THEMES])} END"
_NAME = "regexp_replace(regexp_replace(statement, '[。；;].*$', '', 's'), '^[，,、:： ]+|[，,、:： ]+$', '', 'g')"
_KEY = "doc, stage, domain, theme"
_PAGE = "CASE WHEN pages[1] = pages[-1] THEN 'PDF page ' || pages[1] ELSE 'PDF pages ' || pages[1] || '-' || pages[-1] END"


def _labels(words: list[tuple[str, str]], default: str, more: str = "") -> str:
    known = dict.fromkeys(label for _, label in words)
    each = ", ".join(f"CASE WHEN {' OR '.join(f'contains(statement, {w!r})' for w, v in words if v == label)} THEN '{label}' END" for label in known)
    return f"coalesce(nullif(concat_ws(',', {each}{more}), ''), '{default}')"


_DIMENSIONS = _labels(list(C.DIMENSIONS), "conceptual", ", CASE section WHEN 'academic_requirement' THEN 'evidence' WHEN 'teaching_hint' THEN 'teaching' END")
_BUILD = f"""WITH cl AS (SELECT doc, page, pos, {_fixed('line')} AS line FROM curriculum_lines),
l0 AS (SELECT *, {_D} AS d, {_ST} AS st0, {_SE} AS se0 FROM cl WHERE NOT {_NOISE}),
l1 AS (SELECT *, CASE WHEN d IS NULL THEN st0 END AS st, CASE WHEN d IS NULL AND st0 IS NULL THEN se0 END AS se FROM l0),
l2 AS (SELECT *, last_value(st IGNORE NULLS) OVER w AS stage, last_value(d IGNORE NULLS) OVER w AS domain, sum(CASE WHEN d IS NOT NULL OR st IS NOT NULL THEN 1 ELSE 0 END) OVER w AS reset FROM l1 WINDOW w AS (PARTITION BY doc ORDER BY pos)),
l3 AS (SELECT *, CASE WHEN d IS NULL AND st IS NULL AND se IS NULL THEN {_TH} END AS th FROM l2),
l4 AS (SELECT *, last_value(se IGNORE NULLS) OVER w AS section, last_value(th IGNORE NULLS) OVER w AS theme0 FROM l3 WINDOW w AS (PARTITION BY doc, reset ORDER BY pos)),
ctx AS (SELECT doc, page, pos, line, stage, domain, coalesce(theme0, CASE WHEN domain = '{B.PRACTICE}' THEN '{B.PRACTICE_THEMES[-1]}' END) AS theme, section FROM l4 WHERE d IS NULL AND st IS NULL AND se IS NULL AND th IS NULL),
good AS (SELECT *, CASE WHEN section <> 'teaching_hint' AND regexp_matches(line, '^\\(?[\\s\\p{{Z}}]*([0-9]{{1,2}})[\\s\\p{{Z}}]*\\)') THEN 1 ELSE 0 END AS opens FROM ctx WHERE stage IS NOT NULL AND domain IS NOT NULL AND theme IS NOT NULL AND section IS NOT NULL),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY {_KEY}, section ORDER BY pos) AS item FROM good),
joined AS (SELECT {_KEY}, section, item, string_agg(line, chr(10) ORDER BY pos) AS t, list_sort(list(DISTINCT page)) AS pages FROM runs GROUP BY {_KEY}, section, item),
s0 AS (SELECT *, {_CLEANED('t', 180)} AS s FROM joined),
s1 AS (SELECT *, CASE WHEN section = 'teaching_hint' THEN {_CUT('s', 220)} ELSE {_CUT('s', 180)} END AS statement FROM s0),
long AS (SELECT {_KEY}, section, item, statement, pages FROM s1 WHERE length(statement) >= 8),
rest0 AS (SELECT {_KEY}, section, string_agg(line, chr(10) ORDER BY pos) AS t, list_sort(list(DISTINCT page)) AS pages FROM good g WHERE NOT EXISTS (SELECT 1 FROM long l WHERE l.doc = g.doc AND l.stage = g.stage AND l.domain = g.domain AND l.theme = g.theme AND l.section = g.section) GROUP BY {_KEY}, section),
rest1 AS (SELECT *, {_CLEANED('t', 220)} AS s FROM rest0),
rest2 AS (SELECT *, {_CUT('s', 220)} AS w FROM rest1),
rest3 AS (SELECT {_KEY}, section, pages, i, substr(w, i * 180 + 1, 180) AS s FROM (SELECT *, unnest(range(0, greatest(length(w) - 1, 0) // 180 + 1)) AS i FROM rest2)),
every AS (SELECT {_KEY}, section, item, statement, pages FROM long UNION ALL SELECT {_KEY}, section, i, concat(regexp_replace(s, '[，,、]+$', ''), CASE WHEN ends_with(s, '。') THEN '' ELSE '。' END), pages FROM rest3 WHERE length(s) >= 8),
items AS (SELECT {_KEY}, section, row_number() OVER (PARTITION BY {_KEY}, section ORDER BY item) AS n, statement, pages, {_case('stage', B.STAGES, 0)} AS st, {_case('domain', B.DOMAINS, 0)} AS dm, {_case('theme', B.THEMES)} AS th, {_case('section', B.SECTIONS, 1)} AS se, {_case('section', B.SECTIONS, 0)} AS label, {_case('section', B.SECTIONS, 2)} AS prefix, {_case('stage', B.STAGES, 5)} AS so FROM every),
coded AS (SELECT *, concat('mathematics.', doc) AS code, concat_ws('-', 'std', doc, st, dm, th, se, CASE WHEN n < 10 THEN '0' ELSE '' END || n) AS std, concat_ws('.', concat('mathematics.', doc), st, dm, th, se, CASE WHEN n < 10 THEN '0' ELSE '' END || n) AS con, concat_ws('.', concat('mathematics.', doc), st, dm, th) AS tcon, concat_ws('.', concat('mathematics.', doc), st, dm) AS dcon FROM items),
topics AS (SELECT {_KEY}, st, dm, th, so, tcon, dcon, min({{'s': section, 'n': n, 'i': std}}).i AS ref FROM coded GROUP BY {_KEY}, st, dm, th, so, tcon, dcon),
domains AS (SELECT doc, stage, domain, dm, so, dcon, arg_min(ref, theme) AS ref FROM topics GROUP BY doc, stage, domain, dm, so, dcon),
concepts AS (SELECT con AS id, concat(stage, ' ', theme, ' ', label, '：', CASE WHEN length({_NAME}) > 26 THEN regexp_replace(substr({_NAME}, 1, 26), '[，,、]+$', '') ELSE {_NAME} END) AS name, concat(prefix, statement) AS definition, stage, dm AS domain, section AS concept_type, std AS ref, CASE section WHEN 'teaching_hint' THEN 0.82e0 ELSE 0.86e0 END AS confidence, concat_ws('/', stage, coded.domain, theme, label) AS path, array_to_string(pages, ',') AS pages FROM coded
  UNION ALL SELECT tcon, concat(stage, ' ', theme), concat(stage, domain, '中的', theme, '主题，汇集内容要求、学业要求和教学提示。'), stage, dm, 'topic_group', ref, 0.84e0, concat_ws('/', stage, topics.domain, theme), NULL FROM topics
  UNION ALL SELECT dcon, concat(stage, ' ', domain), concat(stage, '数学课程内容中的', domain, '学习领域。'), stage, dm, 'domain_group', ref, 0.84e0, concat_ws('/', stage, domains.domain), NULL FROM domains)"""


def _build(v):
    return B.build(v.curriculum_lines.withColumn("pos", F.col("pos").cast("bigint")))


def _joined(c: str) -> F.Column:
    return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)


_BAND = f"{_case('stage', B.STAGES, 1)} AS grade_local, CAST({_case('stage', B.STAGES, 2)} AS BIGINT) AS min_grade, CAST({_case('stage', B.STAGES, 3)} AS BIGINT) AS max_grade, {_case('stage', B.STAGES, 4)} AS stage_level"


@query(f"{_BUILD} SELECT {_KEY}, section, count(*) AS n_lines, min(page) AS first_page, max(page) AS last_page FROM good GROUP BY {_KEY}, section")
def gr_curriculum_contexts(v):
    return _build(v)["contexts"]


_FIXED = ", ".join(
    [f"('{suffix}', 'stage_group', NULL, '{name}', NULL, '{local}', {low}, {high}, '{level}', {i})" for i, (level, (suffix, name, local, low, high)) in enumerate(B.Curriculum().groups.items(), 1)]
    + [f"('{v[0]}', 'grade_band', '{B.Curriculum().groups[v[4]][0]}', '{k}', '{v[0]}', '{v[1]}', {v[2]}, {v[3]}, '{v[4]}', {v[5]})" for k, v in B.STAGES.items()]
    + [f"('{v[0]}', 'domain', NULL, '{k}', NULL, NULL, NULL, NULL, NULL, {v[1]})" for k, v in B.DOMAINS.items()]
)
_TOPIC_SLUGS = f"{_case('stage', B.STAGES, 0)} AS st, {_case('domain', B.DOMAINS, 0)} AS dm, {_case('theme', B.THEMES)} AS th"


@query(f"""{_BUILD}, fixed(slug, type, parent, name, native_code, grade_local, min_grade, max_grade, stage_level, ord) AS (VALUES {_FIXED}), docs AS (SELECT DISTINCT doc FROM cl),
t AS (SELECT DISTINCT {_KEY}, {_TOPIC_SLUGS}, {_case('stage', B.STAGES, 5)} AS so, {_case('domain', B.DOMAINS, 1)} AS oo FROM good)
SELECT concat(doc, '-', slug) AS id, type, doc AS curriculum_id, CASE WHEN parent IS NOT NULL THEN concat(doc, '-', parent) END AS parent_id, name, native_code, grade_local, CAST(min_grade AS BIGINT) AS min_grade, CAST(max_grade AS BIGINT) AS max_grade, stage_level, CAST(ord AS BIGINT) AS "order" FROM docs, fixed
UNION ALL SELECT concat_ws('-', doc, st, dm, th), 'topic', doc, concat(doc, '-', dm), theme, concat(st, '-', th), {_BAND}, 10 + row_number() OVER (PARTITION BY doc ORDER BY so, oo, theme) FROM t""")  # fmt: skip
def gr_curriculum_framework(v):
    return _build(v)["framework_nodes"]


@query(f"""{_BUILD} SELECT std AS id, section AS type, doc AS curriculum_id, concat_ws('-', doc, st, dm, th) AS framework_id, concat_ws('/', st, dm, th, se, CASE WHEN n < 10 THEN '0' ELSE '' END || n) AS native_code, 'mathematics' AS subject, dm AS domain, th AS theme,
concat_ws(',', concat(doc, '-', st), concat(doc, '-', dm), concat_ws('-', doc, st, dm, th)) AS framework_node_ids, concat_ws(',', stage, coded.domain, coded.theme, label) AS framework_path, {_BAND}, statement, {_labels(list(C.PROCESSES), 'understand')} AS cognitive_process, {_DIMENSIONS} AS knowledge_dimension,
concat_ws(' / ', '四、课程内容', coded.domain, stage, coded.theme, label) AS source, pages[1] AS page, array_to_string(pages, ',') AS pages, {_PAGE} AS native_ref, CASE section WHEN 'teaching_hint' THEN 0.82e0 ELSE 0.88e0 END AS confidence FROM coded""")  # fmt: skip
def gr_curriculum_standards(v):
    listed = ("framework_node_ids", "framework_path", "cognitive_process", "knowledge_dimension", "pages")
    own = _build(v)["standard_items"]
    return own.select(*(_joined(c) if c in listed else c for c in own.columns))


@query(f"{_BUILD} SELECT id, name, definition, {_BAND}, domain, concept_type, ref AS standard_ids, confidence, path AS framework_path, pages AS pdf_pages, 'mathematics' AS subject FROM concepts")
def gr_curriculum_concepts(v):
    own = _build(v)["concepts"].withColumn("framework_path", F.array_join("framework_path", "/"))
    return own.select(*(_joined(c) if c in ("standard_ids", "pdf_pages") else c for c in own.columns))


@query(f"{_BUILD} SELECT concat('evidence-', id) AS id, id AS concept_id, concat('学生能够说明、完成或应用：', name, '。') AS statement, 'mathematics' AS subject, 0.76e0 AS confidence FROM concepts")
def gr_curriculum_evidence(v):
    return _build(v)["learning_evidence"]


_COMPETENCY = ", ".join(f"CASE WHEN contains(concat(prefix, statement), '{c}') THEN '{c}' END" for c in B.COMPETENCIES)


@query(f"""{_BUILD}, links AS (
SELECT 'part_of' AS type, 'part-of' AS link, tcon AS source_id, dcon AS target_id, '主题隶属于同学段学习领域。' AS rationale, 0.9e0 AS confidence FROM topics
UNION ALL SELECT 'part_of', 'part-of', con, tcon, '课标条目隶属于对应学段主题。', 0.9e0 FROM coded
UNION ALL SELECT 'supports_competency', 'supports', con, concat('math.competency.', {SLUGB('c')}), '条目显式指向对应核心素养。', 0.78e0 FROM (SELECT con, unnest(list_filter([{_COMPETENCY}], c -> c IS NOT NULL)) AS c FROM coded)
UNION ALL SELECT 'progresses_to', 'extends', a.dcon, b.dcon, '同一学习领域按学段递进。', 0.86e0 FROM domains a JOIN domains b ON a.doc = b.doc AND a.domain = b.domain AND a.so + 1 = b.so
UNION ALL SELECT 'progresses_to', 'extends', a.tcon, b.tcon, '同一主题按学段递进。', 0.86e0 FROM topics a JOIN topics b ON a.doc = b.doc AND a.domain = b.domain AND a.theme = b.theme AND a.so + 1 = b.so)
SELECT concat('rel-', source_id, '-', link, '-', target_id) AS id, type, source_id, target_id, rationale, confidence FROM links""")  # fmt: skip
def gr_curriculum_relations(v):
    return _build(v)["relations"]


@query(f"""{_BUILD} SELECT 'concepts' AS collection, count(*) AS n, count(DISTINCT id) AS ids, 0 AS violations FROM concepts UNION ALL SELECT 'standard_items', count(*), count(DISTINCT std), 0 FROM coded UNION ALL SELECT 'topics', count(*), count(DISTINCT tcon), 0 FROM topics""")
def gr_curriculum_build(v):
    """Whole curricula, held against the rules of a dataset: what breaks one is counted with its collection."""
    made = _build(v)
    topics = made["concepts"].where("concept_type = 'topic_group'")
    broken = {"concepts": "concept", "standard_items": "standard", "topics": "framework"}
    found = C.validate_built(made).groupBy("entity").agg(F.count("*").alias("v"))
    rows = [df.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).withColumn("collection", F.lit(name)).withColumn("entity", F.lit(broken[name])) for name, df in (("concepts", made["concepts"]), ("standard_items", made["standard_items"]), ("topics", topics))]
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return whole.join(found, "entity", "left").select("collection", "n", "ids", F.coalesce("v", F.lit(0)).cast("int").alias("violations"))


# -- question documents ----------------------------------------------------------------

_TREE = r"""n0 AS (SELECT doc, t.key AS key, t.type AS jtype, regexp_replace(regexp_replace(replace(t.fullkey, '.', '/'), '\[(\d+)\]', '/\1', 'g'), '^\$', '') AS path, regexp_replace(regexp_replace(replace(t.path, '.', '/'), '\[(\d+)\]', '/\1', 'g'), '^\$', '') AS parent, t.atom ->> '$' AS text FROM qij_docs, json_tree(CAST(body AS JSON)) t WHERE t.fullkey <> '$'),
n AS (SELECT doc, key, path, parent, CASE WHEN jtype = 'OBJECT' THEN 'object' WHEN jtype = 'ARRAY' THEN 'array' WHEN jtype = 'VARCHAR' THEN 'string' WHEN jtype = 'BOOLEAN' THEN 'boolean' WHEN jtype = 'NULL' THEN 'null' ELSE 'number' END AS kind, text FROM n0),
o AS (SELECT a.doc, a.path, max(CASE WHEN b.key = 'id' THEN b.text END) AS id, max(CASE WHEN b.key = 'kind' THEN b.text END) AS kind, max(CASE WHEN b.key = 'type' THEN b.text END) AS type, max(CASE WHEN b.key = 'points' THEN CAST(b.text AS DOUBLE) END) AS points, max(CASE WHEN b.key = 'fallbackAssetId' THEN b.text END) AS fallback,
  max(CASE WHEN b.key = 'min' THEN CAST(b.text AS DOUBLE) END) AS lo, max(CASE WHEN b.key = 'max' THEN CAST(b.text AS DOUBLE) END) AS hi, max(CASE WHEN b.key = 'minSelections' THEN CAST(b.text AS DOUBLE) END) AS least, max(CASE WHEN b.key = 'maxSelections' THEN CAST(b.text AS DOUBLE) END) AS most FROM n a LEFT JOIN n b ON a.doc = b.doc AND b.parent = a.path AND b.text IS NOT NULL WHERE a.kind = 'object' GROUP BY 1, 2),
its AS (SELECT doc, path, kind, id, points FROM o WHERE regexp_matches(path, '^(/items/\d+)+$')),
qs AS (SELECT * FROM its WHERE kind = 'question'),
assets AS (SELECT doc, path, regexp_extract(path, '^/assets/([^/]+)$', 1) AS id, type, fallback FROM o WHERE regexp_matches(path, '^/assets/[^/]+$')),
rs AS (SELECT doc, path, regexp_extract(path, '^(.*)/responses/\d+$', 1) AS q, id, type, lo, hi, least, most FROM o WHERE regexp_matches(path, '^(/items/\d+)+/responses/\d+$')),
gr AS (SELECT g.doc, g.path, g.key AS r, qs.path AS q, o.points FROM n g LEFT JOIN qs ON qs.doc = g.doc AND g.path LIKE '/answerKey/' || qs.id || '/grading/%' LEFT JOIN o ON o.doc = g.doc AND o.path = g.path WHERE regexp_matches(g.path, '^/answerKey/[^/]+/grading/[^/]+$')),
opts AS (SELECT doc, regexp_extract(path, '^(.*)/options/\d+$', 1) AS spot, id FROM o WHERE regexp_matches(path, '/options/\d+$')),
w AS (SELECT * FROM assets WHERE type = 'widget'),
chain(doc, id, spot, k) AS (SELECT doc, id, fallback, 1 FROM w UNION ALL SELECT chain.doc, chain.id, w.fallback, k + 1 FROM chain JOIN w ON w.doc = chain.doc AND w.id = chain.spot WHERE k < 4),
f AS (
  SELECT 'item_id_repeated' AS rule, 'item' AS entity, doc, min(path) AS path, id AS detail FROM its WHERE id IS NOT NULL GROUP BY doc, id HAVING count(*) > 1
  UNION ALL SELECT CASE WHEN regexp_matches(path, '/actions/\d+/assetId$') THEN 'action_asset_not_found' ELSE 'asset_not_found' END, CASE WHEN regexp_matches(path, '/actions/\d+/assetId$') THEN 'action' ELSE 'content' END, doc, path, text FROM n WHERE key = 'assetId' AND (doc, text) NOT IN (SELECT (doc, id) FROM assets)
  UNION ALL SELECT 'response_not_found', 'content', doc, path, text FROM n WHERE key = 'responseId' AND (doc, regexp_extract(path, '^((?:/items/\d+)+)/content/', 1), text) NOT IN (SELECT (doc, q, id) FROM rs)
  UNION ALL SELECT 'question_not_found', 'answer', doc, path, key FROM n WHERE regexp_matches(path, '^/answerKey/[^/]+$') AND (doc, key) NOT IN (SELECT (doc, id) FROM qs)
  UNION ALL SELECT 'graded_response_not_found', 'grading', doc, path, r FROM gr WHERE q IS NOT NULL AND (doc, q, r) NOT IN (SELECT (doc, q, id) FROM rs)
  UNION ALL SELECT 'option_not_found', 'grading', n.doc, n.path, n.text FROM n JOIN gr ON gr.doc = n.doc AND regexp_extract(n.path, '^(/answerKey/[^/]+/grading/[^/]+)/(accepted|expected)(/\d+)*$', 1) = gr.path JOIN rs ON rs.doc = gr.doc AND rs.q = gr.q AND rs.id = gr.r AND rs.type = 'choice' WHERE n.text IS NOT NULL AND (n.doc, rs.path, n.text) NOT IN (SELECT (doc, spot, id) FROM opts)
  UNION ALL SELECT 'points_differ', 'question', s.doc, s.path, CAST(CAST(s.total AS DECIMAL(18, 2)) AS VARCHAR) FROM (SELECT qs.doc, qs.path, qs.points, count(gr.points) AS n, sum(gr.points) AS total, (SELECT count(*) FROM rs WHERE rs.doc = qs.doc AND rs.q = qs.path) AS of FROM qs JOIN gr ON gr.doc = qs.doc AND gr.q = qs.path WHERE (gr.doc, gr.q, gr.r) IN (SELECT (doc, q, id) FROM rs) GROUP BY 1, 2, 3) s WHERE s.n = s.of AND abs(s.total - s.points) > 1e-9
  UNION ALL SELECT 'rubric_points_differ', 'grading', r.doc, r.path, CAST(CAST(coalesce(c.s, 0) AS DECIMAL(18, 2)) AS VARCHAR) FROM o r LEFT JOIN (SELECT doc, regexp_extract(path, '^(.*)/criteria/\d+$', 1) AS path, sum(points) AS s FROM o WHERE regexp_matches(path, '/criteria/\d+$') GROUP BY 1, 2) c USING (doc, path) WHERE r.type = 'rubric' AND abs(coalesce(c.s, 0) - r.points) > 1e-9
  UNION ALL SELECT 'fallback_missing', 'asset', doc, path, coalesce(fallback, '') FROM w WHERE fallback IS NULL OR (doc, fallback) NOT IN (SELECT (doc, id) FROM assets)
  UNION ALL SELECT 'fallback_is_widget', 'asset', doc, path, fallback FROM w WHERE fallback IS NOT NULL AND (doc, fallback) IN (SELECT (doc, id) FROM w)
  UNION ALL SELECT DISTINCT 'fallback_circle', 'asset', w.doc, w.path, w.id FROM w JOIN chain ON chain.doc = w.doc AND chain.id = w.id AND chain.spot = w.id
  UNION ALL SELECT 'group_empty', 'item', doc, path, id FROM its WHERE kind = 'group' AND (doc, path) NOT IN (SELECT (doc, regexp_extract(path, '^(.*)/items/\d+$', 1)) FROM its)
  UNION ALL SELECT 'method_id_repeated', 'method', doc, min(path), id FROM o WHERE id IS NOT NULL AND regexp_matches(path, '/solution/methods/\d+$') GROUP BY doc, regexp_extract(path, '^(.*)/\d+$', 1), id HAVING count(*) > 1
  UNION ALL SELECT 'step_id_repeated', 'step', doc, min(path), id FROM o WHERE id IS NOT NULL AND regexp_matches(path, '/solution/methods/\d+/steps/\d+$') GROUP BY doc, regexp_extract(path, '^(.*)/\d+$', 1), id HAVING count(*) > 1
  UNION ALL SELECT 'cells_differ', 'table', r.doc, r.path, CAST((SELECT count(*) FROM n c WHERE c.doc = r.doc AND c.parent = r.path) AS VARCHAR) FROM n r JOIN o t ON t.doc = r.doc AND t.type = 'table' AND r.parent = t.path || '/rows' WHERE r.kind = 'array' AND (SELECT count(*) FROM n c WHERE c.doc = r.doc AND c.parent = r.path) <> (SELECT count(*) FROM n c WHERE c.doc = r.doc AND c.parent = t.path || '/columns')
  UNION ALL SELECT 'number_range', 'response', doc, path, CAST(CAST(lo AS DECIMAL(18, 2)) AS VARCHAR) FROM rs WHERE type = 'number' AND lo > hi
  UNION ALL SELECT 'choice_range', 'response', doc, path, CAST(k AS VARCHAR) FROM (SELECT rs.*, (SELECT count(*) FROM opts WHERE opts.doc = rs.doc AND opts.spot = rs.path) AS k FROM rs WHERE type = 'choice') WHERE least < 0 OR coalesce(most < 0 OR least > most OR most > k, false) OR least > k)"""


def _trees(v):
    return v.qij_docs.select("doc", F.try_parse_json("body").alias("v"))


@query(f"WITH RECURSIVE {_TREE} SELECT rule, 'E' AS severity, entity, concat(doc, '#', path) AS id, coalesce(detail, '') AS detail FROM f")
def qij_semantic(v):
    return qij.semantic_rules(_trees(v))


@query(f"WITH RECURSIVE {_TREE} SELECT doc, path, (length(path) - length(replace(path, '/', ''))) // 2 AS depth, kind, id, points FROM its")
def qij_item_tree(v):
    return qij.items(trees.tree(_trees(v)))


# -- merges that are published as a whole -------------------------------------------------

_OK = f"{STATE} <> 'rejected' AND ({STATE} = 'accepted' OR (confidence >= 0.8 AND len(source_refs) > 0))"


@query(f"""WITH new AS (SELECT * FROM store_candidates WHERE id NOT IN (SELECT id FROM store_nodes) AND {_OK}), ids AS (SELECT id FROM store_nodes UNION SELECT id FROM new),
ec AS (SELECT * REPLACE (coalesce(nullif(id, ''), {EDGE_ID('type', 'source', 'target')}) AS id) FROM store_edge_candidates),
new_e AS (SELECT * FROM ec WHERE id NOT IN (SELECT id FROM store_edges) AND source IN (SELECT id FROM ids) AND target IN (SELECT id FROM ids) AND {_OK})
SELECT 'node' AS entity, id, type, confidence, coalesce(nullif({STATE}, ''), 'accepted') AS review_state FROM (SELECT id, type, confidence, review_state FROM store_nodes UNION ALL SELECT id, type, confidence, review_state FROM new)
UNION ALL SELECT 'edge', id, type, confidence, coalesce(nullif({STATE}, ''), 'accepted') FROM (SELECT id, type, confidence, review_state FROM store_edges UNION ALL SELECT id, type, confidence, review_state FROM new_e)""")  # fmt: skip
def gr_merge_store(v):
    """A batch that is merged, one that would break a rule, and the first again: the graph is that of the first."""
    store = GraphStore(v.spark, work_folder(v.spark) + "/graph")
    sources = v.spark.range(1).select(F.lit("src:a").alias("source_id"), F.lit(None).cast("string").alias("chunk_id"))
    store.create(v.store_nodes, v.store_edges, sources)
    nodes, edges = v.store_candidates, v.store_edge_candidates
    more = sources.withColumn("source_id", F.lit("src:b"))
    store.merge(nodes, edges, more)
    spoiled = edges.withColumns({"id": F.concat(F.lit("bad-"), F.col("pos").cast("string")), "evidence": F.lit(" ")})
    store.merge(nodes, spoiled)
    store.merge(nodes, edges, more)
    n, e, _ = store.read()
    columns = ("id", "type", "confidence", "review_state")
    both = n.select(F.lit("node").alias("entity"), *columns).unionByName(e.select(F.lit("edge").alias("entity"), *columns))
    return both.withColumn("review_state", F.trim("review_state"))


# -- repositories, manifests, imports -----------------------------------------------------

_TOP = "json_extract_string(body, '$.{}')"
_GOODF = "good AS (SELECT folder, file, CAST(body AS JSON) AS body FROM repo_files WHERE file <> 'readme.json' AND json_valid(body) AND json_type(CASE WHEN json_valid(body) THEN body ELSE '1' END) = 'OBJECT')"
_PACKS = " UNION ALL ".join(
    [f"SELECT 'missing_file' AS rule, 'E' AS severity, 'folder' AS entity, d.folder AS id, '{f}' AS detail FROM (SELECT DISTINCT folder FROM repo_files) d WHERE NOT EXISTS (SELECT 1 FROM repo_files r WHERE r.folder = d.folder AND r.file = '{f}')" for f in P.PACK_FILES]
    + ["SELECT 'not_an_object', 'E', 'file', concat(folder, '/', file), '' FROM repo_files WHERE file <> 'readme.json' AND (folder, file) NOT IN (SELECT (folder, file) FROM good)"]
    + [f"SELECT 'constant', 'E', 'file', concat(folder, '/', file), '{k}' FROM good WHERE file = '{f}' AND coalesce({_TOP.format(k)}, '') <> '{want}'" for f, own in P.PACK_CONSTANTS.items() for k, want in own.items()]
    + [f"SELECT 'id_differs', 'E', 'file', concat(folder, '/', file), coalesce({_TOP.format(k)}, '') FROM good WHERE file = '{f}' AND coalesce({_TOP.format(k)}, '') <> folder" for f, k in P.PACK_IDS.items()]
    + [f"SELECT 'empty_list', 'E', 'file', concat(folder, '/', file), '{k}' FROM good WHERE file = '{f}' AND (coalesce(json_type(body, '$.{k}'), '') <> 'ARRAY' OR json_array_length(body, '$.{k}') = 0)" for f, own in P.PACK_LISTS.items() for k in own]
    + ["SELECT 'no_artifacts', 'E', 'file', concat(folder, '/', file), '' FROM good WHERE file = 'manifest.json' AND coalesce(json_type(body, '$.artifacts'), '') <> 'OBJECT'"]
    + [f"SELECT 'artifact', 'E', 'file', concat(folder, '/', file), '{k}' FROM good WHERE file = 'manifest.json' AND json_type(body, '$.artifacts') = 'OBJECT' AND coalesce(json_extract_string(body, '$.artifacts.{k}'), '') <> '{want}'" for k, want in P.PACK_ARTIFACTS.items()]
    + ["SELECT 'placeholder', 'E', 'text', concat(folder, '/', file, '#', regexp_replace(regexp_replace(replace(t.fullkey, '.', '/'), '\\[(\\d+)\\]', '/\\1', 'g'), '^\\$', '')), CASE WHEN contains(t.atom ->> '$', 'TODO') THEN 'TODO' ELSE '[待补充]' END FROM good, json_tree(body) t WHERE t.type = 'VARCHAR' AND (contains(t.atom ->> '$', 'TODO') OR contains(t.atom ->> '$', '[待补充]'))"]
)


@query(f"WITH {_GOODF} {_PACKS}")
def val_repo(v):
    return P.pack_rules(v.repo_files.select("folder", "file", F.try_parse_json("body").alias("v")))


_M = "json_extract_string(body, '$.{}')"
_ASSETS = "a AS (SELECT doc, t.key AS key, t.type AS kind, t.value AS value FROM manifests, json_each(CAST(body AS JSON), '$.assets') t WHERE json_type(CAST(body AS JSON), '$.assets') IN ('OBJECT', 'ARRAY'))"


@query(f"""WITH m AS (SELECT doc, CAST(body AS JSON) AS body FROM manifests), {_ASSETS},
f AS (SELECT 'constant' AS rule, 'E' AS severity, 'manifest' AS entity, CAST(doc AS VARCHAR) AS id, 'schema' AS detail FROM m WHERE coalesce({_M.format('schema')}, '') <> '{P.MANIFEST_SCHEMA}'
UNION ALL SELECT 'constant', 'E', 'manifest', CAST(doc AS VARCHAR), 'kind' FROM m WHERE coalesce({_M.format('kind')}, '') <> '{P.MANIFEST_KIND}'
UNION ALL SELECT 'missing_field', 'E', 'manifest', CAST(doc AS VARCHAR), k FROM m, (SELECT unnest([{', '.join(f"'{k}'" for k in P.MANIFEST_FIELDS)}]) AS k) WHERE coalesce(json_extract_string(body, '$.' || k), '') = ''
UNION ALL SELECT 'owner', 'E', 'manifest', CAST(doc AS VARCHAR), 'shape' FROM m WHERE coalesce(json_type(body, '$.owner'), '') <> 'OBJECT'
UNION ALL SELECT 'owner', 'E', 'manifest', CAST(doc AS VARCHAR), 'type' FROM m WHERE json_type(body, '$.owner') = 'OBJECT' AND coalesce(trim({_M.format('owner.type')}), '') NOT IN ('official', 'user', 'shared', 'local')
UNION ALL SELECT 'owner', 'E', 'manifest', CAST(doc AS VARCHAR), 'name' FROM m WHERE json_type(body, '$.owner') = 'OBJECT' AND coalesce(trim({_M.format('owner.name')}), '') = ''
UNION ALL SELECT 'visibility', 'E', 'manifest', CAST(doc AS VARCHAR), coalesce({_M.format('visibility')}, '') FROM m WHERE coalesce(trim({_M.format('visibility')}), '') NOT IN ('public', 'private', 'shared', 'draft')
UNION ALL SELECT 'shape', 'E', 'manifest', CAST(doc AS VARCHAR), k FROM m, (SELECT unnest(['legacy_ids', 'task_links', 'overlays']) AS k) WHERE coalesce(json_type(body, '$.' || k), 'NULL') <> 'NULL' AND json_type(body, '$.' || k) <> CASE k WHEN 'legacy_ids' THEN 'ARRAY' ELSE 'OBJECT' END
UNION ALL SELECT 'no_assets', 'E', 'manifest', CAST(doc AS VARCHAR), '' FROM m WHERE coalesce(json_type(body, '$.assets'), '') <> 'OBJECT' OR doc NOT IN (SELECT doc FROM a)
UNION ALL SELECT 'asset', 'E', 'asset', concat(doc, '#', key), 'path' FROM a WHERE kind = 'VARCHAR' AND trim(value ->> '$') = ''
UNION ALL SELECT 'asset', 'E', 'asset', concat(doc, '#', key), 'shape' FROM a WHERE kind NOT IN ('VARCHAR', 'OBJECT')
UNION ALL SELECT 'asset', 'E', 'asset', concat(doc, '#', key), 'path' FROM a WHERE kind = 'OBJECT' AND coalesce(trim(value ->> '$.path'), '') = ''
UNION ALL SELECT 'asset', 'E', 'asset', concat(doc, '#', key), 'bytes' FROM a WHERE kind = 'OBJECT' AND (value ->> '$.bytes') IS NOT NULL AND (TRY_CAST(value ->> '$.bytes' AS DOUBLE) IS NULL OR TRY_CAST(value ->> '$.bytes' AS DOUBLE) <= -1)
UNION ALL SELECT 'asset', 'E', 'asset', concat(doc, '#', key), 'sha256' FROM a WHERE kind = 'OBJECT' AND coalesce(trim(value ->> '$.sha256'), '') <> '' AND NOT regexp_full_match(value ->> '$.sha256', '[0-9a-f]{{64}}')
UNION ALL SELECT 'no_main_asset', 'W', 'manifest', CAST(doc AS VARCHAR), '' FROM m WHERE doc NOT IN (SELECT doc FROM a WHERE key IN ('group_map', 'map', 'kg'))) SELECT * FROM f""")  # fmt: skip
def val_manifest_whole(v):
    return P.manifest_rules(v.manifests.select("doc", F.try_parse_json("body").alias("v")))


@query(f"""WITH e AS (SELECT edge_imports.path AS path, CAST(t.key AS BIGINT) AS pos, t.value AS v FROM edge_imports, json_each(CAST(body AS JSON), '$.edges') t WHERE t.type = 'OBJECT'),
r AS (SELECT *, coalesce(nullif(v ->> '$.source', ''), nullif(v ->> '$.from', '')) AS source, coalesce(nullif(v ->> '$.target', ''), nullif(v ->> '$.to', '')) AS target, CASE WHEN v ->> '$.type' IN ('requires', 'extends') THEN v ->> '$.type' ELSE 'related_to' END AS type FROM e)
SELECT path, pos, coalesce(nullif(v ->> '$.id', ''), {EDGE_ID('type', 'source', 'target')}) AS id, type, source, target, coalesce(v ->> '$.evidence', '') AS evidence, coalesce(nullif(v ->> '$.reason', ''), '{D.IMPORTED_REASON}') AS reason,
CASE WHEN json_type(v, '$.source_refs') = 'ARRAY' THEN array_to_string(json_extract_string(v, '$.source_refs[*]'), ',') ELSE coalesce(v ->> '$.source_refs', '') END AS source_refs, CASE WHEN coalesce(CAST(v ->> '$.confidence' AS DOUBLE), 0) <> 0 THEN CAST(v ->> '$.confidence' AS DOUBLE) WHEN type = 'related_to' THEN 0.55e0 ELSE 0.75e0 END AS confidence, CASE WHEN json_type(v, '$.review') = 'OBJECT' THEN coalesce(v ->> '$.review.state', '') ELSE 'needs_review' END AS review_state
FROM r WHERE source IS NOT NULL AND target IS NOT NULL""")  # fmt: skip
def src_json_edges(v):
    docs = v.edge_imports.select("path", F.try_parse_json("body").alias("v"))
    return D.imported_edges(docs).withColumn("source_refs", F.array_join("source_refs", ",")).drop("raw")


# -- seeded maps ---------------------------------------------------------------------------

_SEED = f"""own AS (SELECT s.*, d.name AS dname, concat('kg:', s.domain, ':', {SLUGB('s.theme')}, ':', {SLUGB('s.name')}) AS id FROM seed_groups s JOIN seed_domains d ON s.domain = d.domain),
grp AS (SELECT *, row_number() OVER (ORDER BY pos, id) AS ord FROM own),
known AS (SELECT name, min(id) AS id FROM grp GROUP BY 1 HAVING count(*) = 1)"""


def _seeded(v):
    return K.seeded(v.seed_domains, v.seed_groups, v.seed_relations, "src:seed")


@query(f"""WITH {_SEED} SELECT concat('domain:', domain) AS id, 'domain' AS type, name, domain, '' AS points, '' AS summary, NULL AS core_understanding, '' AS progression, '' AS tasks, 'src:seed' AS source_refs, 1e0 AS confidence, CAST(ord * 100 AS BIGINT) AS ord FROM seed_domains
UNION ALL SELECT id, 'knowledge_group', name, domain, array_to_string(points, ','), coalesce(nullif(summary, ''), concat(name, '组织', dname, ' / ', theme, '中的核心概念、方法和表达方式，支撑后续知识点的学习和应用。')), concat('理解', name, '时，需要把', points[1], '等核心对象与情境、表示和方法联系起来。'),
concat_ws('|', concat('1-2年级:在直观情境中感知', name, '的基本对象或经验。'), concat('3-4年级:在具体问题中使用', name, '的表示、方法或规则。'), concat('5-6年级:逐步概括', name, '中的关系、性质和一般方法。'), concat('7-9年级:用更形式化的语言和模型理解并应用', name, '。')),
coalesce(array_to_string(typical_tasks, '|'), concat('解释', points[1], '的意义或作用。|用', name, '解决熟悉情境中的问题。')), 'src:seed', coalesce(confidence, 0.82e0), ord FROM grp""")  # fmt: skip
def gr_group_build(v):
    nodes = _seeded(v)[0]
    steps = F.array_join(F.transform("grade_progression", lambda x: F.concat_ws(":", x["band"], x["focus"])), "|")
    return nodes.select("id", "type", "name", "domain", F.array_join("points", ",").alias("points"), "summary", "core_understanding", F.coalesce(steps, F.lit("")).alias("progression"), F.coalesce(F.array_join("typical_tasks", "|"), F.lit("")).alias("tasks"), F.array_join("source_refs", ",").alias("source_refs"), "confidence", "ord")


@query(f"""WITH {_SEED} SELECT concat('kgrel:part-of:', {SLUGB('name')}, ':', {SLUGB('domain')}) AS id, 'part_of' AS type, id AS source, concat('domain:', domain) AS target, '知识点组隶属于对应数学学习领域。' AS evidence, 'src:seed' AS source_refs, 1e0 AS confidence, 'anchor' AS visibility FROM grp
UNION ALL SELECT concat('kgrel:', type, ':', {SLUGB('source_name')}, ':', {SLUGB('target_name')}), type, a.id, b.id, evidence, coalesce(array_to_string(source_refs, ','), 'src:seed'), coalesce(confidence, 0.84e0), 'featured' FROM seed_relations r JOIN known a ON a.name = source_name JOIN known b ON b.name = target_name""")  # fmt: skip
def gr_group_build_edges(v):
    return _seeded(v)[1].withColumn("source_refs", F.array_join("source_refs", ",")).drop("review_state")


# -- layouts and pages ---------------------------------------------------------------------

_PROFILES = "CASE WHEN ord % 3 = 0 THEN NULL ELSE ord * 1.5e0 END AS y, CASE WHEN ord % 2 = 0 THEN 3 WHEN ord % 5 = 0 THEN 0 ELSE NULL END AS columns"


def _LAID(name: str, join: str, y: str, n: str) -> str:
    x = f"-9.5 + 20.0e0 / greatest({n} - 1, 1) * (i % {n})"
    return f"SELECT '{name}' AS profile, id, round(CASE WHEN type = 'domain' THEN -12.0e0 ELSE {x} END, 6) AS x, round(CASE WHEN type = 'domain' THEN {y} ELSE {y} - floor(i / {n}) * 1.18e0 END, 6) AS y FROM gi {join}"


@query(f"""WITH gi AS (SELECT *, row_number() OVER (PARTITION BY domain, type ORDER BY ord, id) - 1 AS i FROM group_nodes), pf AS (SELECT domain, coalesce(y, 5.2e0 - ord * 3.2e0) AS py, nullif(columns, 0) AS pn FROM (SELECT domain, ord, {_PROFILES} FROM seed_domains WHERE ord > 1))
{_LAID('own', 'LEFT JOIN pf USING (domain)', 'coalesce(py, 0.0e0)', 'coalesce(pn, 8)')} UNION ALL {_LAID('none', '', '0.0e0', '8')}""")  # fmt: skip
def win_domain_layout_profile(v):
    profile = v.seed_domains.where("ord > 1").select("domain", F.col("ord").alias("pos"), F.expr(_PROFILES.split(" AS y, ")[0]).alias("y"), F.expr(_PROFILES.split(" AS y, ")[1].removesuffix(" AS columns")).alias("columns"))
    each = [K.layout(v.group_nodes, profile=p).select(F.lit(name).alias("profile"), "id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")) for name, p in (("own", profile), ("none", None))]
    return each[0].unionByName(each[1])


@query("""WITH r AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS n FROM group_nodes) SELECT id, round(cos(6.283185307179586e0 * i / n) * greatest(4.0e0, sqrt(n)), 6) AS x, round(sin(6.283185307179586e0 * i / n) * greatest(4.0e0, sqrt(n)), 6) AS y FROM r""")
def win_fallback_pos(v):
    return K.fallback_positions(v.group_nodes).select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_ZONE_TEXT = "CASE WHEN pos = 0 AND doc_id % 10 < 8 THEN 'Running title' WHEN pos = 3 AND doc_id % 10 < 9 THEN 'Not at the edge' ELSE t END"


@query(f"""WITH {_BLOCKS}, ends AS (SELECT doc_id, max(pos) + 1 AS n FROM blocks GROUP BY 1), z AS (SELECT source, doc_id, {_ZONE_TEXT} AS t, pos / n AS y0, (pos + 1) / n AS y1 FROM blocks JOIN ends USING (doc_id) JOIN documents USING (doc_id)),
pg AS (SELECT DISTINCT source, doc_id FROM z), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM pg), sm AS (SELECT source, doc_id, least(n, 40) AS o FROM r WHERE n >= 3 AND (n <= 40 OR r <= 20 OR r > n - 20))
SELECT z.source, t, count(*) AS n FROM z JOIN sm USING (source, doc_id) WHERE (y0 < 0.15 AND y1 > 0) OR (y1 > 0.85 AND y0 < 1) GROUP BY z.source, t, o HAVING count(*) / o > 0.6""")  # fmt: skip
def agg_running_header_zone(v):
    rows = v.documents.select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "t")).withColumn("t", T.clean_text(F.col("t"))).where("t <> ''")
    ends = rows.groupBy("doc_id").agg((F.max("pos") + 1).alias("_n"))
    boxed = rows.join(ends, "doc_id").select("source", "doc_id", F.expr(_ZONE_TEXT).alias("t"), (F.col("pos") / F.col("_n")).alias("y0"), ((F.col("pos") + 1) / F.col("_n")).alias("y1"))
    return O.running_headers(boxed, "source", "doc_id", "t", top="y0", bottom="y1", store=_stored(boxed))
