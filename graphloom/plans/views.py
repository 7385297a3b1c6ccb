"""The graph, curriculum and text tables that the queries run on, projected from
the TPC-like tables.

Each view is one SQL text for both engines: ``@name`` is a table, ``ARR(...)`` an
array, ``AGG[[x||o]]`` the values of ``x`` in the order of ``o`` joined by commas.  The source tables are clean, so some values are spoiled by rule; every
row of every table takes part.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_QUESTION = """concat('{"kind":"question","id":"', CASE WHEN k % 37 = 5 THEN 'q0' ELSE concat('q', turn) END, '","points":', CASE WHEN k % 31 = 3 THEN '3' ELSE '2' END, ',"content":[{"type":"markdown","text":"', role, '"},{"type":"asset","assetId":"', CASE WHEN k % 11 = 4 THEN 'nofig' ELSE 'fig' END,
    '"},{"type":"template","parts":[{"type":"response","responseId":"', CASE WHEN k % 13 = 2 THEN 'none' ELSE 'a' END, '"}]},{"type":"table","columns":["x","y"],"rows":[[1,2],[3', CASE WHEN k % 17 = 6 THEN '' ELSE ',null' END, ']]}],"responses":[{"id":"a","type":"choice","minSelections":', CASE WHEN k % 43 = 9 THEN '-1' ELSE '1' END, CASE WHEN k % 3 = 0 THEN '' ELSE concat(',"maxSelections":', CASE WHEN k % 7 = 1 THEN '3' ELSE '2' END) END,
    ',"options":[{"id":"A"},{"id":"B"}]},{"id":"b","type":"number","min":', CASE WHEN k % 19 = 8 THEN '5' ELSE '0' END, ',"max":3.5}]}')"""
_ANSWER = """concat('"', CASE WHEN k % 29 = 11 THEN 'zz' ELSE 'q' END, turn, '":{"grading":{"a":{"type":"exact","accepted":["', CASE WHEN k % 23 = 7 THEN 'Z' ELSE 'A' END, '"],"points":1},"', CASE WHEN k % 21 = 10 THEN 'c' ELSE 'b' END, '":{"type":"rubric","points":1,"criteria":[{"id":"x","points":0.5},{"id":"y","points":', CASE WHEN k % 9 = 5 THEN '0.25' ELSE '0.5' END,
    '}]}},"solution":{"methods":[{"id":"m","steps":[{"id":"s1"},{"id":"', CASE WHEN k % 10 = 6 THEN 's1' ELSE 's2' END, '","actions":[{"assetId":"', CASE WHEN k % 12 = 3 THEN 'gone' ELSE 'fig' END, '"}]}]},{"id":"', CASE WHEN k % 16 = 9 THEN 'm' ELSE 'm2' END, '","steps":[]}]}}')"""

_REFS = "CASE WHEN k % 13 = 0 THEN ARR('') WHEN k % 3 = 0 THEN ARR(concat('src:', k % 7), concat('src:', k % 5, '#c', k % 4)) ELSE ARR(concat('src:', k % 7)) END"
_STATE = "CASE k % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN ' needs_review ' WHEN 2 THEN 'draft' WHEN 3 THEN 'rejected' ELSE '' END"
_CONF = "CASE WHEN k % 37 = 5 THEN NULL ELSE (k % 120) / 100e0 END"

VIEWS = {
    "kg_base": """
SELECT concat('region:', r_regionkey) AS id, 'curriculum' AS type, r_name AS name, 'general' AS subject, CAST(NULL AS BIGINT) AS grade, CAST(r_regionkey AS BIGINT) AS k, CAST(0 AS BIGINT) AS grp FROM @region
UNION ALL SELECT concat('nation:', n_nationkey), 'concept', n_name, 'geography', CAST(NULL AS BIGINT), CAST(n_nationkey AS BIGINT), CAST(1 AS BIGINT) FROM @nation
UNION ALL SELECT concat('supplier:', s_suppkey), 'skill', s_name, 'science', CAST(NULL AS BIGINT), s_suppkey, CAST(2 AS BIGINT) FROM @supplier
UNION ALL SELECT concat('customer:', c_custkey), 'task', c_name, c_mktsegment, CAST(NULL AS BIGINT), c_custkey, CAST(3 AS BIGINT) FROM @customer
UNION ALL SELECT concat('part:', p_partkey), 'concept', p_name, p_brand, CAST(p_size AS BIGINT), p_partkey, CAST(4 AS BIGINT) FROM @part""",
    "kg_nodes": f"""
SELECT CASE WHEN k % 97 = 11 THEN concat('part:', k - 1) ELSE id END AS id, CASE WHEN k % 53 = 7 THEN 'topic' ELSE type END AS type,
  CASE WHEN k % 59 = 8 THEN '  ' ELSE name END AS name, subject, CASE k % 4 WHEN 0 THEN '初中' WHEN 1 THEN 'High School' WHEN 2 THEN ' middle ' ELSE '' END AS stage,
  CASE WHEN k % 2 = 0 THEN 'cn-unified' ELSE 'intl' END AS curriculum, CASE WHEN k % 6 = 0 THEN concat('Area ', k % 4) ELSE NULL END AS domain,
  CASE WHEN grade IS NULL THEN CASE k % 3 WHEN 0 THEN concat(k % 9, '-', k % 9 + 1, '年级') WHEN 1 THEN '三年级' ELSE NULL END ELSE CAST(grade AS STRING) END AS grade,
  CASE WHEN k % 7 = 0 THEN 'hard' WHEN k % 7 = 1 THEN NULL ELSE CAST(k % 5 + 1 AS STRING) END AS difficulty,
  CASE WHEN k % 4 = 0 THEN ' ' ELSE concat('  About ', name, '\t and ', subject, '  ') END AS definition, CASE WHEN k % 8 = 0 THEN NULL ELSE concat('Summary of ', name) END AS summary,
  ARR(concat('别名', k), name, concat(name, '!')) AS aliases, ARR('lesson-anchor', concat('Tag ', k % 5)) AS tags, {_REFS} AS source_refs, {_CONF} AS confidence, {_STATE} AS review_state,
  CASE WHEN k % 9 = 0 THEN concat('km-', id) ELSE NULL END AS ext_map, CASE WHEN k % 9 < 2 THEN concat('prod-', id) ELSE NULL END AS ext_product,
  CASE WHEN k % 10 = 0 THEN ARR(' read ', 'count', 'read', '') ELSE NULL END AS skills, grp * 1000000000000 + k AS pos, k FROM kg_base""",
    "kg_links": """
SELECT 'part_of' AS type, concat('nation:', n_nationkey) AS source, concat('region:', n_regionkey) AS target, CAST(n_nationkey AS BIGINT) AS k, CAST(0 AS BIGINT) AS grp FROM @nation
UNION ALL SELECT 'part_of', concat('supplier:', s_suppkey), CASE WHEN s_suppkey % 17 = 0 THEN 'nation:none' ELSE concat('nation:', s_nationkey) END, s_suppkey, CAST(1 AS BIGINT) FROM @supplier
UNION ALL SELECT 'extends', concat('supplier:', s_suppkey), concat('nation:', s_nationkey), s_suppkey, CAST(2 AS BIGINT) FROM @supplier
UNION ALL SELECT 'part_of', concat(CASE WHEN c_custkey % 19 = 0 THEN 'client:' ELSE 'customer:' END, c_custkey), concat('nation:', c_nationkey), c_custkey, CAST(3 AS BIGINT) FROM @customer
UNION ALL SELECT 'related_to', concat('part:', l_partkey), concat('supplier:', l_suppkey), l_partkey * 7 + l_suppkey, CAST(4 AS BIGINT) FROM @lineitem
UNION ALL SELECT CASE WHEN o_orderkey % 31 = 0 THEN 'solves' ELSE 'assesses' END, CASE WHEN o_orderkey % 3 = 0 THEN concat('customer:', o_custkey) ELSE concat('order:', o_orderkey) END, concat('customer:', o_custkey), o_orderkey, CAST(5 AS BIGINT) FROM @orders
UNION ALL SELECT 'requires', concat('part:', p_partkey), concat('part:', CASE WHEN p_partkey = 1 THEN 8 ELSE CAST(floor(p_partkey / 2) AS BIGINT) END), p_partkey, CAST(6 AS BIGINT) FROM @part""",
    "kg_edges": f"""
SELECT concat('e', grp, '-', k) AS id, type, source, target, CASE WHEN k % 11 = 0 THEN ' ' ELSE concat('seen in ', grp) END AS evidence, CASE WHEN k % 22 = 0 THEN 'by rule' ELSE NULL END AS reason,
  {_REFS} AS source_refs, {_CONF} AS confidence, {_STATE} AS review_state, grp * 1000000000000 + k AS pos, k FROM kg_links""",
    "kg_requires": """
SELECT DISTINCT event_type AS source, nxt AS target FROM (SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM @events) t WHERE nxt IS NOT NULL AND nxt <> event_type""",
    "kg_sources": "SELECT DISTINCT concat('src:', n_nationkey % 5) AS source_id, concat('c', n_nationkey % 3) AS chunk_id FROM @nation",
    "kg_candidates": f"""
SELECT CASE WHEN k % 2 = 0 THEN concat('customer:', k) ELSE concat('new:', k) END AS id, CASE WHEN k % 41 = 3 THEN 'goal' ELSE 'task' END AS type, name, {_REFS} AS source_refs, {_CONF} AS confidence, {_STATE} AS review_state, k AS pos
FROM (SELECT c_custkey AS k, c_name AS name FROM @customer) c""",
    "kg_edge_candidates": f"""
SELECT CASE WHEN k % 4 = 0 THEN '' ELSE concat('ne-', k) END AS id, CASE WHEN k % 3 = 0 THEN 'related_to' ELSE 'requires' END AS type, concat('new:', k) AS source, concat('nation:', n) AS target, {_REFS} AS source_refs, {_CONF} AS confidence, {_STATE} AS review_state, k AS pos
FROM (SELECT c_custkey AS k, c_nationkey AS n FROM @customer) c""",
    "ucs_concepts": """
SELECT concat('concept:', p_partkey) AS id, p_name AS name, p_brand AS subject, CASE WHEN p_partkey % 21 = 0 THEN '' ELSE concat(p_type, ' item') END AS definition, concat('stage', p_size % 4) AS stage, p_type AS domain,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE (p_partkey % 110) / 100e0 END AS confidence, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE ARR(concat('std:', p_size), concat('std:', p_size + 1)) END AS standard_ids, p_partkey AS pos FROM @part""",
    "ucs_standards": """
SELECT DISTINCT concat('std:', p_size) AS id, concat('fw:', p_size % 12) AS framework_id, CASE WHEN p_size % 10 = 0 THEN 'cur:none' ELSE 'cur:main' END AS curriculum_id, CASE WHEN p_size % 8 = 0 THEN NULL ELSE 'book' END AS source, concat('Statement ', p_size) AS statement, CAST(p_size AS BIGINT) AS pos FROM @part""",
    "ucs_frameworks": """
SELECT concat('fw:', n_nationkey) AS id, CASE WHEN n_nationkey % 5 = 0 THEN '' WHEN n_nationkey % 7 = 0 THEN 'fw:none' ELSE concat('fw:', CAST(floor(n_nationkey / 2) AS BIGINT)) END AS parent_id, 'cur:main' AS curriculum_id, n_name AS name, CAST(n_nationkey AS BIGINT) AS pos FROM @nation""",
    "ucs_curricula": "SELECT 'cur:main' AS id, 'Main' AS name FROM @region WHERE r_regionkey = 0",
    "ucs_competencies": "SELECT concat('comp:', r_regionkey) AS id, r_name AS name, 'general' AS subject, concat('Ability ', r_name) AS description, CAST(NULL AS DOUBLE) AS confidence, CAST(r_regionkey AS BIGINT) AS pos FROM @region",
    "ucs_evidence": """
SELECT concat('ev:', c_custkey) AS id, CASE WHEN c_custkey % 23 = 0 THEN '' WHEN c_custkey % 29 = 0 THEN 'concept:none' ELSE concat('concept:', c_custkey) END AS concept_id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS subject,
  concat('Shows ', c_name) AS statement, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (c_custkey % 100) / 100e0 END AS confidence, c_custkey AS pos FROM @customer""",
    "ucs_relations": """
SELECT CASE WHEN o_orderkey % 27 = 0 THEN '' ELSE concat('rel:', o_orderkey) END AS id, CASE o_orderkey % 8 WHEN 0 THEN 'part_of' WHEN 1 THEN 'prerequisite_for' WHEN 2 THEN 'progresses_to' WHEN 3 THEN 'supports_competency' WHEN 4 THEN 'represented_by' WHEN 5 THEN 'contrasts_with' WHEN 6 THEN 'assessed_by' ELSE 'mentions' END AS type,
  concat('concept:', o_custkey) AS source_id, CASE WHEN o_orderkey % 8 = 6 THEN concat('ev:', o_custkey + 1) WHEN o_orderkey % 8 = 3 THEN concat('comp:', o_custkey % 7) ELSE concat('concept:', o_custkey + o_orderkey % 3) END AS target_id,
  CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE o_orderpriority END AS rationale, CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE (o_orderkey % 100) / 100e0 END AS confidence, CASE WHEN o_orderkey % 50 = 3 THEN 'other framework' ELSE NULL END AS hint, o_orderkey AS pos FROM @orders""",
    "group_nodes": """
SELECT concat('domain:', p_type) AS id, 'domain' AS type, p_type AS name, p_type AS domain, ARR('src:g') AS source_refs, ARR('') AS points, '' AS summary, CAST(0 AS BIGINT) AS n_tasks, CAST(0 AS BIGINT) AS n_misconceptions, CAST(0 AS BIGINT) AS n_progression, '' AS note, 1e0 AS confidence, 'accepted' AS review_state, CAST(999 AS BIGINT) AS ord FROM (SELECT DISTINCT p_type FROM @part) d
UNION ALL SELECT concat('group:', p_partkey), 'knowledge_group', p_name, p_type, CASE WHEN p_partkey % 25 = 0 THEN ARR(' ') ELSE ARR('src:g') END, CASE WHEN p_partkey % 16 = 0 THEN ARR('', ' ') ELSE ARR(p_name, p_brand, concat('size ', p_size)) END,
  CASE WHEN p_partkey % 10 = 0 THEN '' ELSE concat('About ', p_name) END, CAST(p_partkey % 3 AS BIGINT), CAST(p_partkey % 2 AS BIGINT), CAST(p_size % 4 AS BIGINT), CASE WHEN p_partkey % 40 = 1 THEN 'stands alone' ELSE '' END, CASE WHEN p_partkey % 33 = 4 THEN NULL ELSE (p_partkey % 105) / 100e0 END,
  CASE WHEN p_partkey % 14 = 0 THEN 'draft' WHEN p_partkey % 90 = 5 THEN 'odd' ELSE 'accepted' END, CAST(p_size AS BIGINT) FROM @part""",
    "group_edges": """
SELECT concat('gp-', p_partkey) AS id, 'part_of' AS type, concat('group:', p_partkey) AS source, concat('domain:', p_type) AS target, 'by type' AS evidence, ARR('src:g') AS source_refs, 0.9e0 AS confidence, 'accepted' AS review_state, p_partkey AS pos FROM @part
UNION ALL SELECT concat('gs-', l_orderkey, '-', l_linenumber), CASE l_linenumber % 4 WHEN 0 THEN 'requires' WHEN 1 THEN 'extends' WHEN 2 THEN 'related_to' ELSE 'applies_to' END, concat('group:', l_partkey), concat('group:', l_suppkey), CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE 'bought' END, ARR('src:g'),
  CASE WHEN l_orderkey % 15 = 0 THEN NULL ELSE l_discount END, CASE WHEN l_orderkey % 12 = 0 THEN 'needs_review' ELSE 'accepted' END, l_orderkey * 10 + l_linenumber + 1000000000000 FROM @lineitem""",
    "doc_review": """
SELECT d.doc_id, d.lang, d.source, d.n_chars, CASE WHEN l.doc_id IS NULL THEN '' WHEN l.toxic = 1 THEN 'rejected' WHEN l.quality = 1 THEN 'accepted' ELSE 'needs_review' END AS review_state FROM @documents d LEFT JOIN @labels l ON d.doc_id = l.doc_id""",
    "line_stream": """
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_type, event_id, CASE event_type WHEN 'signup' THEN concat('domain', event_id % 3) WHEN 'purchase' THEN concat('stage', event_id % 4) WHEN 'error' THEN concat('section', event_id % 3) WHEN 'click' THEN concat('theme', event_id % 5) ELSE '' END AS marker, props AS line FROM @events""",
    "curriculum_lines": """
SELECT concat('cur-', u) AS doc, CAST(floor(pos / 25) AS BIGINT) + 20 AS page, pos, CASE r
  WHEN 0 THEN concat('一、', CASE k % 5 WHEN 0 THEN '数与代数' WHEN 1 THEN '图形与几何' WHEN 2 THEN '统计与概率' WHEN 3 THEN '综合与实践' ELSE '数与代数 是一个很长的标题，长过十八个字' END)
  WHEN 1 THEN concat(CASE k % 4 WHEN 0 THEN '第一学段' WHEN 1 THEN '第二学段' WHEN 2 THEN '第三学段' ELSE '第四学段' END, '（', k % 4 * 2 + 1, '-', k % 4 * 2 + 2, 'FR）')
  WHEN 2 THEN '【内容要求】' WHEN 3 THEN ' 内容要求 ' WHEN 4 THEN '【学业要求】' WHEN 5 THEN '【教学提示了'
  WHEN 6 THEN concat(k % 9 + 1, '. 数 与 运 算') WHEN 7 THEN '二、图形的性质' WHEN 8 THEN CASE k % 3 WHEN 0 THEN '数量关系' ELSE '以项目学习为主' END WHEN 9 THEN '数据分类'
  WHEN 10 THEN '续表' WHEN 11 THEN CAST(k % 1000 AS STRING) WHEN 12 THEN '短'
  ELSE concat(CASE WHEN r < 22 THEN concat('（', r - 12, '）') ELSE '' END,
    CASE k % 6 WHEN 0 THEN '认识数的意义，发展数感' WHEN 1 THEN '探索图形的方法；形成空间观念' WHEN 2 THEN '会解决情境问题。例 12' WHEN 3 THEN '描述数据，经历活动，' WHEN 4 THEN '能比较和估算，体会算法与符号意识、模型意识' ELSE '了解' END,
    CASE WHEN k % 7 = 0 THEN concat('，并能在生活中说明理由', props, '，并能在生活中说明理由', props, '；并能在生活中说明理由', props, '，并能在生活中说明理由', props, '，并能在生活中说明理由', props, '，并能在生活中说明理由', props, '。并能在生活中说明理由', props) ELSE '' END, CASE WHEN k % 2 = 0 THEN '。' ELSE ' ' END) END AS line
FROM (SELECT CAST(floor(user_id / 10) AS BIGINT) AS u, row_number() OVER (PARTITION BY CAST(floor(user_id / 10) AS BIGINT) ORDER BY ts, event_id) AS pos, event_id % 30 AS r, CAST(floor(event_id / 30) AS BIGINT) AS k, props FROM @events) e""",
    "qij_rows": f"""
SELECT conv_id, turn, k, {_QUESTION} AS question, {_ANSWER} AS answer FROM (SELECT conv_id, turn, role, conv_id * 10 + turn AS k FROM @conversations) c""",
    "qij_docs": """
SELECT conv_id AS doc, concat('{"spec":"qij","version":"1.0","items":[', AGG[[CASE WHEN k % 5 < 2 THEN question WHEN k % 5 = 2 THEN concat('{"kind":"group","id":"g', turn, '","items":[', CASE WHEN k % 4 = 1 THEN '' ELSE question END, ']}') ELSE concat('{"kind":"group","id":"g', turn, '","items":[{"kind":"group","id":"h', turn, '","items":[', question, ']}]}') END||turn]], '],"answerKey":{', AGG[[answer||turn]],
  '},"assets":{"fig":{"type":"image"},"w1":{"type":"widget","name":"g","fallbackAssetId":"', CASE conv_id % 5 WHEN 0 THEN 'w2' WHEN 1 THEN 'fig' WHEN 2 THEN 'lost' WHEN 3 THEN 'w1' ELSE 'fig' END, '"},"w2":{"type":"widget","name":"g","fallbackAssetId":"', CASE conv_id % 3 WHEN 0 THEN 'w3' ELSE 'fig' END, '"},"w3":{"type":"widget"', CASE conv_id % 2 WHEN 0 THEN ',"fallbackAssetId":"w1"' ELSE '' END, '}}}') AS body
FROM qij_rows GROUP BY conv_id""",
    "store_nodes": """
SELECT concat('nation:', n_nationkey) AS id, 'concept' AS type, n_name AS name, 'geography' AS subject, '' AS stage, '' AS curriculum, ARR('src:a') AS source_refs, 0.9e0 AS confidence, 'accepted' AS review_state, CAST(n_nationkey AS BIGINT) AS pos FROM @nation
UNION ALL SELECT concat('customer:', c_custkey), 'task', c_name, c_mktsegment, '', '', ARR('src:a'), 0.9e0, 'accepted', c_custkey + 100 FROM @customer WHERE c_custkey % 2 = 0""",
    "store_edges": """
SELECT concat('e-', c_custkey) AS id, 'part_of' AS type, concat('customer:', c_custkey) AS source, concat('nation:', c_nationkey) AS target, 'lives there' AS evidence, CAST(NULL AS STRING) AS reason, ARR('src:a') AS source_refs, 0.9e0 AS confidence, 'accepted' AS review_state, c_custkey AS pos FROM @customer WHERE c_custkey % 2 = 0""",
    "store_candidates": """
SELECT concat('customer:', c_custkey) AS id, 'task' AS type, c_name AS name, c_mktsegment AS subject, '' AS stage, '' AS curriculum, ARR('src:b') AS source_refs, CASE WHEN c_custkey % 7 = 0 THEN 0.5e0 ELSE 0.85e0 END AS confidence, CASE WHEN c_custkey % 11 = 0 THEN 'rejected' WHEN c_custkey % 14 = 7 THEN 'accepted' WHEN c_custkey % 5 = 0 THEN ' needs_review ' ELSE ' ' END AS review_state, c_custkey AS pos FROM @customer""",
    "store_edge_candidates": """
SELECT CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 10 = 4 THEN concat('e-', c_custkey) ELSE concat('ne-', c_custkey) END AS id, CASE WHEN c_custkey % 4 = 1 THEN 'related_to' ELSE 'applies_to' END AS type, concat('customer:', c_custkey) AS source, CASE WHEN c_custkey % 13 = 0 THEN 'nation:none' ELSE concat('nation:', c_nationkey) END AS target, 'seen' AS evidence, CAST(NULL AS STRING) AS reason, ARR('src:b') AS source_refs,
  CASE WHEN c_custkey % 9 = 0 THEN 0.6e0 ELSE 0.8e0 END AS confidence, 'needs_review' AS review_state, c_custkey AS pos FROM @customer""",
    "repo_files": """
SELECT concat('pack-', k) AS folder, 'kg.json' AS file, concat('{"schema":"cgo.kg.v1","kind":"', CASE WHEN k % 27 = 4 THEN 'graph' ELSE 'kg' END, '","id":"pack-', CASE WHEN k % 11 = 5 THEN 'x' ELSE '' END, k, '","nodes":[{"name":"n","more":{"notes":["fine","', CASE WHEN k % 13 = 6 THEN 'TODO later' WHEN k % 13 = 7 THEN '[待补充]' ELSE 'done' END, '"]}}]}') AS body FROM (SELECT page_id AS k FROM @pages) p WHERE k % 41 <> 3
UNION ALL SELECT concat('pack-', k), 'learning-pack.json', concat('{"schema":"cgo.learning_pack.v1","kind":"learning_pack","id":"pack-', k, '","kg_refs":["a"],"objectives":', CASE WHEN k % 7 = 2 THEN '[]' WHEN k % 7 = 3 THEN '"many"' ELSE '[{"t":"x"}]' END, CASE WHEN k % 17 = 8 THEN '' ELSE ',"tasks":[1]' END, '}') FROM (SELECT page_id AS k FROM @pages) p
UNION ALL SELECT concat('pack-', k), 'knowledge-context.json', CASE WHEN k % 29 = 9 THEN 'no json' WHEN k % 29 = 10 THEN '[1]' ELSE concat('{"matches":', CASE WHEN k % 19 = 4 THEN '[]' ELSE '[{"id":1}]' END, '}') END FROM (SELECT page_id AS k FROM @pages) p WHERE k % 23 <> 1
UNION ALL SELECT concat('pack-', k), 'manifest.json', concat('{"pack_id":"pack-', k, '"', CASE WHEN k % 31 = 12 THEN '' WHEN k % 31 = 13 THEN ',"artifacts":"none"' ELSE concat(',"artifacts":{"kg":"', CASE WHEN k % 37 = 14 THEN 'graph.json' ELSE 'kg.json' END, '","learning_pack":"learning-pack.json"', CASE WHEN k % 43 = 15 THEN '' ELSE ',"knowledge_context":"knowledge-context.json"' END, '}') END, '}') FROM (SELECT page_id AS k FROM @pages) p
UNION ALL SELECT concat('pack-', k), 'readme.json', '{"TODO":"TODO"}' FROM (SELECT page_id AS k FROM @pages) p WHERE k % 5 = 0""",
    "manifests": """
SELECT k AS doc, concat('{"schema":"', CASE WHEN k % 23 = 1 THEN 'other' ELSE 'cgo.knowledge-map.manifest.v1' END, '","kind":"knowledge_map"', CASE WHEN k % 7 = 1 THEN '' ELSE concat(',"id":"', k, '"') END, ',"title":"', CASE WHEN k % 9 = 2 THEN '' ELSE 'T' END, '","version":"1","owner":', CASE k % 8 WHEN 3 THEN '"me"' WHEN 4 THEN '{"type":"nobody","name":"n"}' WHEN 5 THEN '{"type":"user","name":" "}' ELSE '{"type":"user","name":"n"}' END,
  ',"visibility":"', CASE WHEN k % 10 = 3 THEN 'hidden' ELSE ' public ' END, '","source_type":"s"', CASE WHEN k % 12 = 4 THEN ',"legacy_ids":{}' WHEN k % 12 = 5 THEN ',"legacy_ids":null,"overlays":[]' ELSE ',"legacy_ids":[],"task_links":{}' END, ',"assets":', CASE k % 15 WHEN 6 THEN '[]' WHEN 7 THEN '{}' ELSE concat('{"', CASE WHEN k % 4 = 1 THEN 'other' ELSE 'map' END, '":{"path":"', CASE WHEN k % 6 = 2 THEN '' ELSE 'a.json' END, '","bytes":', CASE k % 5 WHEN 1 THEN '-4' WHEN 2 THEN '"many"' ELSE '12' END, ',"sha256":"', CASE WHEN k % 3 = 1 THEN 'abc' ELSE sha END, '"},"extra":', CASE k % 11 WHEN 3 THEN '" "' WHEN 4 THEN '7' ELSE '"b.json"' END, '}') END, '}') AS body
FROM (SELECT page_id AS k, SHA2(url) AS sha FROM @pages) p""",
    "edge_imports": """
SELECT l_orderkey AS path, concat('{"edges":[1,', AGG[[concat('{"', CASE WHEN l_linenumber % 2 = 0 THEN 'from' ELSE 'source' END, '":"part:', l_partkey, '","', CASE WHEN l_linenumber % 2 = 0 THEN 'to' ELSE 'target' END, '":"', CASE WHEN l_suppkey % 13 = 0 THEN '' ELSE concat('supplier:', l_suppkey) END, '","type":"', CASE l_linenumber % 3 WHEN 0 THEN 'requires' WHEN 1 THEN 'likes' ELSE 'extends' END, '"',
  CASE WHEN l_partkey % 4 = 0 THEN concat(',"id":"e', l_partkey, '"') ELSE '' END, CASE WHEN l_partkey % 5 = 0 THEN ',"confidence":0.25,"source_refs":"src:x"' WHEN l_partkey % 5 = 1 THEN ',"confidence":0,"source_refs":["a","b"]' ELSE '' END, CASE WHEN l_partkey % 7 = 0 THEN ',"reason":"known","evidence":"seen","review":{"state":"accepted"}' WHEN l_partkey % 7 = 1 THEN ',"review":"yes"' ELSE '' END, '}')||(l_linenumber * 1000000 + l_partkey) * 1000000 + l_suppkey]], ']}') AS body FROM @lineitem GROUP BY l_orderkey""",
    "seed_domains": "SELECT p_type AS domain, concat('Area ', p_type) AS name, CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS ord FROM (SELECT DISTINCT p_type FROM @part) d",
    "seed_groups": """
SELECT p_partkey AS pos, CASE WHEN p_partkey % 50 = 7 THEN 'nowhere' ELSE p_type END AS domain, p_brand AS theme, concat(p_name, CASE WHEN p_partkey % 30 < 2 THEN '' ELSE concat(' ', p_partkey) END) AS name, ARR(p_name, concat('size ', p_size)) AS points, CASE WHEN p_partkey % 5 = 0 THEN concat('About ', p_name) WHEN p_partkey % 5 = 1 THEN '' ELSE NULL END AS summary,
  CASE WHEN p_partkey % 6 = 0 THEN ARR('Explain it') ELSE NULL END AS typical_tasks, CASE WHEN p_partkey % 8 = 0 THEN 0.9e0 ELSE NULL END AS confidence FROM @part""",
    "seed_relations": """
SELECT CASE l_linenumber % 3 WHEN 0 THEN 'requires' WHEN 1 THEN 'extends' ELSE 'applies_to' END AS type, a.name AS source_name, CASE WHEN l_orderkey % 9 = 0 THEN 'no such group' ELSE b.name END AS target_name, concat('order ', l_orderkey, '-', l_linenumber) AS evidence, CASE WHEN l_orderkey % 4 = 0 THEN ARR('src:order') ELSE NULL END AS source_refs, CASE WHEN l_orderkey % 5 = 0 THEN 0.7e0 ELSE NULL END AS confidence
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM @lineitem) l JOIN (SELECT pos, name FROM seed_groups) a ON l_partkey = a.pos JOIN (SELECT pos, name FROM seed_groups) b ON l_suppkey = b.pos""",
    "layout_elements": """
SELECT user_id AS doc, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_id AS id, CASE WHEN event_type = 'purchase' THEN 'image' ELSE 'text' END AS type,
  CASE event_type WHEN 'signup' THEN concat('一、', CASE event_id % 3 WHEN 0 THEN '选择题' WHEN 1 THEN '填空题' ELSE '解答题' END) WHEN 'click' THEN concat(event_id % 40 + 1, '. Question') WHEN 'error' THEN concat('(', event_id % 4, ') part') WHEN 'view' THEN CASE WHEN event_id % 5 = 0 THEN ' ' ELSE concat('Text ', event_id) END ELSE '' END AS content,
  event_id % 3 AS page, (event_id % 83) / 83e0 AS x, (event_id % 61) / 61e0 AS y, CASE WHEN event_id % 45 = 0 THEN NULL ELSE (event_id % 17) / 40e0 END AS width, (event_id % 13) / 40e0 AS height FROM @events""",
}


_AGG = re.compile(r"AGG\[\[(.*?)\|\|(.*?)\]\]", re.S)


def _needed(sql: str) -> list[str]:
    """Views that ``sql`` names, those they need first."""
    out: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            for x in [*_needed(VIEWS[name]), name]:
                if x not in out:
                    out.append(x)
    return out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    own = VIEWS[name]
    sql = own.replace("ARR(", "array(").replace("{", "{{").replace("}", "}}")
    sql = sql.replace("SHA2(url)", "sha2(url, 256)")
    sql = _AGG.sub(r"array_join(transform(array_sort(collect_list(struct(\2 AS o, \1 AS x))), e -> e.x), ',')", sql)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"@(\w+)", own))}
    sql = re.sub(r"@(\w+)", r"{\1}", sql)
    for n in VIEWS:
        if re.search(rf"FROM {n}\b", own):
            frames[n] = view(spark, sf_dir, n)
            sql = re.sub(rf"FROM {n}\b", f"FROM {{{n}}}", sql)
    return spark.sql(sql, **frames)


def duck(sql: str) -> str:
    """DuckDB SQL with the views it names in front."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in _needed(sql)]
    if parts:
        recursive = bool(re.match(r"\s*WITH RECURSIVE", sql))
        body = re.sub(r"^\s*WITH (RECURSIVE )?", ", ", sql, count=1) if re.match(r"\s*WITH ", sql) else "\n" + sql
        sql = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}{body}"
    sql = re.sub(r", (\w+) -> ", r", lambda \1: ", re.sub(r", \((\w+), (\w+)\) -> ", r", lambda \1, \2: ", sql))
    sql = sql.replace("SHA2(url)", "sha256(url)")
    sql = _AGG.sub(r"string_agg(\1, ',' ORDER BY \2)", sql)
    return re.sub(r"@(\w+)", r"\1", sql.replace("ARR(", "list_value("))
