"""Queries over the graph views: projections, filters, joins, aggregates, rules."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.operators import graph as G
from graphloom.operators import ordered as O
from graphloom.operators import product as P
from graphloom.operators import rules as R
from graphloom.plans.base import COMPACT, EDGE_ID, FT, NSLUG, REFS, SLUG, STATE, TERMS, TRIM, TXT, query
from graphloom.sources.tables import cut, work_folder

# -- filters -------------------------------------------------------------------

_PROMOTABLE = f"({STATE} <> 'rejected' AND ({STATE} = 'accepted' OR (coalesce(confidence, 0) >= 0.8 AND len(source_refs) > 0)))"


@query(f"SELECT id, pos FROM kg_candidates WHERE {_PROMOTABLE}")
def flt_promotable(v):
    return v.kg_candidates.where(G.promotable()).select("id", "pos")


@query(f"SELECT {STATE} AS state, count(*) AS n FROM kg_nodes GROUP BY ALL")
def fn_review_state(v):
    return v.kg_nodes.groupBy(G.review_state().alias("state")).agg(F.count("*").alias("n"))


def _q(x) -> str:
    return ", ".join(f"'{i}'" for i in x)


_TYPE = TRIM("type")
_DEF = COMPACT(FT("definition", "summary"))
_CHOSEN = f"{TXT('id')} IS NOT NULL AND {_TYPE} IN ({_q(P.NODE_TYPES)}) AND {STATE} IN ({_q(P.STATES)}) AND (confidence IS NULL OR confidence >= 0.3)"
_CHOSEN_E = f"source <> target AND {_TYPE} IN ({_q(P.EDGE_TYPES)}) AND {STATE} IN ({_q(P.STATES)}) AND (confidence IS NULL OR confidence >= 0.3)"


@query(f"SELECT id, type, pos FROM kg_nodes WHERE {_CHOSEN} AND {_DEF} <> ''")
def flt_export_nodes(v):
    return P.export_nodes(v.kg_nodes, least=0.3, require_definition=True).select("id", "type", "pos")


_SEMI = "source IN (SELECT id FROM kg_nodes WHERE {0}) AND target IN (SELECT id FROM kg_nodes WHERE {0})"


@query(f"SELECT id, type, source, target, pos FROM kg_edges WHERE {_CHOSEN_E} AND {_SEMI.format(_CHOSEN)}")
def flt_export_edges(v):
    return P.export_edges(v.kg_edges, P.export_nodes(v.kg_nodes, least=0.3), least=0.3).select("id", "type", "source", "target", "pos")


@query(f"SELECT {STATE} AS state, count(*) AS n FROM kg_nodes WHERE {STATE} IN ('accepted', 'draft') GROUP BY ALL")
def flt_csv_set(v):
    states = P.csv_set(" accepted ,draft,, ", P.STATES)
    return v.kg_nodes.where(G.review_state().isin(*states)).groupBy(G.review_state().alias("state")).agg(F.count("*").alias("n"))


# -- projections -----------------------------------------------------------------

_SUBJECT, _STAGE = NSLUG("subject"), NSLUG("stage", "WHEN @@ = '初中' THEN 'middle' WHEN @@ = '高中' THEN 'high' WHEN @@ = '小学' THEN 'elementary'")
_GRADE = "CASE WHEN g IS NULL THEN 0 WHEN regexp_extract(g, '(\\p{Nd}+)', 1) <> '' THEN CAST(regexp_extract(g, '(\\p{Nd}+)', 1) AS BIGINT) " + " ".join(f"WHEN contains(g, '{c}') THEN {i}" for i, c in enumerate(T.NUMERALS, 1)) + " ELSE 0 END"
_PID, _NAME = FT("ext_map", "ext_product", "id"), FT("name", "id")
_SKILLS = f"coalesce(array_to_string(list_filter(list_transform(skills, s -> {FT('s')}), (s, i) -> s <> '' AND list_position(list_transform(skills, q -> {FT('q')}), s) = i), ','), '')"
_EN = f"coalesce(list_filter(list_transform(aliases, a -> {FT('a')}), a -> regexp_full_match(a, '[A-Za-z0-9 ,;:()/_-]+'))[1], '')"
_TAG = f"list_filter(tags, t -> {TXT('t')} IS NOT NULL AND {TXT('t')} <> 'lesson-anchor')[1]"
_DOMAIN = NSLUG(f"coalesce({TXT('domain')}, {_TAG})")
_DIFF = "coalesce(TRY_CAST(difficulty AS BIGINT), 3)"
_PRODUCT = f"""products AS (SELECT {_PID} AS id, id AS internal_id, {_NAME} AS name, {_EN} AS name_en, {FT('type')} AS type, {_SUBJECT} AS subject, {_GRADE} AS grade, {_DOMAIN} AS domain, {_DIFF} AS difficulty,
 {_DEF} AS definition, {_SKILLS} AS skills, {_STAGE} AS stage, {FT('curriculum')} AS curriculum, CASE WHEN {FT('curriculum')} <> '' AND {_SUBJECT} <> '' THEN concat({FT('curriculum')}, '/', {_SUBJECT}, '.json') ELSE '' END AS tree_path, {_NAME} AS display_name, confidence, pos
 FROM (SELECT *, {TXT('grade')} AS g FROM kg_nodes) WHERE {_CHOSEN})"""


def _products(v):
    chosen = P.export_nodes(v.kg_nodes, least=0.3)
    return chosen, P.product_nodes(chosen)


@query(f"WITH {_PRODUCT} SELECT * FROM products")
def prj_product_node(v):
    return _products(v)[1]


def _column(name, spark_column, sql):
    @query(f"SELECT pos, {sql} AS value FROM kg_nodes", name)
    def one(v):
        return v.kg_nodes.select("pos", spark_column().alias("value"))


_column("prj_product_id", P.product_id, _PID)
_column("prj_definition", P.definition, _DEF)
_column("prj_skills", lambda: F.array_join(P.skills(), ","), _SKILLS)
_column("prj_name_en", P.english_name, _EN)
_column("prj_domain", P.domain, _DOMAIN)
_column("prj_difficulty", P.difficulty, _DIFF)
_column("fn_slugify", lambda: T.slugify(F.concat_ws(" / ", "name", F.element_at("aliases", 1))), SLUG("concat_ws(' / ', name, aliases[1])"))
_column("fn_first_text", lambda: T.first_text(F.col("domain"), F.col("stage"), F.col("id")), FT("domain", "stage", "id"))
_column("fn_normalize_slug", lambda: T.normalize_slug(F.col("stage"), T.STAGE_SLUGS, "none"), NSLUG("stage", "WHEN @@ = '初中' THEN 'middle' WHEN @@ = '高中' THEN 'high' WHEN @@ = '小学' THEN 'elementary'", "'none'"))
_column("fn_normalize_name", lambda: T.name_key(*(F.col(c) for c in ("subject", "stage", "curriculum", "name"))), "concat_ws('|', " + ", ".join(SLUG(f"coalesce({c}, '')") for c in ("subject", "stage", "curriculum", "name")) + ")")
_column("fn_parse_grade", lambda: T.parse_grade(F.col("grade")), _GRADE.replace("WHEN g IS", f"WHEN {TXT('grade')} IS").replace("(g,", f"({TXT('grade')},"))
_column("fn_as_list", lambda: F.size(F.coalesce("skills", F.array().cast("array<string>"))).cast("bigint"), "CAST(coalesce(len(skills), 0) AS BIGINT)")
_column("fn_page_label", lambda: T.page_label(F.col("k") % 50, F.col("k") % 50 + F.col("k") % 3), "CASE WHEN k % 3 = 0 THEN concat('PDF page ', k % 50) ELSE concat('PDF pages ', k % 50, '-', k % 50 + k % 3) END")
_column("fn_figure_number", lambda: T.figure_number(F.concat("id", F.lit(" fig "), "name")), "regexp_replace(concat(id, ' fig ', name), '[^0-9]', '', 'g')")
_column("fn_confidence", lambda: F.when(T.in_unit(T.confidence(F.col("difficulty"))), "in").otherwise("out"), "CASE WHEN TRY_CAST(difficulty AS DOUBLE) BETWEEN 0 AND 1 THEN 'in' ELSE 'out' END")


@query(f"SELECT pos, {EDGE_ID('type', 'source', 'target')} AS value FROM kg_edges WHERE source IS NOT NULL")
def fn_edge_id(v):
    return v.kg_edges.select("pos", T.edge_id(F.col("type"), F.col("source"), F.col("target")).alias("value"))


# -- joins -----------------------------------------------------------------------


@query("SELECT id, pos, CASE WHEN s THEN 'source' ELSE 'target' END AS side FROM (SELECT id, pos, unnest([true, false]) AS s, source, target FROM kg_edges) WHERE CASE WHEN s THEN source ELSE target END NOT IN (SELECT id FROM kg_nodes)")
def jn_anti_endpoint(v):
    ids = v.kg_nodes.select("id").distinct()
    return R.union(*(R.missing(v.kg_edges, end, ids).select("id", "pos", F.lit(end).alias("side")) for end in ("source", "target")))


_KNOWN = "(SELECT source_id FROM kg_sources UNION SELECT concat(source_id, '#', chunk_id) FROM kg_sources)"


@query(f"SELECT id, ref FROM (SELECT id, unnest(source_refs) AS ref FROM kg_nodes) WHERE {TRIM('ref')} <> '' AND ref NOT IN {_KNOWN}")
def jn_anti_ref(v):
    return R.unknown_refs(v.kg_nodes, v.kg_sources)


@query("SELECT id, pos FROM kg_edges WHERE source IN (SELECT id FROM kg_nodes) AND target IN (SELECT id FROM kg_nodes)")
def jn_semi_endpoint(v):
    return G.with_both_ends(v.kg_edges, v.kg_nodes).select("id", "pos")


_EDGES = f"""last AS (SELECT internal_id, arg_max(id, pos) AS pid FROM products GROUP BY 1),
looked AS (SELECT e.type, a.pid AS source, b.pid AS target, e.confidence, e.pos FROM kg_edges e JOIN last a ON a.internal_id = source JOIN last b ON b.internal_id = target WHERE {_CHOSEN_E}),
pedges AS (SELECT * FROM looked QUALIFY row_number() OVER (PARTITION BY source, target, type ORDER BY pos) = 1)"""


def _product_graph(v):
    chosen, products = _products(v)
    return products, P.product_edges(v.kg_edges, chosen, products, least=0.3)


@query(f"WITH {_PRODUCT}, {_EDGES} SELECT source, target, type, confidence, pos FROM looked")
def jn_lookup_id(v):
    chosen, products = _products(v)
    return P.looked_up(P.export_edges(v.kg_edges, chosen, least=0.3), products).select("source", "target", "type", "confidence", "pos")


@query(f"WITH {_PRODUCT}, {_EDGES} SELECT source, target, type, confidence, pos FROM pedges")
def win_first_wins_edge(v):
    return _product_graph(v)[1].select("source", "target", "type", "confidence", "pos")


_CROSS = """bysub AS (SELECT id, arg_max(subject, pos) AS s FROM products GROUP BY 1),
crossed AS (SELECT e.* FROM pedges e JOIN bysub a ON a.id = source JOIN bysub b ON b.id = target WHERE (a.s = 'science' AND b.s NOT IN ('', 'science')) OR (b.s = 'science' AND a.s NOT IN ('', 'science')))"""


@query(f"WITH {_PRODUCT}, {_EDGES}, {_CROSS} SELECT type, count(*) AS n FROM crossed GROUP BY 1")
def jn_cross_subject(v):
    products, edges = _product_graph(v)
    return P.cross_subject(edges, products).groupBy("type").agg(F.count("*").alias("n"))


@query(f"""WITH {_PRODUCT}, {_EDGES}, {_CROSS},
 bs AS (SELECT string_agg(concat(v, ':', n), ',' ORDER BY v) AS by_subject FROM (SELECT coalesce(subject, '') AS v, count(*) AS n FROM products GROUP BY 1)),
 bg AS (SELECT string_agg(concat(v, ':', n), ',' ORDER BY v) AS by_grade FROM (SELECT coalesce(CAST(grade AS VARCHAR), '') AS v, count(*) AS n FROM products GROUP BY 1))
SELECT t.*, total_nodes - cn_unified AS international, (SELECT count(*) FROM pedges) AS total_edges, (SELECT count(*) FROM crossed) AS sci_cross_edges, by_subject, by_grade
FROM (SELECT count(*) AS total_nodes, count(*) FILTER (curriculum = 'cn-unified') AS cn_unified, count(*) FILTER (subject = 'science' AND stage = 'elementary') AS sci_elementary FROM products) t, bs, bg""")
def agg_product_stats(v):
    products, edges = _product_graph(v)
    return P.product_stats(products, edges)


@query(f"WITH {_PRODUCT}, {_EDGES} SELECT kind, a, b, rank FROM (SELECT 'node' AS kind, id AS a, internal_id AS b, row_number() OVER (ORDER BY id, pos) AS rank FROM products UNION ALL SELECT 'edge', source, target, row_number() OVER (ORDER BY source, target, pos) FROM pedges)")
def srt_product(v):
    products, edges = _product_graph(v)

    folder = work_folder(v.spark)

    def placed(df, kind, a, b, *order):
        rows = df.select(F.lit(kind).alias("kind"), F.col(a).alias("a"), F.col(b).alias("b"), "pos")
        return O.ranked(rows, lambda t, name: cut(t, f"{kind}_{name}", folder), *order).drop("pos")

    return placed(products, "node", "id", "internal_id", "a", "pos").unionByName(placed(edges, "edge", "source", "target", "a", "b", "pos"))


# -- aggregates and sets -----------------------------------------------------------


@query("SELECT id, count(*) AS n FROM kg_nodes WHERE coalesce(id, '') <> '' GROUP BY 1 HAVING count(*) > 1")
def agg_dup_values(v):
    return R.duplicate_values(v.kg_nodes)


_KEY = "concat_ws('|', " + ", ".join(SLUG(f"coalesce({c}, '')") for c in ("subject", "stage", "curriculum", "name")) + ")"


@query(f"SELECT {_KEY} AS name_key, string_agg(id, ', ' ORDER BY pos, id) AS ids, count(*) AS n FROM kg_nodes GROUP BY 1 HAVING count(*) > 1")
def agg_dup_name(v):
    return R.duplicate_names(v.kg_nodes)


@query("SELECT kind, type, count(*) AS n, min(pos) AS first_pos FROM (SELECT 'node' AS kind, type, pos FROM kg_nodes UNION ALL SELECT 'edge', type, pos FROM kg_edges) GROUP BY 1, 2")
def agg_type_counts(v):
    both = v.kg_nodes.select(F.lit("node").alias("kind"), "type", "pos").unionByName(v.kg_edges.select(F.lit("edge").alias("kind"), "type", "pos"))
    return both.groupBy("kind", "type").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


@query(f"SELECT coalesce(nullif({STATE}, ''), 'unspecified') AS state, count(*) AS n FROM (SELECT review_state FROM kg_nodes UNION ALL SELECT review_state FROM kg_edges) GROUP BY 1")
def agg_review_counts(v):
    both = v.kg_nodes.select("review_state").unionByName(v.kg_edges.select("review_state"))
    return both.groupBy(F.coalesce(F.nullif(G.review_state(), F.lit("")), F.lit("unspecified")).alias("state")).agg(F.count("*").alias("n"))


@query("SELECT source, target, count(*) AS n FROM kg_edges GROUP BY ALL HAVING count(*) > 1")
def agg_dup_pairs(v):
    return v.kg_edges.groupBy("source", "target").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT DISTINCT id FROM kg_nodes WHERE id NOT IN (SELECT source FROM kg_edges UNION SELECT target FROM kg_edges)")
def agg_orphans(v):
    return G.orphans(v.kg_nodes, v.kg_edges)


@query("SELECT id FROM kg_nodes EXCEPT SELECT source FROM kg_edges", "set_except")
def set_except(v):
    return v.kg_nodes.select("id").exceptAll(v.kg_nodes.select("id").limit(0)).distinct().subtract(v.kg_edges.select(F.col("source").alias("id")))


@query("SELECT source AS id FROM kg_edges UNION SELECT target FROM kg_edges")
def set_union_endpoints(v):
    return G.endpoints(v.kg_edges).distinct()


@query("SELECT id, count(*) AS degree FROM (SELECT source AS id FROM kg_edges WHERE type <> 'part_of' UNION ALL SELECT target FROM kg_edges WHERE type <> 'part_of') GROUP BY 1")
def gr_degree_semantic(v):
    return G.degrees(v.kg_edges.where("type <> 'part_of'"))


@query("SELECT DISTINCT id FROM kg_nodes WHERE id NOT IN (SELECT source FROM kg_edges WHERE type = 'part_of' UNION SELECT target FROM kg_edges WHERE type = 'part_of')")
def gr_orphans(v):
    return G.orphans(v.kg_nodes, v.kg_edges.where("type = 'part_of'"))


@query("SELECT id, pos FROM kg_nodes QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) > 1")
def win_dup_flag(v):
    return R.later_occurrences(v.kg_nodes).select("id", "pos")


@query("SELECT id, pos, row_number() OVER (PARTITION BY type ORDER BY pos, id) AS ordinal FROM kg_nodes")
def win_order_index(v):
    return v.kg_nodes.select("id", "pos", F.row_number().over(W.partitionBy("type").orderBy("pos", "id")).cast("bigint").alias("ordinal"))


@query(f"SELECT kind, id, rank FROM (SELECT 'review' AS kind, id, row_number() OVER (ORDER BY pos) AS rank FROM kg_nodes WHERE {STATE} IN ('needs_review', 'draft')) WHERE rank <= 20")
def lim_heads(v):
    top = v.kg_nodes.where(G.review_state().isin("needs_review", "draft")).orderBy("pos").limit(20)
    return top.select(F.lit("review").alias("kind"), "id", F.row_number().over(W.orderBy("pos")).cast("bigint").alias("rank"))


# -- search ------------------------------------------------------------------------

_SEARCH = "red widget 7 brand#1"
_HAY = "lower(concat_ws(' ', id, type, name, definition, summary, subject, stage, curriculum, array_to_string(aliases, ' '), array_to_string(tags, ' '), array_to_string(source_refs, ' ')))"
_HAY_E = "lower(concat_ws(' ', id, type, evidence, reason, array_to_string(source_refs, ' ')))"


def _hay():
    lists = [F.array_join(c, " ") for c in ("aliases", "tags", "source_refs")]
    return F.lower(F.concat_ws(" ", "id", "type", "name", "definition", "summary", "subject", "stage", "curriculum", *lists))


_column("fn_searchable_text", _hay, _HAY)
_column("fn_term_count", lambda: T.search_score(_hay(), _SEARCH), TERMS(_HAY, _SEARCH))


@query(f"SELECT * FROM (SELECT 'node' AS kind, id, {TERMS(_HAY, _SEARCH)} AS score, pos FROM kg_nodes UNION ALL SELECT 'edge', id, {TERMS(_HAY_E, _SEARCH)}, pos FROM kg_edges) WHERE score > 0 ORDER BY score DESC, kind, id, pos LIMIT 10")
def srt_search_topk(v):
    edge_hay = F.lower(F.concat_ws(" ", "id", "type", "evidence", "reason", F.array_join("source_refs", " ")))
    nodes = v.kg_nodes.select(F.lit("node").alias("kind"), "id", T.search_score(_hay(), _SEARCH).alias("score"), "pos")
    edges = v.kg_edges.select(F.lit("edge").alias("kind"), "id", T.search_score(edge_hay, _SEARCH).alias("score"), "pos")
    return nodes.unionByName(edges).where("score > 0").orderBy(F.desc("score"), "kind", "id", "pos").limit(10)


# -- merging, neighbourhoods, cycles ---------------------------------------------------

_MERGE = f"""
ncand AS (SELECT c.*, n.id IS NOT NULL AS have, {_PROMOTABLE} AS ok FROM kg_candidates c LEFT JOIN (SELECT DISTINCT id FROM kg_nodes) n USING (id)),
nout AS (SELECT id, pos, CASE WHEN have THEN 'exists' WHEN NOT ok THEN 'not_promotable' WHEN row_number() OVER (PARTITION BY id, (NOT have AND ok) ORDER BY pos) > 1 THEN 'exists' ELSE 'added' END AS outcome FROM ncand),
known AS (SELECT id FROM kg_nodes UNION SELECT id FROM nout WHERE outcome = 'added'),
ecand AS (SELECT * REPLACE (CASE WHEN id = '' THEN {EDGE_ID('type', 'source', 'target')} ELSE id END AS id) FROM kg_edge_candidates),
ejud AS (SELECT *, id IN (SELECT id FROM kg_edges) AS have, source IN (SELECT id FROM known) AND target IN (SELECT id FROM known) AS ends, {_PROMOTABLE} AS ok FROM ecand),
eout AS (SELECT id, pos, CASE WHEN have THEN 'exists' WHEN NOT ends THEN 'endpoint_missing' WHEN NOT ok THEN 'not_promotable' WHEN row_number() OVER (PARTITION BY id, (NOT have AND ends AND ok) ORDER BY pos) > 1 THEN 'exists' ELSE 'added' END AS outcome FROM ejud)"""


@query(f"WITH {_MERGE} SELECT 'node' AS entity, * FROM nout UNION ALL SELECT 'edge', * FROM eout")
def gr_merge(v):
    return G.merge(v.kg_nodes, v.kg_edges, v.kg_candidates, v.kg_edge_candidates)


@query(f"WITH {_MERGE} SELECT count(*) AS n FROM kg_candidates c WHERE id NOT IN (SELECT id FROM kg_nodes)")
def jn_merge_anti(v):
    return v.kg_candidates.join(v.kg_nodes.select("id").distinct(), "id", "left_anti").agg(F.count("*").alias("n"))


_CENTER = "nation:3"
_BFS = f"""WITH RECURSIVE steps AS (SELECT source AS a, target AS b FROM kg_edges UNION SELECT target, source FROM kg_edges),
walk(id, depth) AS (SELECT id, 0 FROM (SELECT DISTINCT id FROM kg_nodes WHERE id = '{_CENTER}') UNION SELECT s.b, w.depth + 1 FROM walk w JOIN steps s ON s.a = w.id WHERE w.depth < 2 AND s.b IN (SELECT id FROM kg_nodes)),
reached AS (SELECT id, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY 1)"""


@query(f"{_BFS} SELECT * FROM reached")
def gr_bfs_extract(v):
    return G.neighbourhood(v.kg_nodes, v.kg_edges, _CENTER, 2)


@query(f"{_BFS}, sel AS (SELECT source_refs FROM kg_nodes WHERE id IN (SELECT id FROM reached) UNION ALL SELECT source_refs FROM kg_edges WHERE source IN (SELECT id FROM reached) AND target IN (SELECT id FROM reached)) SELECT DISTINCT split_part(r, '#', 1) AS source_id FROM (SELECT unnest({REFS()}) AS r FROM sel)")
def gr_bfs_sources(v):
    reached = G.neighbourhood(v.kg_nodes, v.kg_edges, _CENTER, 2)
    return G.referenced_sources(v.kg_nodes.join(reached.select("id"), "id", "left_semi"), G.induced(v.kg_edges, reached))


_CYCLES = """WITH RECURSIVE e AS (SELECT DISTINCT source, target FROM kg_requires),
walk(start, path, cur) AS (SELECT source, [source], target FROM e WHERE source <= target UNION ALL SELECT start, list_append(path, w.cur), e.target FROM walk w JOIN e ON e.source = w.cur WHERE w.cur <> w.start AND NOT list_contains(path, w.cur) AND e.target >= w.start)
SELECT concat(array_to_string(path, ' -> '), ' -> ', start) AS cycle, CAST(len(path) AS BIGINT) AS length FROM walk WHERE cur = start"""


@query(_CYCLES)
def gr_cycle(v):
    return G.simple_cycles(v.kg_requires)


def WALKS(edges, more=""):
    """All pairs with a way from the first to the second over ``requires`` edges."""
    return f"""WITH RECURSIVE req AS (SELECT DISTINCT source, target FROM {edges} WHERE type = 'requires'{more}),
way(a, b) AS (SELECT source, target FROM req UNION SELECT w.a, e.target FROM way w JOIN req e ON e.source = w.b)"""


def WITNESS(edges, more=""):
    """``ring(k, id)``: in the cyclic core every node takes its least target; of the rings that these make, that with the least node, from there on."""
    return f"""{WALKS(edges, more)}, loop AS (SELECT a AS id FROM way WHERE a = b), after AS (SELECT id FROM loop UNION SELECT b FROM way WHERE a IN (SELECT id FROM loop)), before AS (SELECT id FROM loop UNION SELECT a FROM way WHERE b IN (SELECT id FROM loop)),
nxt AS (SELECT source AS a, min(target) AS b FROM req WHERE source IN (SELECT id FROM after) AND target IN (SELECT id FROM before) AND source IN (SELECT id FROM before) AND target IN (SELECT id FROM after) GROUP BY 1),
fw(a, b) AS (SELECT a, b FROM nxt UNION SELECT fw.a, nxt.b FROM fw JOIN nxt ON nxt.a = fw.b),
ring(k, id) AS (SELECT 0, min(a) FROM fw WHERE a = b UNION ALL SELECT ring.k + 1, nxt.b FROM ring JOIN nxt ON nxt.a = ring.id WHERE nxt.b <> (SELECT min(a) FROM fw WHERE a = b))"""


@query(f"{WITNESS('kg_edges', ' AND source <> target')} SELECT CAST(k AS BIGINT) AS pos, id FROM ring WHERE id IS NOT NULL")
def gr_cycle_witness(v):
    return G.cycle_nodes(v.kg_edges.where("type = 'requires' and source <> target"))


#: The 4-cycle of the view and the trees that hang on it are all there is: only the former stays.
@query(f"{WALKS('kg_edges')}, loop AS (SELECT a AS id FROM way WHERE a = b), after AS (SELECT id FROM loop UNION SELECT b FROM way WHERE a IN (SELECT id FROM loop)), before AS (SELECT id FROM loop UNION SELECT a FROM way WHERE b IN (SELECT id FROM loop)) SELECT source, target FROM req WHERE source IN (SELECT id FROM after) AND target IN (SELECT id FROM before)")
def gr_cycle_core(v):
    return G.cyclic_core(v.kg_edges.where("type = 'requires'"))


# -- rules ---------------------------------------------------------------------------


def _row(rule, severity, entity, where, table, detail="''", id_="coalesce(id, '')"):
    return f"SELECT '{rule}' AS rule, '{severity}' AS severity, '{entity}' AS entity, {id_} AS id, CAST(coalesce({detail}, '') AS VARCHAR) AS detail FROM {table} WHERE {where}"


_NOCONF = "confidence IS NULL"
_RANGE = "(confidence < 0 OR confidence > 1)"
_BADSTATE = f"{STATE} NOT IN ('', {_q(R.REVIEW_STATES)})"
_CONFTXT = "CASE WHEN confidence = floor(confidence) THEN concat(CAST(CAST(confidence AS BIGINT) AS VARCHAR), '.0') ELSE CAST(confidence AS VARCHAR) END"


def _common(entity, table):
    return [
        _row("invalid_review_state", "E", entity, _BADSTATE, table, STATE),
        _row("missing_confidence", "E", entity, _NOCONF, table),
        _row("confidence_range", "E", entity, _RANGE, table, _CONFTXT),
    ]


def _node_rules(table, refs_rule):
    return [
        _row("missing_id", "E", "node", "coalesce(id, '') = ''", table),
        _row("invalid_type", "E", "node", f"coalesce(type, '') NOT IN ({_q(R.NODE_TYPES)})", table, "type"),
        _row("missing_name", "E", "node", f"{TXT('name')} IS NULL", table),
        *_common("node", table),
        _row("missing_refs", "E", "node", refs_rule, table),
    ]


def _edge_rules(table, types=R.EDGE_TYPES, reason=True):
    return [
        _row("missing_id", "E", "edge", "coalesce(id, '') = ''", table),
        _row("invalid_type", "E", "edge", f"coalesce(type, '') NOT IN ({_q(types)})", table, "type"),
        _row("self_loop", "E", "edge", "source = target", table, "source"),
        _row("no_evidence", "E", "edge", f"{TXT('evidence')} IS NULL" + (f" AND {TXT('reason')} IS NULL" if reason else ""), table),
        _row("missing_refs", "E", "edge", f"len({REFS()}) = 0", table),
        *_common("edge", table),
    ]


def _dup(entity, table):
    return f"SELECT 'duplicate_id', 'E', '{entity}', id, '' FROM {table} WHERE coalesce(id, '') <> '' GROUP BY id HAVING count(*) > 1"


def _later(entity, table, order="pos"):
    return f"SELECT 'duplicate_id', 'E', '{entity}', id, '' FROM (SELECT id FROM {table} WHERE coalesce(id, '') <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) > 1)"


def _ends(edges, nodes, id_="coalesce(id, '')"):
    return [_row(f"{end}_missing", "E", "edge", f"{end} NOT IN (SELECT id FROM {nodes} WHERE id IS NOT NULL)", edges, end, id_) for end in ("source", "target")]


def _unknown(entity, table):
    return f"SELECT 'unknown_ref', 'W', '{entity}', id, ref FROM (SELECT id, unnest(source_refs) AS ref FROM {table}) WHERE {TRIM('ref')} <> '' AND ref NOT IN {_KNOWN}"


_VAL_KG = " UNION ALL ".join([
    *_node_rules("kg_nodes", f"coalesce(type, '') <> 'source_chunk' AND len({REFS()}) = 0"),
    *_edge_rules("kg_edges"),
    _row("accepted_related_to", "W", "edge", f"type = 'related_to' AND {STATE} = 'accepted'", "kg_edges"),
    _dup("node", "kg_nodes"), _dup("edge", "kg_edges"), *_ends("kg_edges", "kg_nodes"), _unknown("node", "kg_nodes"), _unknown("edge", "kg_edges"),
    f"SELECT 'duplicate_name', 'W', 'node', {_KEY}, string_agg(id, ', ' ORDER BY pos, id) FROM kg_nodes GROUP BY {_KEY} HAVING count(*) > 1",
    f"SELECT 'requires_cycle', 'E', 'graph', '', concat(string_agg(id, ' -> ' ORDER BY k), ' -> ', arg_min(id, k)) FROM ({WITNESS('kg_edges')} SELECT k, id FROM ring WHERE id IS NOT NULL) HAVING count(*) > 0",
])


def _val_kg(v):
    return R.validate_graph(v.kg_nodes, v.kg_edges, v.kg_sources, G.requires_cycle(v.kg_edges))


@query(_VAL_KG)
def val_kg(v):
    return _val_kg(v)


@query(f"SELECT count(*) FILTER (severity = 'E') AS error_count, count(*) FILTER (severity = 'W') AS warning_count, count(*) FILTER (severity = 'E') = 0 AS valid FROM ({_VAL_KG})")
def val_kg_summary(v):
    return R.summary(_val_kg(v))


@query(f"SELECT id, pos FROM kg_nodes WHERE NOT EXISTS (SELECT 1 FROM ({_VAL_KG}) WHERE severity = 'E')")
def cmd_export_gate(v):
    return R.gate(v.kg_nodes.select("id", "pos"), _val_kg(v))


@query(" UNION ALL ".join([
    *_node_rules("kg_candidates", f"len({REFS()}) = 0"),
    _row("invalid_type", "E", "edge", f"coalesce(type, '') NOT IN ({_q(R.EDGE_TYPES)})", "kg_edge_candidates", "type"),
    _row("missing_end", "E", "edge", f"{TXT('source')} IS NULL OR {TXT('target')} IS NULL", "kg_edge_candidates"),
    _row("self_loop", "E", "edge", "source = target", "kg_edge_candidates", "source"),
    _row("missing_refs", "E", "edge", f"len({REFS()}) = 0", "kg_edge_candidates"),
    *_common("edge", "kg_edge_candidates"),
    _row("related_to_unreviewed", "W", "edge", f"coalesce(type, '') = 'related_to' AND {STATE} <> 'needs_review'", "kg_edge_candidates"),
    _later("node", "kg_candidates"), _later("edge", "kg_edge_candidates"),
]))
def val_candidates(v):
    return R.validate_candidates(v.kg_candidates, v.kg_edge_candidates)


_PNAME = "concat_ws('->', source, target)"


@query(f"WITH {_PRODUCT}, {_EDGES} " + " UNION ALL ".join([
    _row("missing_id", "E", "node", f"{TXT('id')} IS NULL", "products"),
    _row("missing_name", "E", "node", f"{TXT('name')} IS NULL", "products"),
    _row("missing_grade", "E", "node", "grade IS NULL", "products"),
    _row("empty_definition", "W", "node", f"{TXT('definition')} IS NULL", "products"),
    _later("node", "products"),
    _row("self_loop", "E", "edge", "source = target", "looked", "''", _PNAME),
    _row("confidence_range", "E", "edge", _RANGE, "looked", _CONFTXT, _PNAME),
    *_ends("looked", "products", _PNAME),
    f"SELECT 'duplicate_edge', 'E', 'edge', {_PNAME}, type FROM (SELECT * FROM looked QUALIFY row_number() OVER (PARTITION BY source, target, type ORDER BY pos) > 1)",
]))
def val_product(v):
    chosen, products = _products(v)
    return R.validate_product(products, P.looked_up(P.export_edges(v.kg_edges, chosen, least=0.3), products))


# -- report ----------------------------------------------------------------------------


@query(f"""SELECT line_no, line FROM (
SELECT 1 AS line_no, '# KG Report' AS line UNION ALL SELECT 2, concat('- Nodes: ', (SELECT count(*) FROM kg_nodes)) UNION ALL SELECT 3, concat('- Edges: ', (SELECT count(*) FROM kg_edges))
UNION ALL SELECT 100 + row_number() OVER (ORDER BY n DESC, p), concat('- `', type, '`: ', n) FROM (SELECT type, count(*) AS n, min(pos) AS p FROM kg_nodes GROUP BY 1)
UNION ALL SELECT 200 + row_number() OVER (ORDER BY n DESC, p), concat('- `', type, '`: ', n) FROM (SELECT type, count(*) AS n, min(pos) AS p FROM kg_edges GROUP BY 1)
UNION ALL SELECT 300, concat('- Nodes needing review/draft: ', count(*)) FROM kg_nodes WHERE {STATE} IN ('needs_review', 'draft')
UNION ALL SELECT 300 + r, concat('  - node `', id, '`: ', name) FROM (SELECT id, name, row_number() OVER (ORDER BY pos) AS r FROM kg_nodes WHERE {STATE} IN ('needs_review', 'draft')) WHERE r <= 20
UNION ALL SELECT 400, concat('- Orphan nodes: ', count(*)) FROM (SELECT DISTINCT id FROM kg_nodes WHERE id NOT IN (SELECT source FROM kg_edges UNION SELECT target FROM kg_edges))
UNION ALL SELECT 400 + r, concat('  - `', id, '`') FROM (SELECT id, row_number() OVER (ORDER BY id) AS r FROM (SELECT DISTINCT id FROM kg_nodes WHERE id NOT IN (SELECT source FROM kg_edges UNION SELECT target FROM kg_edges))) WHERE r <= 30)""")
def snk_report_md(v):
    from graphloom.sources.documents import report

    return report(v.kg_nodes, v.kg_edges)
