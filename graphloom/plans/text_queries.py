"""Queries over documents, ordered lines and layout elements."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import text as T
from graphloom.operators import curriculum as C
from graphloom.operators import grading as Q
from graphloom.operators import layout as L
from graphloom.operators import ordered as O
from graphloom.plans.base import COMPACT, SLUGB, TRIM, query
from graphloom.sources import documents as D

# -- blocks, chunks, lines ---------------------------------------------------------

_CLEANLINE = TRIM(r"regexp_replace(b, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')")
_BLOCKS = f"blocks AS (SELECT doc_id, pos, {_CLEANLINE} AS t FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS b, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents) WHERE {_CLEANLINE} <> '')"


def _blocks(v):
    rows = v.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "t"))
    return rows.withColumn("t", T.clean_text(F.col("t"))).where("t <> ''")


@query(f"WITH {_BLOCKS} SELECT doc_id, CAST(pos AS BIGINT) AS pos, length(t) AS n FROM blocks")
def fn_md_blocks(v):
    return _blocks(v).select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.length("t").cast("bigint").alias("n"))


_PACK = f"""WITH RECURSIVE {_BLOCKS}, b AS (SELECT doc_id, pos, t, length(t) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM blocks),
fold(doc_id, r, chunk, size) AS (SELECT doc_id, r, CAST(1 AS BIGINT), CAST(n AS BIGINT) FROM b WHERE r = 1 UNION ALL SELECT b.doc_id, b.r, CASE WHEN f.size + b.n > 1800 THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN f.size + b.n > 1800 THEN b.n ELSE f.size + b.n END FROM fold f JOIN b ON b.doc_id = f.doc_id AND b.r = f.r + 1),
packed AS (SELECT b.doc_id, chunk, CAST(min(pos) AS BIGINT) AS first, CAST(max(pos) AS BIGINT) AS last, count(*) AS n_blocks, CAST(sum(n) AS BIGINT) AS n_chars, string_agg(t, chr(10) || chr(10) ORDER BY pos) AS text FROM fold f JOIN b ON b.doc_id = f.doc_id AND b.r = f.r GROUP BY b.doc_id, chunk)"""


def _chunks(v):
    return O.chunks(v.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "t")), "doc_id", "pos", "t")


@query(f"{_PACK} SELECT * FROM packed")
def win_chunk_pack(v):
    return _chunks(v)


@query(f"{_PACK} SELECT doc_id, chunk, concat('src:', doc_id, '#chunk-', lpad(chunk::VARCHAR, greatest(3, length(chunk::VARCHAR))::INTEGER, '0')) AS source_ref, concat('pdf-pages:', first, '-', last) AS locator FROM packed")
def src_pdf_lesson(v):
    return _chunks(v).select("doc_id", "chunk", F.concat(F.lit("src:"), F.col("doc_id").cast("string"), F.format_string("#chunk-%03d", "chunk")).alias("source_ref"), F.concat(F.lit("pdf-pages:"), F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string")).alias("locator"))


_C220 = f"CASE WHEN length({COMPACT('text')}) > 220 THEN concat(regexp_replace(substr({COMPACT('text')}, 1, 219), '[\\s\\p{{Z}}]+$', ''), '…') ELSE {COMPACT('text')} END"


@query(f"{_PACK} SELECT concat('node:', doc_id, '-', chunk) AS id, 'source_chunk' AS type, {_C220} AS summary, concat('src:docs#', doc_id, '-', chunk) AS source_ref, 1.0e0 AS confidence, 'draft' AS review_state, 'extract_concepts,check_evidence' AS tasks FROM packed")
def src_lesson_candidates(v):
    chunked = _chunks(v).withColumn("chunk_id", F.concat_ws("-", "doc_id", "chunk"))
    return D.lesson_candidates(chunked, "src:docs").withColumn("tasks", F.array_join("tasks", ","))


@query(f"{_PACK}, s AS (SELECT lang, length(text) AS n FROM packed JOIN documents USING (doc_id)) SELECT lang, count(*) AS chunks, count(*) FILTER (n <= 24) AS short_chunks, round(avg(n), 1) AS avg_chars, min(n) AS min_chars, max(n) AS max_chars FROM s GROUP BY 1".replace("length(text) AS n FROM packed", "length(packed.text) AS n FROM packed"))
def agg_lesson_summary(v):
    return O.lesson_summary(_chunks(v).join(v.documents.select("doc_id", "lang"), "doc_id"), "lang")


@query(f"{_PACK}, s AS (SELECT source AS backend, length(packed.text) AS n FROM packed JOIN documents USING (doc_id)) SELECT backend, count(*) AS chunks, count(*) FILTER (n <= 24) AS short_chunks, round(avg(n), 1) AS avg_chars, min(n) AS min_chars, max(n) AS max_chars, '' AS error FROM s GROUP BY 1 UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, NULL, 'no such backend'")
def src_compare_backends(v):
    ran = O.lesson_summary(_chunks(v).join(v.documents.select("doc_id", F.col("source").alias("backend")), "doc_id"), "backend").withColumn("error", F.lit(""))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in ran.schema.fields[1:-1]]
    failed = v.spark.range(1).select(F.lit("broken").alias("backend"), *none, F.lit("no such backend").alias("error"))
    return ran.unionByName(failed)


@query(f"SELECT doc_id, concat('c', lpad(i::VARCHAR, greatest(3, length(i::VARCHAR))::INTEGER, '0')) AS chunk_id, concat('paragraph:', i) AS locator, md5(substr(t, 1, 1200)) AS text_md5 FROM (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM (WITH {_BLOCKS} SELECT * FROM blocks))")
def src_text_ingest(v):
    spaced = v.documents.withColumn("text", F.regexp_replace("text", "\n", "\n\n"))
    return D.ingested(spaced, "doc_id", "text").select("doc_id", "chunk_id", "locator", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"SELECT doc_id, concat('c', lpad(i::VARCHAR, greatest(3, length(i::VARCHAR))::INTEGER, '0')) AS chunk_id, length(substr(t, 1, 1200)) AS n FROM (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM (WITH {_BLOCKS} SELECT * FROM blocks))")
def fn_text_chunks(v):
    spaced = v.documents.withColumn("text", F.regexp_replace("text", "\n", "\n\n"))
    return D.ingested(spaced, "doc_id", "text").select("doc_id", "chunk_id", F.length("text").cast("bigint").alias("n"))


def _text(name, spark_column, sql):
    @query(f"SELECT doc_id, md5({sql}) AS value FROM documents", name)
    def one(v):
        return v.documents.select("doc_id", F.md5(spark_column(F.col("text")).cast("binary")).alias("value"))


_LINES = f"list_transform(string_split(regexp_replace(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '\\r\\n?', chr(10), 'g'), chr(10)), l -> {TRIM('l')})"
_CLEAN = TRIM(f"regexp_replace(array_to_string({_LINES}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')")
_SPACES = TRIM(r"regexp_replace(regexp_replace(translate(text, '　', ' '), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")
_text("fn_clean_text", T.clean_text, _CLEAN)
_text("win_collapse_blank", lambda c: T.clean_text(F.regexp_replace(c, "\n", "\n \n\n ")), _CLEAN.replace("regexp_replace(text,", "regexp_replace(replace(text, chr(10), chr(10) || ' ' || chr(10) || chr(10) || ' '),"))
_text("fn_compact_text", lambda c: T.compact_text(c, 220), _C220)
_text("fn_compact_spaces", T.compact_spaces, _SPACES)


def _fixed(x):
    out = TRIM(x)
    for a, b in T.OCR_FIXES:
        out = f"replace({out}, '{a}', '{b}')"
    return _SPACES.replace("translate(text,", f"translate({out},")


_text("fn_ocr_fixups", lambda c: T.ocr_fixups(F.concat(F.lit("（FR王"), c, F.lit("）Cl)Bil【教学提示了】"))), _fixed("concat('（FR王', text, '）Cl)Bil【教学提示了】')"))

_RAW = r"raw AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, b FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\r\n|[\n\r]')) AS b, unnest(range(0, len(regexp_split_to_array(text, '\r\n|[\n\r]')))) AS pos FROM documents))"
_NOISE = r"(line = '' OR regexp_full_match(line, '\p{Nd}{1,3}') OR (contains(line, '义务教育') AND contains(line, '课程标准')) OR starts_with(line, '四、课程内容') OR line IN ('续表', '===') OR regexp_full_match(line, '[|_=\-—\s\p{Z}]+'))"
_DLINES = f"dlines AS (SELECT doc_id, pos, {_fixed('b')} AS line FROM raw)"


def _doc_lines(v):
    return D.lines(v.documents, "doc_id", "text")


@query(f"WITH {_RAW}, {_DLINES} SELECT doc_id, pos, md5(line) AS line_md5 FROM dlines WHERE NOT {_NOISE}", "src_page_cache")
@query(f"WITH {_RAW}, {_DLINES} SELECT doc_id, pos, md5(line) AS line_md5 FROM dlines WHERE NOT {_NOISE}", "flt_noise_line")
def _noise(v):
    return _doc_lines(v).select("doc_id", "pos", F.md5(F.col("line").cast("binary")).alias("line_md5"))


def _CLEANED(x, most):
    a = _SPACES.replace("translate(text,", f"translate({x},")
    a = rf"regexp_replace({a}, '^\(?[\s\p{{Z}}]*[0-9]{{1,2}}[\s\p{{Z}}]*\)[\s\p{{Z}}]*', '')"
    a = rf"regexp_replace(regexp_replace({a}, '例[\s\p{{Z}}]*\p{{Nd}}+', '', 'g'), '[\s\p{{Z}}]+', '', 'g')"
    return f"replace(replace({a}, '。;', '。'), ';。', '。')"


def _CUT(s, most):
    h = f"substr({s}, 1, {most})"
    at = lambda m: f"CASE WHEN contains({h}, '{m}') THEN length({h}) - strpos(reverse({h}), '{m}') ELSE -1 END"
    whens = " ".join(f"WHEN ({at(m)}) >= 60 THEN substr({h}, 1, ({at(m)}) + 1)" for m in "。；;")
    return f"CASE WHEN length({s}) <= {most} THEN {s} {whens} ELSE concat(regexp_replace({h}, '[，,、]+$', ''), '。') END"


_ITEMS = f"""WITH {_BLOCKS}, m AS (SELECT doc_id, pos, t, sum(CASE WHEN regexp_matches(t, '^\\(?[\\s\\p{{Z}}]*([0-9]{{1,2}})[\\s\\p{{Z}}]*\\)') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS item FROM blocks),
j AS (SELECT doc_id, item, string_agg(t, chr(10) ORDER BY pos) AS t FROM m GROUP BY 1, 2), s AS (SELECT doc_id, item, {_CLEANED('t', 180)} AS s FROM j),
e AS (SELECT doc_id, item, {_CUT('s', 180)} AS statement FROM s), good AS (SELECT * FROM e WHERE length(statement) >= 8),
w AS (SELECT doc_id, {_CLEANED('t', 220)} AS s FROM (SELECT doc_id, string_agg(t, chr(10) ORDER BY pos) AS t FROM blocks WHERE doc_id NOT IN (SELECT doc_id FROM good) GROUP BY 1)),
wc AS (SELECT doc_id, {_CUT('s', 220)} AS t FROM w), sl AS (SELECT doc_id, i AS item, substr(t, i * 180 + 1, 180) AS s FROM (SELECT doc_id, t, unnest(range(0, CAST(floor((length(t) - 1) / 180) AS BIGINT) + 1)) AS i FROM wc WHERE length(t) > 0)),
al AS (SELECT doc_id, item, statement FROM good UNION ALL SELECT doc_id, item, concat(regexp_replace(s, '[，,、]+$', ''), CASE WHEN ends_with(s, '。') THEN '' ELSE '。' END) FROM sl WHERE length(s) >= 8)"""


@query(f"{_ITEMS} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY item) AS n, md5(statement) AS value FROM al")
def win_item_split(v):
    return O.items(_blocks(v), "doc_id", "pos", "t").select("doc_id", "n", F.md5(F.col("statement").cast("binary")).alias("value"))


@query(f"WITH {_BLOCKS}, s AS (SELECT doc_id, pos, {_CLEANED('t', 180)} AS s FROM blocks), c AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, {_CUT('s', 180)} AS st FROM s) SELECT doc_id, pos, md5(st) AS value FROM c WHERE length(st) >= 8", "fn_clean_statement")
@query(f"WITH {_BLOCKS}, s AS (SELECT doc_id, pos, {_CLEANED('t', 180)} AS s FROM blocks), c AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, {_CUT('s', 180)} AS st FROM s) SELECT doc_id, pos, md5(st) AS value FROM c WHERE length(st) >= 8", "flt_min_len")
def _statements(v):
    own = _blocks(v).select("doc_id", F.col("pos").cast("bigint").alias("pos"), T.clean_statement(F.col("t")).alias("s"))
    return own.where(F.length("s") >= 8).select("doc_id", "pos", F.md5(F.col("s").cast("binary")).alias("value"))


_SN = "regexp_replace(regexp_replace(t, '[。；;.].*$', '', 's'), '^[，,、:： ]+|[，,、:： ]+$', '', 'g')".replace("[。；;.]", "[。；;]")


@query(f"WITH {_BLOCKS} SELECT doc_id, CAST(pos AS BIGINT) AS pos, concat('内容要求：', CASE WHEN length({_SN}) > 26 THEN regexp_replace(substr({_SN}, 1, 26), '[，,、]+$', '') ELSE {_SN} END) AS value FROM blocks")
def fn_statement_name(v):
    return _blocks(v).select("doc_id", F.col("pos").cast("bigint").alias("pos"), T.statement_name(F.col("t"), F.lit("内容要求：")).alias("value"))


_WORDS = ("the", "and", "que", "la", "von", "ist", "idiot", "license", "password", "www")


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"'{w}'" for w in _WORDS) + "], w -> contains(lower(text), w)), ',') AS found FROM documents", "jn_containment")
def _contained(v):
    hay = F.lower("text")
    return v.documents.select("doc_id", F.array_join(F.filter(F.array(*map(F.lit, _WORDS)), lambda w: hay.contains(w)), ",").alias("found"))


#: Statements of the test tables: a few of their words stand for the keywords.
_STATEMENT = "replace(replace(replace(replace(replace(replace(text, ' the ', '认识'), ' und ', '解决'), 'tion', '算法'), ' que ', '图形'), ' est ', '数据'), 'www', '方法')"
_SECTION = "CASE source WHEN 'src0' THEN 'academic_requirement' WHEN 'src1' THEN 'teaching_hint' ELSE 'content_requirement' END"


def _any(words: str, label: str) -> str:
    return f"CASE WHEN regexp_matches(st, '{words}') THEN '{label}' END"


_PROCESS = ", ".join(_any(*x) for x in (("认识", "recognize"), ("理解", "understand"), ("探索", "explore"), ("掌握", "master"), ("会", "apply"), ("解决", "solve"), ("解释", "explain"), ("描述", "describe"), ("比较", "compare"), ("估算", "estimate"), ("推理", "reason")))
_DIMENSION = ", ".join(_any(*x) for x in (("意义", "conceptual"), ("算法|方法", "procedural"), ("解决|情境", "application"), ("活动", "practice"), ("数据", "data"), ("图形", "spatial")))


@query(f"SELECT doc_id, coalesce(nullif(concat_ws(',', {_PROCESS}), ''), 'understand') AS processes, coalesce(nullif(concat_ws(',', {_DIMENSION}, CASE section WHEN 'academic_requirement' THEN 'evidence' WHEN 'teaching_hint' THEN 'teaching' END), ''), 'conceptual') AS dimensions FROM (SELECT doc_id, coalesce({_STATEMENT}, '') AS st, {_SECTION} AS section FROM documents)")
def fn_infer_dims(v):
    rows = v.documents.select("doc_id", F.expr(_STATEMENT).alias("statement"), F.expr(_SECTION).alias("section"))
    found = C.infer_dimensions(F.col("statement"), F.col("section"))
    return rows.select("doc_id", *(F.array_join(x, ",").alias(n) for x, n in zip(found, ("processes", "dimensions"))))


@query("SELECT doc_id, CASE source WHEN 'src0' THEN '课程内容要求：' WHEN 'src1' THEN '学业表现要求：' ELSE '教学提示：' END || md5(text) AS value FROM documents")
def fn_concept_definition(v):
    prefix = T.mapped(F.col("source"), {"src0": "课程内容要求：", "src1": "学业表现要求："})
    return v.documents.select("doc_id", F.concat(F.coalesce(prefix, F.lit("教学提示：")), F.md5(F.col("text").cast("binary"))).alias("value"))


@query("SELECT doc_id, marker FROM (SELECT doc_id, text, unnest(['TODO', 'Apache License', 'password', 'Lorem']) AS marker FROM documents) WHERE contains(text, marker)")
def flt_placeholder(v):
    return D.placeholders(v.documents, "doc_id", "text", ("TODO", "Apache License", "password", "Lorem"))


@query("SELECT review_state, lang, count(*) AS n FROM doc_review GROUP BY 1, 2")
def agg_doc_review(v):
    return v.doc_review.groupBy("review_state", "lang").agg(F.count("*").alias("n"))


_RUN = f"WITH {_BLOCKS}, pg AS (SELECT source, doc_id FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM pg), sm AS (SELECT source, doc_id, least(n, 40) AS o FROM r WHERE n >= 3 AND (n <= 40 OR r <= 20 OR r > n - 20))"


@query(f"{_RUN} SELECT source, t, count(*) AS n FROM blocks JOIN sm USING (doc_id) GROUP BY source, t, o HAVING count(*) / o > 0.05")
def agg_running_header(v):
    blocks = _blocks(v).join(v.documents.select("doc_id", "source"), "doc_id")
    return O.running_headers(blocks, "source", "doc_id", "t", 0.05)


_SPAN = f"sp AS (SELECT doc_id, t, 8 + (length(t) % 9) * 1.5e0 AS size FROM blocks), sz AS (SELECT doc_id, round(size, 1) AS size, sum(length(t)) AS n FROM sp GROUP BY 1, 2), bd AS (SELECT doc_id, size AS body FROM sz QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, size DESC) = 1)"


@query(f"WITH {_BLOCKS}, {_SPAN}, lg AS (SELECT doc_id, sz.size, row_number() OVER (PARTITION BY doc_id ORDER BY sz.size DESC) AS r FROM sz JOIN bd USING (doc_id) WHERE sz.size > body + 1) SELECT doc_id, 'body' AS role, body AS size FROM bd UNION ALL SELECT doc_id, concat('h', r), size FROM lg WHERE r <= 3")
def agg_font_mode(v):
    spans = _blocks(v).withColumn("size", F.lit(8) + (F.length("t") % 9) * F.lit(1.5))
    return O.font_roles(spans, "doc_id", "size", "t")


@query(f"WITH {_BLOCKS}, sp AS (SELECT doc_id, pos, t, 8 + (length(t) % 9) * 1.5e0 AS size, pos % 2 = 0 AS bold FROM blocks), lv AS (SELECT *, CASE WHEN size >= 19.5 THEN 1 WHEN size >= 16.5 THEN 2 WHEN size >= 13.5 THEN 3 ELSE 0 END AS l FROM sp) SELECT doc_id, CAST(pos AS BIGINT) AS pos, CASE WHEN l = 0 OR length(t) > 80 OR (regexp_matches(t, '[.。!！?？]$') AND NOT regexp_matches(t, '^[\\p{{Nd}}第]+[.、章节]')) OR (l >= 2 AND NOT bold AND size < 12 + 2) THEN 0 ELSE l END AS level FROM lv")
def fn_heading_level(v):
    size = F.lit(8) + (F.length("t") % 9) * F.lit(1.5)
    sizes = {k: F.lit(x) for k, x in (("h1", 20.0), ("h2", 17.0), ("h3", 14.0), ("body", 12.0))}
    return _blocks(v).select("doc_id", F.col("pos").cast("bigint").alias("pos"), O.heading_level(size, F.col("t"), F.col("pos") % 2 == 0, sizes).alias("level"))


@query(f"WITH {_BLOCKS} SELECT doc_id, doc_id % 7 AS page, CAST(sum(length(t)) AS BIGINT) AS char_count, coalesce(array_to_string((list(t ORDER BY pos) FILTER (pos % 5 = 0))[1:8], ' | '), '') AS headings, md5(CASE WHEN length({COMPACT('x')}) > 260 THEN concat(regexp_replace(substr({COMPACT('x')}, 1, 259), '[\\s\\p{{Z}}]+$', ''), '…') ELSE {COMPACT('x')} END) AS preview FROM (SELECT *, string_agg(t, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS x FROM blocks) GROUP BY doc_id, x")
def src_pdf_index(v):
    blocks = _blocks(v).withColumns({"page": F.col("doc_id") % 7, "level": F.when(F.col("pos") % 5 == 0, 1).otherwise(0)})
    out = D.page_index(blocks, "doc_id", "page", "pos", "t", "level")
    return out.withColumn("preview", F.md5(F.col("preview").cast("binary")))


@query("SELECT min_page AS page FROM (SELECT unnest(range(1, 4)) AS min_page UNION SELECT 8)")
def set_page_range(v):
    from graphloom.sources.pages import page_range

    return page_range(v.spark, "1-3,8,2")


# -- carried state and problems ------------------------------------------------------

_CTX = """WITH m AS (SELECT *, CASE WHEN starts_with(marker, 'domain') THEN marker END AS d, CASE WHEN starts_with(marker, 'stage') THEN marker END AS st, CASE WHEN starts_with(marker, 'section') THEN marker END AS se, CASE WHEN starts_with(marker, 'theme') THEN marker END AS th FROM line_stream),
a AS (SELECT *, last_value(st IGNORE NULLS) OVER w AS stage, last_value(d IGNORE NULLS) OVER w AS domain, sum(CASE WHEN d IS NOT NULL OR st IS NOT NULL THEN 1 ELSE 0 END) OVER w AS reset FROM m WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
b AS (SELECT *, last_value(se IGNORE NULLS) OVER w AS section, last_value(th IGNORE NULLS) OVER w AS theme0 FROM a WINDOW w AS (PARTITION BY user_id, reset ORDER BY pos)),
c AS (SELECT *, coalesce(theme0, CASE WHEN domain = 'domain1' THEN 'theme0' END) AS theme FROM b)
SELECT user_id, pos, event_id, stage, domain, section, theme FROM c WHERE d IS NULL AND st IS NULL AND se IS NULL AND th IS NULL AND stage IS NOT NULL AND domain IS NOT NULL AND section IS NOT NULL AND theme IS NOT NULL"""


@query(_CTX)
def win_context_state(v):
    marks = {k: F.when(F.col("marker").startswith(k), F.col("marker")) for k in ("domain", "stage", "section", "theme")}
    return O.context_state(v.line_stream.withColumn("pos", F.col("pos").cast("bigint")), "user_id", "pos", marks, ("domain1", "theme0")).select("user_id", "pos", "event_id", "stage", "domain", "section", "theme")


_C = TRIM("content")
_SEG = f"""e0 AS (SELECT * REPLACE (coalesce({_C}, '') AS content) FROM layout_elements), e1 AS (SELECT * FROM e0 WHERE content <> '' OR type = 'image'),
e2 AS (SELECT *, regexp_matches(content, '^[一二三四五六七八九十百千]+[、．.][\\s\\p{{Z}}]*.+题') AS h, nullif(regexp_extract(content, '^[\\s\\p{{Z}}]*(\\p{{Nd}}+)[\\s\\p{{Z}}]*[.、．)]', 1), '') AS num FROM e1),
e3 AS (SELECT *, NOT h AND ((NOT h AND num IS NOT NULL) OR coalesce(lag(h) OVER (PARTITION BY doc ORDER BY pos), true)) AS st FROM e2),
e4 AS (SELECT *, CAST(sum(CASE WHEN st THEN 1 ELSE 0 END) OVER w AS BIGINT) AS problem, last_value(CASE WHEN h THEN content END IGNORE NULLS) OVER w AS section FROM e3 WINDOW w AS (PARTITION BY doc ORDER BY pos)),
seg AS (SELECT *, first_value(num) OVER (PARTITION BY doc, problem ORDER BY pos) AS number FROM e4 WHERE NOT h)"""


def _segments(v):
    return O.segments(v.layout_elements.withColumn("pos", F.col("pos").cast("bigint")))


@query(f"WITH {_SEG} SELECT doc, pos, id, problem, section, number FROM seg")
def win_problem_segment(v):
    return _segments(v).select("doc", "pos", "id", "problem", "section", "number")


_TYPE = "CASE WHEN contains(coalesce(section, ''), '选择') THEN 'choice' WHEN contains(coalesce(section, ''), '填空') THEN 'fill' WHEN regexp_matches(coalesce(section, ''), '解答|计算|证明|应用') THEN 'solve' ELSE 'unknown' END"
_PROB = f"prob AS (SELECT doc, problem, max(number) AS number, max(section) AS section, array_to_string(list_sort(list(DISTINCT page)), ',') AS page_span, count(DISTINCT page) AS n_pages, coalesce(string_agg(content, chr(10) ORDER BY pos) FILTER (type <> 'image' AND content <> ''), '') AS text_plain, count(*) AS n_elements FROM seg GROUP BY 1, 2)"


@query(f"WITH {_SEG}, {_PROB} SELECT *, {_TYPE} AS type FROM prob", "agg_problem_text")
@query(f"WITH {_SEG}, {_PROB} SELECT *, {_TYPE} AS type FROM prob", "fn_problem_type")
def _problems(v):
    return O.problems(_segments(v))


@query(f"WITH {_SEG}, {_PROB} SELECT doc, problem, page_span, n_pages > 1 AS cross_page FROM prob")
def agg_page_span(v):
    return O.problems(_segments(v)).select("doc", "problem", "page_span", (F.col("n_pages") > 1).alias("cross_page"))


@query(f"SELECT id, regexp_matches({_C}, '^[一二三四五六七八九十百千]+[、．.][\\s\\p{{Z}}]*.+题') AS header, coalesce(regexp_extract({_C}, '^[\\s\\p{{Z}}]*(\\p{{Nd}}+)[\\s\\p{{Z}}]*[.、．)]', 1), '') AS number, regexp_matches({_C}, '^[\\s\\p{{Z}}]*[（(][\\s\\p{{Z}}]*\\p{{Nd}}+[\\s\\p{{Z}}]*[）)]') AS sub FROM layout_elements")
def fn_problem_number(v):
    return v.layout_elements.select("id", O.section_header(F.col("content")).alias("header"), F.coalesce(O.problem_number(F.col("content")), F.lit("")).alias("number"), O.sub_question(F.col("content")).alias("sub"))


@query(f"SELECT id FROM layout_elements WHERE coalesce({_C}, '') <> '' OR type = 'image'")
def flt_text_element(v):
    return v.layout_elements.where((F.coalesce(T.trim_u(F.col("content")), F.lit("")) != "") | (F.col("type") == "image")).select("id")


@query("SELECT doc, CAST(1 AS BIGINT) AS problem, array_to_string(list_sort(list(DISTINCT page)), ',') AS page_span, count(*) AS n_elements FROM layout_elements GROUP BY 1")
def prj_problem_wrap(v):
    whole = v.layout_elements.withColumns({"problem": F.lit(1).cast("bigint"), "number": F.lit("1"), "section": F.lit(None).cast("string")})
    return O.problems(whole).select("doc", "problem", "page_span", "n_elements")


# -- boxes and figures -------------------------------------------------------------


@query("SELECT id FROM layout_elements WHERE x IS NOT NULL AND y IS NOT NULL AND width IS NOT NULL AND height IS NOT NULL")
def flt_valid_bbox(v):
    return v.layout_elements.where(L.valid_box(*(F.col(c) for c in L.BOX))).select("id")


def _r4(x):
    return f"round_even(({x}) * 10000, 0) / 10000"


def _UNION(keys, table):
    c = lambda x, lo: f"least(greatest({x}, {lo}), 1e0)"
    return f"SELECT {keys}, {_r4(c('min(x)', '0e0'))} AS x, {_r4(c('min(y)', '0e0'))} AS y, {_r4(c('max(x + width) - min(x)', '0.0001e0'))} AS width, {_r4(c('max(y + height) - min(y)', '0.0001e0'))} AS height, count(*) AS n_boxes FROM {table} WHERE width IS NOT NULL GROUP BY {keys}"


@query(_UNION("doc, page", "layout_elements"))
def agg_bbox_union(v):
    return L.union_boxes(v.layout_elements, "doc", "page")


_CROPS = f"shots AS (SELECT doc, problem, concat('problem_page_', page) AS crop, x, y, width, height FROM ({_UNION('doc, problem, page', 'seg')}) UNION ALL SELECT doc, problem, concat('diagram_', n), x, y, width, height FROM (SELECT *, row_number() OVER (PARTITION BY doc, problem ORDER BY pos) AS n FROM seg WHERE type = 'image') WHERE width IS NOT NULL)"


@query(f"WITH {_SEG}, {_CROPS} SELECT * FROM shots")
def agg_screenshots(v):
    return L.screenshots(_segments(v))


_FIG = "figs AS (SELECT doc, crop, row_number() OVER (PARTITION BY doc ORDER BY place) AS n FROM (SELECT doc, crop, concat(lpad(problem::VARCHAR, 9, '0'), '-', crop) AS place FROM shots WHERE starts_with(crop, 'diagram_') UNION ALL SELECT doc, concat('element_', id), lpad(pos::VARCHAR, 9, '0') FROM layout_elements WHERE type = 'image' AND doc NOT IN (SELECT doc FROM shots WHERE starts_with(crop, 'diagram_'))))"


@query(f"WITH {_SEG}, {_CROPS}, {_FIG} SELECT * FROM figs")
def sel_figures(v):
    elements = v.layout_elements.withColumn("pos", F.col("pos").cast("bigint"))
    return L.figures(L.screenshots(O.segments(elements)), elements)


@query(f"WITH {_SEG}, {_CROPS}, {_FIG}, w AS (SELECT *, CASE doc % 3 WHEN 0 THEN NULL WHEN 1 THEN '图 2' ELSE '图 9999' END AS wanted FROM figs), h AS (SELECT *, n = TRY_CAST(nullif(regexp_replace(wanted, '[^0-9]', '', 'g'), '') AS BIGINT) AS hit FROM w), a AS (SELECT *, bool_or(hit) OVER (PARTITION BY doc) AS anyhit FROM h) SELECT doc, crop, n, CASE WHEN wanted IS NULL THEN 'all' WHEN coalesce(hit, false) THEN 'matched' ELSE 'low' END AS match FROM a WHERE wanted IS NULL OR coalesce(hit, false) OR (NOT coalesce(anyhit, false) AND n = 1)")
def sel_match(v):
    elements = v.layout_elements.withColumn("pos", F.col("pos").cast("bigint"))
    found = L.figures(L.screenshots(O.segments(elements)), elements)
    wanted = F.when(F.col("doc") % 3 == 1, "图 2").when(F.col("doc") % 3 == 2, "图 9999")
    return L.match_figure(found, wanted).select("doc", "crop", "n", "match")


@query("SELECT id, row_number() OVER (PARTITION BY doc ORDER BY page, CAST(floor(y / 0.035) AS BIGINT), y, x, pos) AS ord FROM layout_elements")
def srt_reading_order(v):
    return L.reading_order(v.layout_elements).select("id", F.col("order").alias("ord"))


@query("SELECT id FROM layout_elements WHERE type = 'text' AND id NOT IN (SELECT b.id FROM layout_elements b JOIN layout_elements t ON t.doc = b.doc AND t.page = b.page AND t.type = 'image' WHERE b.type = 'text' AND greatest(least(b.x + b.width, t.x + t.width) - greatest(b.x, t.x), 0) * greatest(least(b.y + b.height, t.y + t.height) - greatest(b.y, t.y), 0) > 0.6 * greatest(b.width * b.height, 1e-9) AND b.width IS NOT NULL AND t.width IS NOT NULL)")
def jn_bbox_overlap(v):
    e = v.layout_elements
    return L.overlapped(e.where("type = 'text'"), e.where("type = 'image' and width is not null")).select("id")


_IMAGES = "im AS (SELECT event_id AS id, user_id AS doc, event_id AS pos, CAST(60 + event_id % 900 AS BIGINT) AS width, CAST(80 + event_id % 700 AS BIGINT) AS height, CAST(1000 + (event_id * 37) % 60000 AS BIGINT) AS n_bytes, md5(props) AS md5, (event_id % 40) / 100e0 AS page_share FROM events)"


def _images(v):
    e = F.col("event_id")
    return v.events.select(e.alias("id"), F.col("user_id").alias("doc"), e.alias("pos"), (60 + e % 900).alias("width"), (80 + e % 700).alias("height"), (1000 + (e * 37) % 60000).alias("n_bytes"), F.md5(F.col("props").cast("binary")).alias("md5"), ((e % 40) / 100).alias("page_share"))


@query(f"WITH {_IMAGES}, l AS (SELECT *, row_number() OVER (PARTITION BY doc, md5 ORDER BY pos) AS n FROM im WHERE width >= 100 AND height >= 100 AND width * height >= 30000 AND n_bytes >= 2048) SELECT id FROM l WHERE n = 1 AND page_share >= 0.05 AND greatest(width, height) / least(width, height) <= 12 AND NOT (n_bytes / (width * height) < 0.08 AND width * height < 500000)", "flt_img_keep")
def _kept(v):
    return L.kept_images(_images(v)).select("id")


@query(f"WITH {_IMAGES} SELECT doc, md5, min(pos) AS pos FROM im GROUP BY 1, 2")
def win_first_wins_image(v):
    from graphloom.operators.graph import first_of

    return first_of(_images(v), "doc", "md5").select("doc", "md5", "pos")


@query("SELECT id, least(greatest(x * 1000 / 800, 0), 1) AS x, least(greatest(y * 1000 / 1200, 0), 1) AS y, least(greatest(width * 1000 / 800, 0), 1) AS width, least(greatest(height * 1000 / 1200, 0), 1) AS height FROM layout_elements WHERE width IS NOT NULL")
def src_ocr_normalize(v):
    box = L.normalized_box(*(F.col(c) * 1000 for c in L.BOX), F.lit(800.0), F.lit(1200.0))
    return v.layout_elements.where("width is not null").select("id", *(b.alias(c) for b, c in zip(box, L.BOX)))


# -- sources and sinks over tables ---------------------------------------------------


@query("SELECT event_id, k.key AS key, json_extract_string(props, '$.' || k.key) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events) k")
def src_explode(v):
    rows = v.events.select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return rows.select("event_id", "key", "value")


_NAME = "concat(split_part(url, '/', 4), '-', page_id, '.html')"


@query(f"SELECT replace({SLUGB(f'regexp_replace({_NAME}, {chr(39)}\\.[^.]*$' + chr(39) + f', {chr(39)}{chr(39)})')}, '-', '_') AS asset, page_id, strlen(html) AS bytes, sha256(html) AS sha256 FROM pages")
def snk_manifest(v):
    name = F.concat(F.coalesce(F.try_element_at(F.split("url", "/"), F.lit(4)), F.lit("")), F.lit("-"), F.col("page_id").cast("string"), F.lit(".html"))
    return v.pages.select(D.asset_key(name).alias("asset"), "page_id", F.octet_length("html").cast("bigint").alias("bytes"), F.sha2(F.col("html").cast("binary"), 256).alias("sha256"))


@query("SELECT page_id AS asset, problem FROM (SELECT page_id, unnest(list_filter([CASE WHEN trim(url) = '' THEN 'path' END, CASE WHEN length(html) - 3000 < 0 THEN 'bytes' END, CASE WHEN page_id % 9 = 0 THEN 'sha256' END], p -> p IS NOT NULL)) AS problem FROM pages)")
def val_manifest(v):
    assets = v.pages.select(F.col("page_id").alias("asset"), F.col("url").alias("path"), (F.length("html") - 3000).alias("bytes"), F.when(F.col("page_id") % 9 == 0, F.lit("short")).otherwise(F.sha2(F.col("html").cast("binary"), 256)).alias("sha256"))
    return D.manifest_rules(assets)


_PATH = "concat(url, CASE page_id % 7 WHEN 0 THEN '.PDF' WHEN 1 THEN '/.DS_Store' WHEN 2 THEN '/.git/x.png' WHEN 3 THEN '/Lesson-Scan.md' WHEN 4 THEN '/教材.txt' WHEN 5 THEN '/.png' ELSE '.html' END)"


_NAME = "regexp_extract(lower(path), '[^/]*$')"


@query(f"SELECT path, problem FROM (SELECT path, CASE WHEN {_NAME} = '.ds_store' THEN 'leftover' WHEN regexp_extract({_NAME}, '.(\\.[^.]*)$', 1) IN ('.pdf', '.png', '.jpg', '.jpeg', '.gif', '.webp', '.bmp', '.tif', '.tiff', '.heic') THEN 'extension' WHEN regexp_matches({_NAME}, 'screenshot|screen-shot|screenshoot|textbook|publisher|scan|scanned|教材|课本|教科书|截图|扫描') THEN 'name' END AS problem FROM (SELECT {_PATH} AS path FROM pages) WHERE NOT contains(path, '/.git/')) WHERE problem IS NOT NULL")
def flt_file_policy(v):
    return D.file_policy(v.pages.select(F.expr(_PATH).alias("path")))


@query("SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), ''), '') AS title FROM pages")
def src_frontmatter(v):
    fenced = F.concat(F.lit("---\ntitle: \""), F.trim(F.regexp_replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), "\n", " ")), F.lit("\"\n---\nbody"))
    return v.pages.select("page_id", F.coalesce(D.front_matter_field(fenced, "title"), F.lit("")).alias("title"))


# -- grading -------------------------------------------------------------------------


@query(f"SELECT event_id, lower({TRIM('event_type')}) IN ('click', 'view') AS correct FROM events")
def qij_exact(v):
    return v.events.select("event_id", Q.exact(F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")), F.array(F.lit("Click"), F.lit(" view")), case_sensitive=False).alias("correct"))


_ORDER_SETS = "o AS (SELECT l_orderkey, list(DISTINCT l_linenumber) AS a FROM lineitem GROUP BY 1)"


@query(f"WITH {_ORDER_SETS}, s AS (SELECT l_orderkey, len(list_filter(a, x -> x IN (1, 2, 3))) AS r, len(list_filter(a, x -> x NOT IN (1, 2, 3))) AS w FROM o) SELECT l_orderkey, round(least(greatest((r - w) / 3, 0), 1) * 2, 6) AS score FROM s")
def qij_set(v):
    own = v.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("a"))
    return own.select("l_orderkey", F.round(Q.set_score(F.col("a"), F.array(F.lit(1), F.lit(2), F.lit(3)), 2.0), 6).alias("score"))


@query("SELECT l_orderkey, l_linenumber, abs(l_extendedprice - l_quantity * 1000) <= 500 OR abs(l_extendedprice - l_quantity * 1000) <= 0.1 * abs(l_quantity * 1000) AS correct FROM lineitem")
def qij_numeric(v):
    return v.lineitem.select("l_orderkey", "l_linenumber", Q.numeric(F.col("l_extendedprice"), F.col("l_quantity") * 1000, 500.0, 0.1).alias("correct"))


@query("SELECT event_id, CASE WHEN replace(props, ' ', '') = '{\"k\":5}' THEN true END AS correct FROM events")
def qij_expression(v):
    return v.events.select("event_id", Q.expression(F.col("props"), F.lit('{ "k" : 5 }')).alias("correct"))


@query("SELECT l_orderkey, l_linenumber, least(greatest(l_quantity / 10, 0), 3) + least(greatest(l_discount * 100, 0), 5) AS points FROM lineitem")
def qij_rubric(v):
    return v.lineitem.select("l_orderkey", "l_linenumber", Q.rubric(F.array(F.col("l_quantity") / 10, F.col("l_discount") * 100), F.array(F.lit(3.0), F.lit(5.0))).alias("points"))


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def qij_delivery(v):
    hidden = v.events.withColumnRenamed("props", "answer_key")
    return hidden.select(*Q.delivered(hidden.columns))


@query("SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2")
def qij_items(v):
    return v.conversations.groupBy("conv_id", "role").agg(F.count("*").alias("n"))


_PACK = """concat('{"schema": "', CASE WHEN p_partkey % 5 = 0 THEN 'other' ELSE 'pack.v1' END, '", "kind": ', CASE WHEN p_partkey % 7 = 0 THEN '7' ELSE '"learning_pack"' END, ', "id": ', CASE WHEN p_partkey % 3 = 0 THEN '12' ELSE '"p"' END, ', "title": "', CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE p_name END, '"', CASE WHEN p_partkey % 6 = 0 THEN '' ELSE ', "version": "1"' END, ', "kg_refs": ', CASE p_partkey % 8 WHEN 0 THEN '[]' WHEN 1 THEN '"a"' ELSE '["a", 1]' END, ', "objectives": ["o"], "tasks": ', CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE '[{"t": 1}]' END, ', "misconceptions": ', CASE p_partkey % 10 WHEN 0 THEN 'null' WHEN 1 THEN '{}' ELSE '[]' END, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE '}' END)"""
_HOLDS = {
    "schema": "schema <> 'pack.v1'",
    "kind": "json_extract_string(raw, '$.kind') <> 'learning_pack'",
    **{f: f"coalesce(json_type(raw, '$.{f}'), '') <> 'VARCHAR' OR trim(json_extract_string(raw, '$.{f}')) = ''" for f in D.PACK_TEXTS},
    **{f: f"coalesce(json_type(raw, '$.{f}'), '') <> 'ARRAY' OR json_array_length(raw, '$.{f}') = 0" for f in D.PACK_LISTS},
    **{f: f"json_type(raw, '$.{f}') NOT IN ('NULL', 'ARRAY')" for f in D.PACK_OPTIONAL},
}


@query(f"WITH raws AS (SELECT p_partkey AS pack, {_PACK} AS raw FROM part), packs AS (SELECT pack, raw, json_extract_string(raw, '$.schema') AS schema FROM raws WHERE json_valid(raw)) SELECT pack, 'object' AS problem FROM raws WHERE NOT json_valid(raw) UNION ALL " + " UNION ALL ".join(f"SELECT pack, '{f}' FROM packs WHERE {c}" for f, c in _HOLDS.items()))
def val_pack(v):
    return D.pack_rules(v.part.select(F.col("p_partkey").alias("pack"), F.try_parse_json(F.expr(_PACK)).alias("v")), "pack.v1")
