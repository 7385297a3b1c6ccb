"""Curricula built from the lines of their documents.

One carried-state pass gives every line its stage, domain, theme and section;
everything else follows from the lines of such a context: items, the standards
and concepts made of them, topics, evidence, and the relations between them.
All orders are within a document, so work is spread by document; what a
document needs more than once is stored, and frames come out as tables of all
documents.

Lines without a marker before them belong to no context and go.  A document
without contexts has its fixed framework only; no lines, no rows (but the
competencies, which are the curriculum's own).  Null lines count as empty.  Ids
are paths of the context and a number, so they are unique within a document.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import clean_statement, is_noise, mapped, ocr_fixups, page_label, slug_base, statement_name
from graphloom.operators.curriculum import infer_dimensions
from graphloom.operators.graph import _stored
from graphloom.operators.ordered import ITEM, context_state

#: Stages (slug, local name, first and last grade, level, order), domains (slug, order), themes, competencies and sections (label, slug, prefix of a definition) of a mathematics curriculum.
STAGES = {"第一学段": ("stage1", "1-2年级", 1, 2, "elementary", 1), "第二学段": ("stage2", "3-4年级", 3, 4, "elementary", 2), "第三学段": ("stage3", "5-6年级", 5, 6, "elementary", 3), "第四学段": ("stage4", "7-9年级", 7, 9, "middle", 4)}
DOMAINS = {"数与代数": ("number-algebra", 1), "图形与几何": ("geometry", 2), "统计与概率": ("statistics-probability", 3), "综合与实践": ("synthesis-practice", 4)}
THEMES = {
    "数与运算": "number-operation",
    "数量关系": "quantity-relation",
    "数与式": "number-expression",
    "方程与不等式": "equation-inequality",
    "函数": "function",
    "图形的认识与测量": "shape-measurement",
    "图形的位置与运动": "position-motion",
    "图形的性质": "shape-properties",
    "图形的变化": "shape-transformation",
    "图形与坐标": "shape-coordinate",
    "数据分类": "data-classification",
    "数据的收集、整理与表达": "data-collection-expression",
    "随机现象发生的可能性": "random-phenomena-possibility",
    "随机事件的概率": "random-event-probability",
    "抽样与数据分析": "sampling-data-analysis",
    "主题活动": "theme-activity",
    "项目学习": "project-learning",
    "跨学科主题学习": "interdisciplinary-theme-learning",
}
PRACTICE, PRACTICE_THEMES = "综合与实践", ("主题活动", "项目学习", "跨学科主题学习")
COMPETENCIES = {
    "数感": "理解数量、数的表示、数的大小、数的运算和数量关系，并能在真实情境中作出合理判断。",
    "符号意识": "理解并运用数字、运算符号、关系符号、字母和式子表达数学对象及其关系。",
    "运算能力": "理解算理和算法，能选择合适方法进行运算、估算和结果解释。",
    "推理意识": "能基于事实、规则和模式进行归纳、类比、演绎和解释。",
    "几何直观": "能借助图形、图示和空间表征理解数量关系和几何问题。",
    "空间观念": "能识别、想象和描述图形的位置、形状、大小及变化。",
    "量感": "能理解度量对象、单位和测量过程，并合理估计与表达量。",
    "数据意识": "能收集、整理、表达和解释数据，并用数据支持判断。",
    "数据观念": "能从数据角度理解随机现象、样本、统计图表和推断结果。",
    "模型意识": "能从真实情境中抽象数量关系、图形关系或数据关系并用于解决问题。",
    "模型观念": "能建立、解释、评价和应用数学模型解决较复杂的问题。",
    "应用意识": "能主动把数学知识和方法用于生活、学科和社会情境。",
    "创新意识": "能提出有意义的问题，尝试开放性探索并反思改进方案。",
}
SECTIONS = {"content_requirement": ("内容要求", "content", "课程内容要求："), "academic_requirement": ("学业要求", "academic", "学业表现要求："), "teaching_hint": ("教学提示", "teaching", "教学提示：")}


@dataclass(frozen=True)
class Curriculum:
    """The words and names of a curriculum; the defaults are those of mathematics."""

    title: str = "义务教育数学课程标准（2022年版）"
    subject: str = "mathematics"
    chapter: str = "四、课程内容"
    whole: str = "数学课程内容"
    competency_prefix: str = "math.competency."
    stages: dict = field(default_factory=lambda: STAGES)
    domains: dict = field(default_factory=lambda: DOMAINS)
    themes: dict = field(default_factory=lambda: THEMES)
    competencies: dict = field(default_factory=lambda: COMPETENCIES)
    sections: dict = field(default_factory=lambda: SECTIONS)
    practice: str = PRACTICE
    practice_themes: tuple = PRACTICE_THEMES
    practice_default: str = PRACTICE_THEMES[-1]
    #: Groups of stages by level: id suffix, name, local name, first and last grade.
    groups: dict = field(default_factory=lambda: {"elementary": ("primary", "小学部分", "1-6年级", 1, 6), "middle": ("middle", "初中部分", "7-9年级", 7, 9)})

    def stage(self, name: Column, i: int) -> Column:
        return mapped(name, {k: str(v[i]) for k, v in self.stages.items()})

    def domain(self, name: Column, i: int) -> Column:
        return mapped(name, {k: str(v[i]) for k, v in self.domains.items()})

    def section(self, key: Column, i: int) -> Column:
        return mapped(key, {k: v[i] for k, v in self.sections.items()})

    def theme(self, name: Column) -> Column:
        return F.coalesce(mapped(name, self.themes), slug_base(name))

    def band(self, stage: Column) -> list[Column]:
        return [self.stage(stage, 1).alias("grade_local"), *(self.stage(stage, i).cast("bigint").alias(n) for i, n in ((2, "min_grade"), (3, "max_grade"))), self.stage(stage, 4).alias("stage_level")]


def _first(tests: list[tuple[Column, str]]) -> Column:
    return reduce(lambda out, t: F.when(t[0], F.lit(t[1])).otherwise(out), reversed(tests), F.lit(None).cast("string"))


def marks(line: Column, spec: Curriculum = Curriculum()) -> dict:
    """What a line marks: its domain, stage and section, and its theme given the domain that holds there."""
    short = line.startswith("(") | line.startswith("一") | (F.length(line) <= 18)
    name = F.replace(F.regexp_replace(line, r"(?U)^[0-9一二三四五六七八九十]+[.、]\s*", ""), F.lit(" "), F.lit(""))
    name = F.regexp_replace(name, r"(?U)^\s+|\s+$", "")
    own = F.when(name.isin(*spec.themes), name)
    practice = _first([(name.contains(t), t) for t in spec.practice_themes])
    return {
        "domain": _first([(line.contains(d) & short, d) for d in spec.domains]),
        "stage": _first([(line.contains(s), s) for s in spec.stages]),
        "section": _first([(line.contains(v[0]), k) for k, v in spec.sections.items()]),
        "theme": lambda domain: F.coalesce(own, F.when(domain.eqNullSafe(spec.practice), practice)),
    }


def repaired_lines(rows: DataFrame, line: str = "line") -> DataFrame:
    """Rows with repaired lines, without noise."""
    own = rows.withColumn(line, ocr_fixups(F.coalesce(F.col(line), F.lit(""))))
    return own.where(~is_noise(F.col(line)))


CONTEXT = ("stage", "domain", "theme", "section")


def context_lines(rows: DataFrame, doc: str = "doc", pos: str = "pos", line: str = "line", spec: Curriculum = Curriculum()) -> DataFrame:
    """Rows with their stage, domain, theme and section; marker lines and lines outside of all contexts go."""
    return context_state(rows, doc, pos, marks(F.col(line), spec), (spec.practice, spec.practice_default))


def context_items(rows: DataFrame, doc: str = "doc", page: str = "page", pos: str = "pos", line: str = "line", least: int = 8) -> DataFrame:
    """``doc, stage, domain, theme, section, n, statement, pages``: the items of each
    context.  A marker opens an item, but not among teaching hints; a context
    whose statements are all too short is cut into slices of 180 characters."""
    key = [F.col(doc).alias("doc"), *CONTEXT]
    hint = F.col("section") == "teaching_hint"
    opens = F.when(~hint & F.col(line).rlike(ITEM), 1).otherwise(0)
    own = rows.select(*key, F.col(page).alias("page"), F.col(pos).alias("pos"), F.col(line).alias("line"), opens.alias("_opens"))
    own = own.withColumn("_item", F.sum("_opens").over(W.partitionBy("doc", *CONTEXT).orderBy("pos")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    items = own.groupBy("doc", *CONTEXT, "_item").agg(text.alias("text"), F.sort_array(F.collect_set("page")).alias("pages"))
    items = items.withColumn("statement", F.when(hint, clean_statement(F.col("text"), 220)).otherwise(clean_statement(F.col("text"), 180)))
    whole = items.groupBy("doc", *CONTEXT).agg(F.array_sort(F.collect_list(F.struct("_item", "statement", "pages", "text"))).alias("all"))
    good = F.transform(F.filter("all", lambda x: F.length(x["statement"]) >= least), lambda x: F.struct(x["statement"].alias("statement"), x["pages"].alias("pages")))
    rest = F.when(F.size(good) == 0, clean_statement(F.array_join(F.transform("all", lambda x: x["text"]), "\n"), 220))
    pages = F.sort_array(F.array_distinct(F.flatten(F.transform("all", lambda x: x["pages"]))))
    parts = F.transform(F.sequence(F.lit(0), F.expr("greatest(length(_rest) - 1, 0) div 180").cast("int")), lambda i: F.substring("_rest", i * 180 + 1, F.lit(180)))
    ended = lambda s: F.concat(F.regexp_replace(s, "[，,、]+$", ""), F.when(s.endswith("。"), "").otherwise("。"))
    slices = F.transform(F.filter(parts, lambda s: F.length(s) >= least), lambda s: F.struct(ended(s).alias("statement"), F.col("_pages").alias("pages")))
    each = whole.withColumns({"_good": good, "_rest": rest, "_pages": pages})
    each = each.select("doc", *CONTEXT, F.posexplode(F.when(F.size("_good") > 0, F.col("_good")).otherwise(slices)).alias("_n", "x"))
    return each.select("doc", *CONTEXT, (F.col("_n") + 1).cast("bigint").alias("n"), "x.statement", "x.pages")


def _num(c: str) -> Column:
    return F.format_string("%02d", F.col(c))


def build(rows: DataFrame, doc: str = "doc", page: str = "page", pos: str = "pos", line: str = "line", code: str | None = None, spec: Curriculum = Curriculum(), store=None) -> dict[str, DataFrame]:
    """The tables of the curricula in ``rows``: ``contexts, framework_nodes,
    standard_items, concepts, competencies, learning_evidence, relations,
    curricula``.  ``doc`` is a curriculum's id, the first part of those of its
    framework and standards; ``code`` that of its concepts (``subject.doc`` unless given)."""
    store = store or _stored(rows)
    codes = F.concat(F.lit(f"{spec.subject}."), F.col(doc)) if code is None else F.col(code)
    rows = rows.select(F.col(doc).alias("doc"), codes.alias("code"), F.col(page).alias("page"), F.col(pos).alias("pos"), F.col(line).alias("line"))
    docs = store(rows.groupBy("doc").agg(F.min("code").alias("code")), "documents")
    lines = store(context_lines(repaired_lines(rows), spec=spec), "contexts")
    slugs = {"_st": spec.stage(F.col("stage"), 0), "_do": spec.domain(F.col("domain"), 0), "_th": spec.theme(F.col("theme"))}
    orders = {"_so": spec.stage(F.col("stage"), 5).cast("int"), "_do_order": spec.domain(F.col("domain"), 1).cast("int")}
    contexts = lines.groupBy("doc", *CONTEXT).agg(F.count("*").alias("n_lines"), F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    items = context_items(lines).join(docs, "doc").withColumns(slugs | orders)
    items = store(items.withColumn("_se", spec.section(F.col("section"), 1)), "items")

    topics = lines.select("doc", "stage", "domain", "theme").distinct().withColumns(slugs | orders)
    dash = lambda *c: F.concat_ws("-", *c)
    topic_id = dash("doc", "_st", "_do", "_th")
    fixed = []
    for i, (level, (suffix, name, local, low, high)) in enumerate(spec.groups.items(), 1):
        fixed.append((suffix, "stage_group", None, name, None, local, low, high, level, i))
    for name, (slug, local, low, high, level, order) in spec.stages.items():
        fixed.append((slug, "grade_band", spec.groups[level][0], name, slug, local, low, high, level, order))
    for name, (slug, order) in spec.domains.items():
        fixed.append((slug, "domain", None, name, None, None, None, None, None, order))
    names = ("_slug", "type", "_parent", "name", "native_code", "grade_local", "min_grade", "max_grade", "stage_level", "order")
    kinds = ("string",) * 6 + ("bigint", "bigint", "string", "bigint")
    literal = F.array(*(F.struct(*(F.lit(x).cast(k).alias(n) for x, n, k in zip(r, names, kinds))) for r in fixed))
    framework = docs.select("doc", F.explode(literal).alias("x")).select("doc", "x.*")
    framework = framework.select(dash("doc", "_slug").alias("id"), "type", F.col("doc").alias("curriculum_id"), F.when(F.col("_parent").isNotNull(), dash("doc", "_parent")).alias("parent_id"), *names[3:])
    place = F.row_number().over(W.partitionBy("doc").orderBy("_so", "_do_order", "theme")) + len(fixed)
    topic_nodes = topics.select(topic_id.alias("id"), F.lit("topic").alias("type"), F.col("doc").alias("curriculum_id"), dash("doc", "_do").alias("parent_id"), F.col("theme").alias("name"), dash("_st", "_th").alias("native_code"), *spec.band(F.col("stage")), place.cast("bigint").alias("order"))
    framework = framework.unionByName(topic_nodes)

    number, hint = _num("n"), F.col("section") == "teaching_hint"
    label = spec.section(F.col("section"), 0)
    standard_id = F.concat(F.lit("std-"), dash("doc", "_st", "_do", "_th", "_se", number))
    path = F.array("stage", "domain", "theme", label)
    process, dimension = infer_dimensions(F.col("statement"), F.col("section"))
    standards = items.select(
        standard_id.alias("id"),
        F.col("section").alias("type"),
        F.col("doc").alias("curriculum_id"),
        topic_id.alias("framework_id"),
        F.concat_ws("/", "_st", "_do", "_th", "_se", number).alias("native_code"),
        F.lit(spec.subject).alias("subject"),
        F.col("_do").alias("domain"),
        F.col("_th").alias("theme"),
        F.array(dash("doc", "_st"), dash("doc", "_do"), topic_id).alias("framework_node_ids"),
        path.alias("framework_path"),
        *spec.band(F.col("stage")),
        "statement",
        process.alias("cognitive_process"),
        dimension.alias("knowledge_dimension"),
        F.concat_ws(" / ", F.lit(spec.chapter), "domain", "stage", "theme", label).alias("source"),
        F.coalesce(F.get("pages", F.lit(0)), F.lit(0)).cast("bigint").alias("page"),
        "pages",
        page_label(F.get("pages", F.lit(0)), F.element_at("pages", -1)).alias("native_ref"),
        F.when(hint, 0.82).otherwise(0.88).alias("confidence"),
    )

    dot = lambda *c: F.concat_ws(".", *c)
    band = spec.band(F.col("stage"))
    topic_concept, domain_concept = dot("code", "_st", "_do", "_th"), dot("code", "_st", "_do")
    name = statement_name(F.col("statement"), F.concat("stage", F.lit(" "), "theme", F.lit(" "), label, F.lit("：")))
    item_concepts = items.select(
        dot("code", "_st", "_do", "_th", "_se", number).alias("id"), name.alias("name"), F.concat(spec.section(F.col("section"), 2), "statement").alias("definition"), *band, F.col("_do").alias("domain"),
        F.col("section").alias("concept_type"), F.array(standard_id).alias("standard_ids"), F.when(hint, 0.82).otherwise(0.86).alias("confidence"), path.alias("framework_path"), F.col("pages").alias("pdf_pages"),
    )
    first = F.min(F.struct("section", "n", standard_id.alias("id")))["id"]
    with_standards = store(items.groupBy("doc", "code", "stage", "domain", "theme", "_st", "_do", "_th", "_so").agg(first.alias("ref")), "topics")
    no_pages = F.lit(None).cast("array<bigint>")

    def group_concept(df: DataFrame, id_: Column, name: Column, definition: Column, kind: str, ref: Column, way: Column) -> DataFrame:
        return df.select(id_.alias("id"), name.alias("name"), definition.alias("definition"), *band, F.col("_do").alias("domain"), F.lit(kind).alias("concept_type"), F.array(ref).alias("standard_ids"), F.lit(0.84).alias("confidence"), way.alias("framework_path"), no_pages.alias("pdf_pages"))

    said = F.concat("stage", "domain", F.lit("中的"), "theme", F.lit("主题，汇集内容要求、学业要求和教学提示。"))
    topic_concepts = group_concept(with_standards, topic_concept, F.concat_ws(" ", "stage", "theme"), said, "topic_group", F.col("ref"), F.array("stage", "domain", "theme"))
    domain_refs = with_standards.groupBy("doc", "code", "stage", "domain", "_st", "_do", "_so").agg(F.min_by("ref", "theme").alias("ref"))
    said = F.concat("stage", F.lit(f"{spec.whole}中的"), "domain", F.lit("学习领域。"))
    domain_concepts = group_concept(domain_refs, domain_concept, F.concat_ws(" ", "stage", "domain"), said, "domain_group", F.col("ref"), F.array("stage", "domain"))
    concepts = item_concepts.withColumn("pdf_pages", F.col("pdf_pages").cast("array<bigint>")).unionByName(topic_concepts).unionByName(domain_concepts).withColumn("subject", F.lit(spec.subject))
    evidence = concepts.select(F.concat(F.lit("evidence-"), "id").alias("id"), F.col("id").alias("concept_id"), F.concat(F.lit("学生能够说明、完成或应用："), "name", F.lit("。")).alias("statement"), F.lit(spec.subject).alias("subject"), F.lit(0.76).alias("confidence"))

    def relations(df: DataFrame, kind: str, link: str, rationale: str, confidence: float) -> DataFrame:
        return df.select(F.concat(F.lit("rel-"), "source_id", F.lit(f"-{link}-"), "target_id").alias("id"), F.lit(kind).alias("type"), "source_id", "target_id", F.lit(rationale).alias("rationale"), F.lit(confidence).alias("confidence"))

    item_ids = items.select(dot("code", "_st", "_do", "_th", "_se", number).alias("source_id"), topic_concept.alias("target_id"), F.concat(spec.section(F.col("section"), 2), "statement").alias("_said"))
    named = F.array_compact(F.array(*(F.when(F.col("_said").contains(c), F.lit(c)) for c in spec.competencies)))
    supports = item_ids.select("source_id", F.explode(named).alias("_c")).select("source_id", F.concat(F.lit(spec.competency_prefix), slug_base(F.col("_c"))).alias("target_id"))

    def successive(df: DataFrame, id_: Column, *same: str) -> DataFrame:
        """Each joined to the one a stage on; a stage that is missing is not bridged."""
        own = df.select("doc", *same, "_so", id_.alias("source_id"))
        return own.join(df.select("doc", *same, (F.col("_so") - 1).alias("_so"), id_.alias("target_id")), ["doc", *same, "_so"]).select("source_id", "target_id")

    links = [
        relations(with_standards.select(topic_concept.alias("source_id"), domain_concept.alias("target_id")), "part_of", "part-of", "主题隶属于同学段学习领域。", 0.9),
        relations(item_ids, "part_of", "part-of", "课标条目隶属于对应学段主题。", 0.9),
        relations(supports, "supports_competency", "supports", "条目显式指向对应核心素养。", 0.78),
        relations(successive(domain_refs, domain_concept, "domain"), "progresses_to", "extends", "同一学习领域按学段递进。", 0.86),
        relations(successive(with_standards, topic_concept, "domain", "theme"), "progresses_to", "extends", "同一主题按学段递进。", 0.86),
    ]
    spark = rows.sparkSession
    grades = [g for v in spec.stages.values() for g in v[2:4]]
    competencies = spark.createDataFrame([(c, d) for c, d in spec.competencies.items()], "name string, description string")
    competencies = competencies.select(F.concat(F.lit(spec.competency_prefix), slug_base(F.col("name"))).alias("id"), "name", F.lit(spec.subject).alias("subject"), "description", F.lit(f"{min(grades)}-{max(grades)}年级").alias("grade_local"), F.lit(0.8).alias("confidence"))
    return {
        "contexts": contexts,
        "framework_nodes": framework,
        "standard_items": standards,
        "concepts": concepts,
        "competencies": competencies,
        "learning_evidence": evidence,
        "relations": reduce(DataFrame.unionByName, links),
        "curricula": docs.select(F.col("doc").alias("id"), F.lit(spec.title).alias("name"), F.lit(spec.subject).alias("subject"), F.lit(min(grades)).cast("bigint").alias("min_grade"), F.lit(max(grades)).cast("bigint").alias("max_grade")),
    }
