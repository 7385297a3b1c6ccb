"""Curricula from lines, seeded maps, repositories, manifests, imports, layouts."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from graphloom.operators import builder as B
from graphloom.operators import curriculum as C
from graphloom.operators import groups as K
from graphloom.operators import ordered as O
from graphloom.operators import repository as P
from graphloom.operators import rules as R
from graphloom.sources import documents as D
from graphloom.sources.tables import cut, work_folder


def store_in(spark):
    folder = work_folder(spark)
    return lambda df, name: cut(df, name, folder)


LINES = """第一学段（1-2FR）
一、数与代数
1. 数与运算
【内容要求】
（1）认识万以内的数，
发展数感。例 3
（2）短
续表
12
（3）探索运算的方法；会估算
【教学提示了
（1）教学中要重视情境
（2）并组织活动
第二学段
数 与 运 算
内容要求
这一行没有编号，但足够长，能成为一条
综合与实践
【学业要求】
能描述活动过程并解释结果
主题活动
学业要求
能解决真实情境中的问题""".split("\n")


@pytest.fixture(scope="module")
def built(spark):
    rows = [("cn", "math.cn", 20 + k // 8, k, line) for k, line in enumerate(LINES)] + [("other", "math.o", 1, k, line) for k, line in enumerate(["前言", "没有标记", None])]
    return B.build(spark.createDataFrame(rows, "doc string, code string, page int, pos int, line string"), code="code")


def test_contexts_and_items_of_a_curriculum(built):
    got = {(r.stage, r.domain, r.theme, r.section, r.n_lines) for r in built["contexts"].collect()}
    assert got == {
        ("第一学段", "数与代数", "数与运算", "content_requirement", 4),
        ("第一学段", "数与代数", "数与运算", "teaching_hint", 2),
        ("第二学段", "数与代数", "数与运算", "content_requirement", 1),
        ("第二学段", "综合与实践", "跨学科主题学习", "academic_requirement", 1),
        ("第二学段", "综合与实践", "主题活动", "academic_requirement", 1),
    }
    items = {r.id: r for r in built["standard_items"].collect()}
    first = items["std-cn-stage1-number-algebra-number-operation-content-01"]
    assert first.statement == "认识万以内的数，发展数感。" and first.pages == [20] and first.native_ref == "PDF page 20"
    assert items["std-cn-stage1-number-algebra-number-operation-content-02"].statement == "探索运算的方法；会估算"
    hint = items["std-cn-stage1-number-algebra-number-operation-teaching-01"]
    assert hint.statement == "教学中要重视情境(2)并组织活动" and hint.knowledge_dimension == ["application", "practice", "teaching"]
    assert len(items) == 6


def test_frames_of_a_curriculum_fit_together(built):
    assert C.validate_built(built).count() == 0
    nodes = {r.id: r for r in built["framework_nodes"].where("curriculum_id = 'cn'").collect()}
    topics = sorted((r.order, r.name) for r in nodes.values() if r.type == "topic")
    assert topics == [(11, "数与运算"), (12, "数与运算"), (13, "主题活动"), (14, "跨学科主题学习")]
    assert nodes["cn-stage4"].parent_id == "cn-middle" and built["framework_nodes"].where("curriculum_id = 'other'").count() == 10
    relations = {(r.type, r.source_id, r.target_id) for r in built["relations"].collect()}
    assert ("progresses_to", "math.cn.stage1.number-algebra", "math.cn.stage2.number-algebra") in relations
    assert ("progresses_to", "math.cn.stage1.number-algebra.number-operation", "math.cn.stage2.number-algebra.number-operation") in relations
    assert ("supports_competency", "math.cn.stage1.number-algebra.number-operation.content.01", "math.competency.数感") in relations
    concepts = {r.id: r for r in built["concepts"].collect()}
    assert concepts["math.cn.stage2.synthesis-practice"].standard_ids == ["std-cn-stage2-synthesis-practice-theme-activity-academic-01"]
    assert built["learning_evidence"].count() == len(concepts) == 6 + 4 + 3
    assert {r.id for r in built["curricula"].collect()} == {"cn", "other"}


def test_a_curriculum_of_nothing(spark):
    made = B.build(spark.createDataFrame([], "doc string, page int, pos int, line string"))
    assert {k: df.count() for k, df in made.items() if k != "competencies"} == dict.fromkeys(("contexts", "framework_nodes", "standard_items", "concepts", "learning_evidence", "relations", "curricula"), 0)


def test_seeded_maps(spark):
    domains = spark.createDataFrame([("na", "数与代数", 1), ("g", "图形", 2)], "domain string, name string, ord int")
    seeds = spark.createDataFrame([(2, "g", "形", "角", ["锐角"], None), (1, "na", "数", "数的认识", ["自然数", "小数"], "已有"), (3, "x", "数", "无处", ["点"], None)], "pos int, domain string, theme string, name string, points array<string>, summary string")
    relations = spark.createDataFrame([("requires", "角", "数的认识", "先后", None, None), ("extends", "角", "没有", "无", None, 0.5)], "type string, source_name string, target_name string, evidence string, source_refs array<string>, confidence double")
    nodes, edges, rest = K.seeded(domains, seeds, relations, "src:s", store=store_in(spark))
    own = {r.id: r for r in nodes.collect()}
    assert set(own) == {"domain:na", "domain:g", "kg:na:数:数的认识", "kg:g:形:角"}
    corner = own["kg:g:形:角"]
    assert corner.ord == 2 and own["domain:g"].ord == 200 and corner.summary.startswith("角组织图形 / 形") and corner.typical_tasks[0] == "解释锐角的意义或作用。"
    assert own["kg:na:数:数的认识"].summary == "已有" and corner.grade_progression[2].focus == "逐步概括角中的关系、性质和一般方法。"
    assert {(r.id, r.confidence, r.visibility) for r in edges.collect()} == {("kgrel:part-of:角:g", 1.0, "anchor"), ("kgrel:part-of:数的认识:na", 1.0, "anchor"), ("kgrel:requires:角:数的认识", 0.84, "featured")}
    assert [r.target_name for r in rest.collect()] == ["没有"]
    found = R.validate_groups(nodes, edges.withColumn("pos", F.lit(0)))
    assert found.count() == 0


PACK = {
    "kg.json": {"schema": "cgo.kg.v1", "kind": "kg", "id": "p"},
    "learning-pack.json": {"schema": "cgo.learning_pack.v1", "kind": "learning_pack", "id": "p", "kg_refs": [1], "objectives": ["x"], "tasks": [{}]},
    "knowledge-context.json": {"matches": [1]},
    "manifest.json": {"pack_id": "p", "artifacts": {"kg": "kg.json", "learning_pack": "learning-pack.json", "knowledge_context": "knowledge-context.json"}},
}
BAD_PACKS = {
    "missing_file": ("manifest.json", None),
    "not_an_object": ("kg.json", []),
    "constant": ("kg.json", {**PACK["kg.json"], "kind": "x"}),
    "id_differs": ("manifest.json", {**PACK["manifest.json"], "pack_id": "q"}),
    "empty_list": ("knowledge-context.json", {"matches": []}),
    "no_artifacts": ("manifest.json", {"pack_id": "p", "artifacts": []}),
    "artifact": ("manifest.json", {"pack_id": "p", "artifacts": {**PACK["manifest.json"]["artifacts"], "kg": "graph.json"}}),
    "placeholder": ("kg.json", {**PACK["kg.json"], "a": [{"b": {"c": "x TODO"}}]}),
}


def test_pack_rules_once_each(spark):
    rows = []
    for rule, change in {"sound": None, **BAD_PACKS}.items():
        files = {f: copy.deepcopy(d) for f, d in PACK.items()}
        if change:
            files[change[0]] = change[1]
        text = lambda d: json.dumps(d).replace('"p"', f'"{rule}"')  # noqa: B023, E731
        rows += [(rule, f, text(d)) for f, d in files.items() if d is not None] + [(rule, "other.json", "TODO")]
    files = spark.createDataFrame(rows, "folder string, file string, body string").select("folder", "file", F.try_parse_json("body").alias("v"))
    assert {(r.rule, r.id.split("/")[0]) for r in P.pack_rules(files).collect()} == {(k, k) for k in BAD_PACKS}


MANIFEST = {"schema": P.MANIFEST_SCHEMA, "kind": "knowledge_map", "id": "m", "title": "t", "version": "1", "owner": {"type": "user", "name": "n"}, "visibility": "public", "source_type": "s", "legacy_ids": [], "task_links": {}, "overlays": None, "assets": {"map": {"path": "a", "bytes": 3, "sha256": "0" * 64}, "x": "b"}}
BAD_MANIFESTS = {
    "constant": {"kind": "x"}, "missing_field": {"title": ""}, "owner": {"owner": {"type": "nobody", "name": "n"}}, "visibility": {"visibility": "all"}, "shape": {"legacy_ids": {}},
    "no_main_asset": {"assets": {"x": "b"}}, "asset": {"assets": {"map": {"path": "a", "bytes": "many"}}},
}


def test_manifest_rules_once_each(spark):
    docs = {"sound": MANIFEST, **{k: MANIFEST | v for k, v in BAD_MANIFESTS.items()}}
    table = spark.createDataFrame([(k, json.dumps(d)) for k, d in docs.items()], "doc string, body string").select("doc", F.try_parse_json("body").alias("v"))
    assert {(r.rule, r.id.split("#")[0]) for r in P.manifest_rules(table).collect()} == {(k, k) for k in BAD_MANIFESTS}
    odd = [{"map": {"path": " "}}, {"map": " "}, {"map": 7}, {"map": {"path": "a", "bytes": -1}}, {"map": {"path": "a", "sha256": "ABC"}}, {}, []]
    more = spark.createDataFrame([(str(k), json.dumps(MANIFEST | {"assets": a})) for k, a in enumerate(odd)], "doc string, body string").select("doc", F.try_parse_json("body").alias("v"))
    got = {(r.id.split("#")[0], r.rule, r.detail) for r in P.manifest_rules(more).where("severity = 'E'").collect()}
    assert got == {("0", "asset", "path"), ("1", "asset", "path"), ("2", "asset", "shape"), ("3", "asset", "bytes"), ("4", "asset", "sha256"), ("5", "no_assets", ""), ("6", "no_assets", "")}


def test_skills_and_curricula(spark):
    declared = spark.createDataFrame([("a", "SKILL.md"), ("a", "x.py"), ("b", "SKILL.md")], "skill string, file string")
    present = spark.createDataFrame([("a", "SKILL.md"), ("c", "SKILL.md")], "skill string, file string")
    notes = spark.createDataFrame([("a", "A", " ")], "skill string, name string, description string")
    got = {(r.rule, r.id, r.detail) for r in P.skill_rules(present, declared, notes).collect()}
    assert got == {("skill_folder", "b", "missing"), ("skill_folder", "c", "unexpected"), ("missing_file", "a", "x.py"), ("name_differs", "a", "A"), ("no_description", "a", "")}
    body = {"schema_version": "ucs-kg-v0.1", "dataset_id": "y", **{k: [] for k in P.CURRICULUM_LISTS}, "concepts": {}}
    files = spark.createDataFrame([("x", "ucs-kg.json", json.dumps(body))], "folder string, file string, body string").select("folder", "file", F.try_parse_json("body").alias("v"))
    assert {(r.rule, r.detail) for r in P.curriculum_rules(files).collect()} == {("id_differs", "y"), ("no_list", "concepts")}


def test_imported_edges(spark):
    edges = [{"from": "a", "to": "b", "type": "likes"}, {"source": "a", "target": "", "to": "c", "type": "requires", "confidence": 0, "review": {"state": "draft"}}, {"source": "a"}, 7, {"source": "x", "target": "y", "id": "own", "reason": "r", "source_refs": "s", "confidence": 0.2}]
    docs = spark.createDataFrame([("f", json.dumps({"edges": edges}))], "path string, body string").select("path", F.try_parse_json("body").alias("v"))
    got = {r.pos: (r.id[:16], r.type, r.source, r.target, r.reason == D.IMPORTED_REASON, r.source_refs, r.confidence, r.review_state) for r in D.imported_edges(docs).collect()}
    assert got == {0: ("edge:related_to:", "related_to", "a", "b", True, [], 0.55, "needs_review"), 1: ("edge:requires:a:", "requires", "a", "c", True, [], 0.75, "draft"), 4: ("own", "related_to", "x", "y", False, ["s"], 0.2, "needs_review")}


def test_headers_at_page_edges(spark):
    rows = [("d", p, t, y, y + 0.05) for p in range(50) for t, y in (("Head", 0.1), ("Middle", 0.4), (f"own {p}", 0.96), ("Foot" if p % 2 else "x", 0.84))]
    blocks = spark.createDataFrame(rows, "doc string, page int, t string, y0 double, y1 double")
    for stored in (False, True):
        store = store_in(spark) if stored else None
        assert {r.t for r in O.running_headers(blocks, "doc", "page", "t", top="y0", bottom="y1", store=store).collect()} == {"Head"}
        assert {r.t for r in O.running_headers(blocks, "doc", "page", "t", store=store_in(spark) if stored else None).collect()} == {"Head", "Middle"}


def test_layouts_by_profile(spark):
    nodes = spark.createDataFrame([("d", "domain", "geometry", 1)] + [(f"g{k}", "knowledge_group", "geometry", k) for k in range(4)], "id string, type string, domain string, ord int")
    profile = spark.createDataFrame([(0, "other", None, None), (1, "geometry", None, 3)], "pos int, domain string, y double, columns int")
    at = lambda p: {r.id: (round(r.x, 4), round(r.y, 4)) for r in K.layout(nodes, profile=p).collect()}
    assert at(profile)["d"] == (-12.0, 2.0) and at(profile)["g3"] == (-9.5, 0.82)
    assert at(None)["d"] == (-12.0, 1.7) and at(None)["g3"] == (0.5, 1.7)
    ring = {r.id: (round(r.x, 6), round(r.y, 6)) for r in K.fallback_positions(nodes.where("type <> 'domain'"), store_in(spark)).collect()}
    assert ring == {"g0": (4.0, 0.0), "g1": (0.0, 4.0), "g2": (-4.0, 0.0), "g3": (-0.0, -4.0)}
