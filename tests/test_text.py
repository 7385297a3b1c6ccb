import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.operators import curriculum as C
from graphloom.operators import grading as Q
from graphloom.operators import layout as L
from graphloom.operators import ordered as O
from graphloom.sources import documents as D
from graphloom.sources.pages import parse_page_range


def blocks(spark, sizes):
    return spark.createDataFrame([(1, i, "x" * n) for i, n in enumerate(sizes)], "doc int, pos int, t string")


@pytest.mark.parametrize("sizes,want", [([5, 5, 5], [(0, 1), (2, 2)]), ([30, 1, 1], [(0, 0), (1, 2)]), ([10, 1], [(0, 0), (1, 1)]), ([], []), ([0, 4, 0, 6, 1], [(1, 3), (4, 4)])])
def test_packing(spark, sizes, want):
    got = O.chunks(blocks(spark, sizes), "doc", "pos", "t", 10).orderBy("chunk").collect()
    assert [(r.first, r["last"]) for r in got] == want
    assert all(r.n_chars <= 10 or r.n_blocks == 1 for r in got)
    assert sum(r.n_chars for r in got) == sum(sizes)


LAYOUT = "doc int, pos bigint, id string, type string, content string, page bigint, x double, y double, width double, height double"


def elements(spark, contents):
    return spark.createDataFrame([(0, i, f"e{i}", "image" if c is None else "text", c or "", i // 4, 0.1 * i, 0.05 * i, 0.2, 0.1) for i, c in enumerate(contents)], LAYOUT)


def test_a_paper_with_a_section(spark):
    seg = O.segments(elements(spark, ["一、选择题", "1. First", "(1) part", None, "２．Second", " ", "more"]))
    got = O.problems(seg).orderBy("problem").collect()
    assert [(r.number, r.section, r.type, r.text_plain) for r in got] == [("1", "一、选择题", "choice", "1. First\n(1) part"), ("２", "一、选择题", "choice", "２．Second\nmore")]
    assert [r.page_span for r in got] == ["0", "1"]
    crops = {(r.problem, r.crop) for r in L.screenshots(seg).collect()}
    assert crops == {(1, "problem_page_0"), (1, "diagram_1"), (2, "problem_page_1")}


def test_text_without_numbers_is_one_problem(spark):
    got = O.problems(O.segments(elements(spark, ["Prove it", "and then this"]))).collect()
    assert [(r.number, r.type, r.n_elements) for r in got] == [(None, "unknown", 2)]


def test_a_header_closes_a_problem(spark):
    got = O.problems(O.segments(elements(spark, ["1. A", "二、填空题", "loose", "三、解答题"]))).orderBy("problem").collect()
    assert [(r.number, r.section) for r in got] == [("1", None), (None, "二、填空题")]


def test_figures_by_number(spark):
    e = elements(spark, ["1. A", None, "2. B", None])
    found = L.figures(L.screenshots(O.segments(e)), e)
    pick = lambda label: [(r.n, r.match) for r in L.match_figure(found, F.lit(label).cast("string")).orderBy("n").collect()]
    assert pick(None) == [(1, "all"), (2, "all")] and pick("图 2") == [(2, "matched")] and pick("图 7") == [(1, "low")]


def test_context_is_carried_and_reset(spark):
    rows = ["D1", "S1", "C1", "T1", "x", "T2", "y", "S2", "z", "C1", "w", "D9", "C2", "v"]
    df = spark.createDataFrame([(0, i, r) for i, r in enumerate(rows)], "doc int, pos int, m string")
    marks = {k: F.when(F.col("m").startswith(c), F.col("m")) for k, c in (("domain", "D"), ("stage", "S"), ("section", "C"), ("theme", "T"))}
    got = O.context_state(df, "doc", "pos", marks, ("D9", "T0")).orderBy("pos").collect()
    assert [(r.m, r.stage, r.domain, r.section, r.theme) for r in got] == [("x", "S1", "D1", "C1", "T1"), ("y", "S1", "D1", "C1", "T2"), ("v", "S2", "D9", "C2", "T0")]


def test_items(spark):
    lines = ["(1) first statement here", "goes on", "(2) x", "(3) third statement here"]
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(lines)], "doc int, pos int, t string")
    assert [(r.n, r.statement) for r in O.items(df, "doc", "pos", "t").orderBy("n").collect()] == [(1, "firststatementheregoeson"), (2, "thirdstatementhere")]


def test_running_headers(spark):
    rows = [(0, p, t) for p in range(5) for t in ("Title", f"page text {p}")]
    df = spark.createDataFrame(rows, "doc int, page int, t string")
    assert [(r.t, r.n) for r in O.running_headers(df, "doc", "page", "t").collect()] == [("Title", 5)]
    assert O.running_headers(df.where("page < 2"), "doc", "page", "t").count() == 0


def test_union_of_boxes_is_clamped(spark):
    e = spark.createDataFrame([(0, -0.2, 0.5, 0.4, 0.2), (0, 0.9, 0.1, 0.4, 0.2), (0, 0.0, 0.0, None, 1.0)], "g int, x double, y double, width double, height double")
    r = L.union_boxes(e, "g").first()
    assert (r.x, r.y, r.width, r.height, r.n_boxes) == (0.0, 0.1, 1.0, 0.6, 2)


def test_images_are_kept_once(spark):
    base = (0, 200, 200, 30_000, "h", 0.5)
    rows = [(0, *base), (1, *base), (2, 0, 90, 200, 30_000, "i", 0.5), (3, 0, 2000, 150, 60_000, "j", 0.5), (4, 0, 300, 300, 3000, "k", 0.5), (5, 0, 200, 200, 30_000, "l", 0.01)]
    df = spark.createDataFrame(rows, "pos int, doc int, width int, height int, n_bytes int, md5 string, page_share double")
    assert [r.pos for r in L.kept_images(df).collect()] == [0]


def test_page_ranges():
    assert parse_page_range("1-3,8,2") == [1, 2, 3, 8]
    for bad in ("0", "5-3", "9", ""):
        with pytest.raises(ValueError):
            parse_page_range(bad, 8)


# -- curricula -----------------------------------------------------------------------


def curriculum(spark, **change):
    parts = {
        "concepts": ([("c1", "Half", "math", "a half", "s1", "num", 0.9, ["s"], 0), ("c2", "Third", "math", "a third", "s1", "num", None, ["s"], 1)], "id string, name string, subject string, definition string, stage string, domain string, confidence double, standard_ids array<string>, pos bigint"),
        "standards": ([("s", "f", "cur:main", "book", "State", 0)], "id string, framework_id string, curriculum_id string, source string, statement string, pos bigint"),
        "frameworks": ([("f", "", "cur:main", "F", 0)], "id string, parent_id string, curriculum_id string, name string, pos bigint"),
        "competencies": ([("k", "Skill", "math", "able", None, 0)], "id string, name string, subject string, description string, confidence double, pos bigint"),
        "evidence": ([("v1", "c1", "", "shows", None, 0), ("v2", "c2", "", "shows", 0.5, 1)], "id string, concept_id string, subject string, statement string, confidence double, pos bigint"),
        "relations": ([("r", "prerequisite_for", "c1", "c2", "why", 0.9, None, 0)], "id string, type string, source_id string, target_id string, rationale string, confidence double, hint string, pos bigint"),
    }
    parts["curricula"] = ([("cur:main", "Main")], "id string, name string")
    for k, rows in change.items():
        parts[k] = (rows, parts[k][1])
    return [spark.createDataFrame(*p) for p in parts.values()]


def test_curriculum_export(spark):
    c, s, f, k, v, r, u = curriculum(spark)
    assert C.validate(c, s, f, k, v, r, u).count() == 0
    nodes = C.concept_nodes(c, "ds").unionByName(C.competency_nodes(k, "ds")).unionByName(C.evidence_nodes(v, c, "ds"))
    assert sorted(x.type for x in nodes.collect()) == ["assessment", "assessment", "concept", "concept", "skill"]
    assert {x.id: x.confidence for x in nodes.collect()} == {"c1": 0.9, "c2": 0.82, "k": 0.8, "v1": 0.75, "v2": 0.5}
    edges = C.relation_edges(r, nodes, "ds").unionByName(C.evidence_edges(v, nodes))
    assert sorted(x.type for x in edges.collect()) == ["assesses", "assesses", "requires"]
    assert C.source_chunks(s, c, k, v, r, most=3).count() == 3


@pytest.mark.parametrize(
    "change,rule",
    [
        ({"relations": [("r", "requires", "c1", "gone", "why", 0.9, None, 0)]}, "relation_end"),
        ({"relations": [("r", "requires", "c1", "c2", "", 0.5, None, 0)]}, "no_rationale"),
        ({"standards": [("s", "f", "cur:main", None, "State", 0)]}, "no_source"),
        ({"standards": [("s", "f", "cur:x", "book", "State", 0)]}, "curriculum_id"),
        ({"curricula": [("cur:y", "Other")]}, "curriculum_id curriculum_id"),  # of the standard and of the framework
        ({"frameworks": [("f", "up", "cur:main", "F", 0)]}, "parent_id"),
        ({"competencies": [("c1", "Skill", "math", "able", None, 0)]}, "duplicate_id"),
        ({"competencies": [("k", "Skill", "math", "able", 1.5, 0)]}, "confidence_range"),
    ],
)
def test_one_change_in_a_curriculum(spark, change, rule):
    assert [x.rule for x in C.validate(*curriculum(spark, **change)).collect()] == rule.split()


def test_tasks_and_alignments_of_a_curriculum(spark):
    tasks = spark.createDataFrame([("t1", ["c1", "gone"], ["k"]), ("t2", [], ["none"])], "id string, concept_ids array<string>, competency_ids array<string>")
    links = spark.createDataFrame([("a1", "c1", "elsewhere", "why", 0.9, "other"), ("a2", "c9", "c1", " ", 0.9, None)], "id string, source_id string, target_id string, rationale string, confidence double, hint string")
    found = C.validate(*curriculum(spark), tasks=tasks, alignments=links)
    assert {(r.rule, r.severity, r.id, r.detail) for r in found.collect()} == {("concept_id", "E", "t1", "gone"), ("competency_id", "E", "t2", "none"), ("relation_end", "E", "a2", "source_id:c9"), ("no_rationale", "W", "a2", "")}


def test_a_hint_excuses_a_missing_target(spark):
    assert C.validate(*curriculum(spark, relations=[("r", "requires", "c1", "gone", "why", 0.9, "other", 0)])).count() == 0


# -- files -----------------------------------------------------------------------------


def test_json_graph_files(spark, tmp_path):
    kg = {"nodes": [{"id": "n", "type": "concept", "name": "N", "source_refs": "src:a", "confidence": "0.5", "review": {"state": "draft"}}, "junk", {"id": "m", "grade_band": "1-2", "properties": {"x": 1}}], "edges": [{"id": "e", "source": "n", "target": "m"}], "sources": [{"id": "src:a", "chunks": [{"id": "c1"}]}, {"id": "src:b"}]}
    (tmp_path / "kg.json").write_text(json.dumps(kg))
    (tmp_path / "list.json").write_text("[1, 2]")
    docs = D.json_documents(spark, str(tmp_path))
    assert docs.count() == 1
    nodes = {r.id: r for r in D.graph_nodes(docs).collect()}
    assert nodes["n"].source_refs == ["src:a"] and nodes["n"].confidence == 0.5 and nodes["n"].review_state == "draft"
    assert nodes["m"].pos == 2 and nodes["m"].properties == '{"x":1}' and nodes["m"].source_refs == []
    assert [(r.source, r.target) for r in D.graph_edges(docs).collect()] == [("n", "m")]
    assert {(r.source_id, r.chunk_id) for r in D.graph_sources(docs).collect()} == {("src:a", "c1"), ("src:b", None)}
    assert {r.id: r.confidence for r in D.imported(docs).collect()} == {"n": 0.5, "m": 0.75}


def test_text_files_and_front_matter(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nname: \"Pack\"\n---\n# T\n\nOne\n\n \nTwo\n")
    (tmp_path / "b.txt").write_text("plain")
    files = D.text_files(spark, str(tmp_path))
    assert sorted(r.type for r in files.collect()) == ["markdown", "text"]
    md = files.where("type = 'markdown'")
    assert md.select(D.front_matter_field(F.col("value"), "name").alias("n")).first().n == "Pack"
    assert [r.chunk_id for r in D.ingested(md, "path", "value").collect()] == ["c001", "c002", "c003"]


def test_page_cache(spark, tmp_path):
    for n, page in ((23, {"source": {"pdf_page": 23}, "text": "keep（a）\n12\n续表"}), (24, {"text": "by name"}), (99, {"source": {"pdf_page": 99}, "text": "out"})):
        (tmp_path / f"page-{n:03}.json").write_text(json.dumps(page))
    got = {(r.page, r.line) for r in D.page_lines(spark, str(tmp_path), 23, 30).collect()}
    assert got == {(23, "keep(a)"), (24, "by name")}


def test_layout_files_in_argument_order(spark, tmp_path):
    for name, text in (("b.json", "first"), ("a.json", "second")):
        (tmp_path / name).write_text(json.dumps({"elements": [{"id": "x", "type": "text", "content": text, "bbox": {"x": 0.1, "y": 0.1, "width": 0.2, "height": 0.1}}]}))
    rows = D.layout_pages(spark, [str(tmp_path / "b.json"), str(tmp_path / "a.json")]).orderBy("page").collect()
    assert [(r.page, r.content) for r in rows] == [(0, "first"), (1, "second")]


def test_manifest_and_file_rules(spark, tmp_path):
    (tmp_path / "knowledge-group-map-data.json").write_text("{}")
    (tmp_path / "My File.txt").write_text("x")
    (tmp_path / "Page.PDF").write_text("x")
    (tmp_path / "Scanned page.md").write_text("x")
    (tmp_path / ".PNG").write_text("x")
    (tmp_path / "tool.exe").write_text("x")
    (tmp_path / "tmp").mkdir()
    (tmp_path / "tmp" / "x.jpg").write_text("x")
    (tmp_path / ".DS_Store").write_text("x")
    files = D.tree(spark, str(tmp_path))
    assets = {r.asset: r for r in D.manifest(files).collect()}
    assert assets["group_map"].bytes == 2 and len(assets["group_map"].sha256) == 64 and "my_file" in assets
    assert sorted(r.problem for r in D.file_policy(files, f"file:{tmp_path}").collect()) == ["extension", "leftover", "name"]
    assert D.manifest_rules(D.manifest(files.where("sha256 is not null"))).count() == 0
    bad = spark.createDataFrame([("a", " ", -1, "zz")], "asset string, path string, bytes bigint, sha256 string")
    assert sorted(r.problem for r in D.manifest_rules(bad).collect()) == ["bytes", "path", "sha256"]


def test_write_json(spark, tmp_path):
    D.write_json(spark.createDataFrame([("a", None)], "id string, n int"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == '{"id":"a"}'


# -- grading ----------------------------------------------------------------------------


def test_grading(spark):
    df = spark.createDataFrame([(" B ", ["a", "c", "x"], "3.05", "x + 1")], "s string, l array<string>, n string, e string")
    r = df.select(
        Q.exact(F.col("s"), F.array(F.lit("b"))).alias("strict"),
        Q.exact(F.col("s"), F.array(F.lit("b")), case_sensitive=False).alias("loose"),
        Q.set_score(F.col("l"), F.array(*map(F.lit, "abcd")), 4.0).alias("set"),
        Q.set_score(F.col("l"), F.array(*map(F.lit, "abcd")), 4.0, partial=False).alias("all"),
        Q.numeric(F.col("n"), F.lit(3.0), 0.1).alias("near"),
        Q.numeric(F.col("s"), F.lit(3.0), 0.1).alias("word"),
        Q.expression(F.col("e"), F.lit("x+1")).alias("same"),
        Q.expression(F.col("e"), F.lit("1+x")).alias("unknown"),
        Q.rubric(F.array(F.lit(2.0), F.lit(-1.0), F.lit(9.0)), F.array(F.lit(3.0), F.lit(3.0), F.lit(3.0))).alias("points"),
    ).first()
    assert tuple(r) == (False, True, 1.0, 0.0, True, False, True, None, 5.0)
    assert Q.delivered(["id", "answer_key"]) == ["id"]


def test_pack_rules(spark):
    good = '{"schema": "s", "kind": "learning_pack", "id": "a", "title": "t", "version": "1", "kg_refs": [1], "objectives": ["o"], "tasks": [{}], "remediations": null}'
    bad = '{"schema": 1, "id": " ", "title": 3, "kg_refs": [], "objectives": "o", "tasks": null, "misconceptions": "m", "remediations": []}'
    rows = [("good", good), ("bad", bad), ("list", "[1]"), ("broken", "{"), ("none", None)]
    packs = spark.createDataFrame(rows, "pack string, raw string").select("pack", F.try_parse_json("raw").alias("v"))
    got = Counter(r.pack for r in D.pack_rules(packs, "s").collect())
    assert got == {"bad": 9, "list": 1, "broken": 1, "none": 1}
