import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph as G
from graphloom.operators import groups as K
from graphloom.operators import rules as R
from graphloom.operators.publish import GraphStore
from graphloom.sources.tables import cut, work_folder

NODE = "id string, type string, name string, subject string, stage string, curriculum string, source_refs array<string>, confidence double, review_state string, pos bigint"
EDGE = "id string, type string, source string, target string, evidence string, reason string, source_refs array<string>, confidence double, review_state string, pos bigint"


def node(i, pos=0, **kw):
    row = {"id": i, "type": "concept", "name": i, "subject": "math", "stage": "", "curriculum": "", "source_refs": ["src:a"], "confidence": 0.9, "review_state": "accepted", "pos": pos} | kw
    return tuple(row.values())


def edge(i, s, t, pos=0, **kw):
    row = {"id": i, "type": "requires", "source": s, "target": t, "evidence": "seen", "reason": None, "source_refs": ["src:a"], "confidence": 0.9, "review_state": "accepted", "pos": pos} | kw
    return tuple(row.values())


def frames(spark, nodes, edges):
    return spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, EDGE)


BASE_N = [node("a"), node("b"), node("c")]
BASE_E = [edge("e1", "a", "b"), edge("e2", "b", "c")]


def found(spark, nodes=BASE_N, edges=BASE_E, cycle=None):
    n, e = frames(spark, nodes, edges)
    sources = spark.createDataFrame([("src:a", "c1")], "source_id string, chunk_id string")
    return Counter(r.rule for r in R.validate_graph(n, e, sources, cycle).collect())


def test_a_valid_graph_has_no_findings(spark):
    assert found(spark) == {}


@pytest.mark.parametrize(
    "nodes,edges,rule",
    [
        ([*BASE_N, node("a", name="other")], BASE_E, "duplicate_id"),
        ([*BASE_N, node("", name="nameless")], BASE_E, "missing_id"),
        ([*BASE_N, node("d", type="thing")], BASE_E, "invalid_type"),
        ([*BASE_N, node("d", name=" ")], BASE_E, "missing_name"),
        ([*BASE_N, node("d", review_state="maybe")], BASE_E, "invalid_review_state"),
        ([*BASE_N, node("d", confidence=None)], BASE_E, "missing_confidence"),
        ([*BASE_N, node("d", confidence=1.5)], BASE_E, "confidence_range"),
        ([*BASE_N, node("d", confidence=float("nan"))], BASE_E, "confidence_range"),
        ([*BASE_N, node("d", source_refs=[" "])], BASE_E, "missing_refs"),
        ([*BASE_N, node("d", source_refs=["src:z"])], BASE_E, "unknown_ref"),
        ([*BASE_N, node("d", name="A ")], BASE_E, "duplicate_name"),
        (BASE_N, [*BASE_E, edge("e1", "a", "c")], "duplicate_id"),
        (BASE_N, [*BASE_E, edge("e3", "a", "zz")], "target_missing"),
        (BASE_N, [*BASE_E, edge("e3", "zz", "a")], "source_missing"),
        (BASE_N, [*BASE_E, edge("e3", "a", "a")], "self_loop"),
        (BASE_N, [*BASE_E, edge("e3", "a", "c", evidence="")], "no_evidence"),
        (BASE_N, [*BASE_E, edge("e3", "a", "c", type="related_to")], "accepted_related_to"),
        (BASE_N, [*BASE_E, edge("e3", "a", "c", type="likes")], "invalid_type"),
    ],
)
def test_one_change_one_finding(spark, nodes, edges, rule):
    assert found(spark, nodes, edges) == {rule: 1}


def test_chunks_are_excused_from_references(spark):
    assert found(spark, [*BASE_N, node("d", type="source_chunk", source_refs=[])]) == {}


def test_candidates_count_each_later_copy(spark):
    n, e = frames(spark, [node("a", 0), node("a", 1), node("a", 2)], [edge("", "x", "y")])
    assert Counter(r.rule for r in R.validate_candidates(n, e).collect()) == {"duplicate_id": 2}


def test_merge(spark):
    n, e = frames(spark, BASE_N, BASE_E)
    cn, ce = frames(
        spark,
        [node("a"), node("d", 1, review_state=""), node("f", 2, review_state="", confidence=0.5), node("g", 3, review_state="rejected"), node("d", 4)],
        [edge("", "a", "d"), edge("e1", "a", "b", 1), edge("e9", "a", "f", 2), edge("e8", "a", "d", 3, review_state="draft", source_refs=[])],
    )
    got = {(r.entity, r.pos): r.outcome for r in G.merge(n, e, cn, ce).collect()}
    assert got == {("node", 0): "exists", ("node", 1): "added", ("node", 2): "not_promotable", ("node", 3): "not_promotable", ("node", 4): "exists", ("edge", 0): "added", ("edge", 1): "exists", ("edge", 2): "endpoint_missing", ("edge", 3): "not_promotable"}


def test_a_second_merge_adds_nothing(spark):
    n, e = frames(spark, BASE_N, BASE_E)
    cn, ce = frames(spark, [node("d")], [edge("e5", "a", "d")])
    assert G.merge(n.unionByName(cn), e.unionByName(ce), cn, ce).where("outcome = 'added'").count() == 0


def test_neighbourhood(spark):
    n, e = frames(spark, [*BASE_N, node("d"), node("z")], [*BASE_E, edge("e3", "c", "d", type="part_of"), edge("e4", "c", "ghost")])
    at = lambda *a, **k: {r.id: r.depth for r in G.neighbourhood(n, e, *a, **k).collect()}
    assert at("a", 0) == {"a": 0}
    assert at("a", 2) == {"a": 0, "b": 1, "c": 2}
    assert at("c", 1) == {"c": 0, "b": 1, "d": 1}
    assert at("c", 3, directed=True) == {"c": 0, "d": 1}
    assert at("c", 1, edge_type="part_of") == {"c": 0, "d": 1}
    assert at("nobody", 2) == {}
    assert {r.id for r in G.induced(e, G.neighbourhood(n, e, "a", 2)).collect()} == {"e1", "e2"}


def test_cycles(spark):
    rows = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "a"), ("d", "d"), ("c", "x")]
    df = spark.createDataFrame(rows, "source string, target string")
    assert {r.cycle for r in G.simple_cycles(df, 4).collect()} == {"a -> b -> a", "a -> b -> c -> a", "d -> d"}
    folder = work_folder(spark)
    core = G.cyclic_core(df, lambda f, name: cut(f, name, folder))
    assert {(r.source, r.target) for r in core.collect()} == set(rows) - {("c", "x")}


def test_chain_has_no_core(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(12)], "source int, target int")
    folder = work_folder(spark)
    assert G.cyclic_core(df, lambda f, name: cut(f, name, folder)).count() == 0


def test_ancestors(spark):
    df = spark.createDataFrame([("r", ""), ("a", "r"), ("b", "a"), ("o", "gone")], "id string, parent_id string")
    assert {(r.id, r.root, r.depth, r.path) for r in G.ancestors(df).collect()} == {("r", "r", 0, "r"), ("a", "r", 1, "r/a"), ("b", "r", 2, "r/a/b"), ("o", "o", 0, "o")}


def test_gate(spark):
    n, e = frames(spark, BASE_N, BASE_E)
    good = R.row_rules(n, "node", F.col("id"), R.node_checks())
    assert R.gate(n, good).count() == 3
    bad = R.row_rules(n.withColumn("name", F.lit("")), "node", F.col("id"), R.node_checks())
    assert R.gate(n, bad).count() == 0
    assert R.summary(good).first().valid and not R.summary(bad).first().valid


# -- groups -------------------------------------------------------------------------

GROUP = "id string, type string, name string, domain string, source_refs array<string>, points array<string>, summary string, n_tasks bigint, n_misconceptions bigint, n_progression bigint, note string, confidence double, review_state string, ord bigint"


def group(i, **kw):
    row = {"id": i, "type": "knowledge_group", "name": i, "domain": "d", "source_refs": ["s"], "points": ["p"], "summary": "about", "n_tasks": 1, "n_misconceptions": 1, "n_progression": 1, "note": "", "confidence": 0.9, "review_state": "accepted", "ord": 1} | kw
    return tuple(row.values())


GROUPS = [group("d1", type="domain", points=[]), group("d2", type="domain", points=[]), group("g1"), group("g2", ord=2), group("g3", ord=3)]
LINKS = [edge(f"p{i}", f"g{i}", "d1", i, type="part_of") for i in (1, 2, 3)] + [edge("r1", "g1", "g2", 5), edge("r2", "g2", "g3", 6, type="applies_to")]


def groups(spark, rows=GROUPS, links=LINKS):
    return spark.createDataFrame(rows, GROUP), spark.createDataFrame(links, EDGE).drop("reason")


def test_groups_are_valid_and_release_ready(spark):
    n, e = groups(spark)
    rules = R.validate_groups(n, e)
    assert rules.count() == 0
    q = K.quality(n, e, R.summary(rules)).first()
    assert (q.groups, q.semantic, q.grade, q.release_ready, q.score) == (3, 2, "A", True, 100.0)


def test_a_group_without_semantic_edges(spark):
    n, e = groups(spark, links=[x for x in LINKS if x[0] != "r2"])
    assert [(r.rule, r.id) for r in R.validate_groups(n, e).collect()] == [("no_semantic_edge", "g3")]
    assert K.quality(n, e, R.summary(R.validate_groups(n, e))).first().release_ready is False
    noted, _ = groups(spark, rows=[*GROUPS[:-1], group("g3", note="alone on purpose", ord=3)])
    assert R.validate_groups(noted, e).count() == 0


def test_no_groups_is_full_marks_but_for_teaching(spark):
    n, e = groups(spark, rows=GROUPS[:2], links=[])
    q = K.quality(n, spark.createDataFrame([], e.schema), spark.createDataFrame([(0,)], "error_count bigint")).first()
    assert (q.part_source_refs, q.part_teaching) == (15.0, 0.0)


def test_layout_is_a_grid_by_domain(spark):
    n, _ = groups(spark, rows=[group(f"g{i:02}", domain="geometry", ord=1) for i in range(9)] + [group("dg", type="domain", domain="geometry")])
    at = {r.id: (round(r.x, 3), round(r.y, 3)) for r in K.layout(n).collect()}
    assert at["dg"] == (-12.0, 1.7) and at["g00"] == (-9.5, 1.7) and at["g06"] == (10.5, 1.7) and at["g07"] == (-9.5, 0.52)


def test_pairs_are_exported_once(spark):
    n, e = groups(spark, links=[*LINKS, edge("again", "g1", "g2", 9, type="extends")])
    kept, others = K.export_edges(e, K.chosen_nodes(n), R.GROUP_EDGE_TYPES)
    assert kept.count() == 5 and [r.id for r in others.collect()] == ["again"]


def test_long_chains_and_cycles_of_any_length(spark):
    chain = [(i, i + 1) for i in range(40)]
    ring = [(100 + i, 100 + (i + 1) % 9) for i in range(9)]
    edges = spark.createDataFrame([(str(a), str(b), "requires") for a, b in chain + ring], "source string, target string, type string")
    assert G.requires_cycle(edges).count() == 1
    assert G.requires_cycle(edges.where("int(source) < 100")).count() == 0
    assert G.requires_cycle(edges.withColumn("type", F.lit("extends"))).count() == 0
    assert found(spark, edges=[edge("e1", "a", "b"), edge("e2", "b", "c"), edge("e3", "c", "a")], cycle=G.requires_cycle(frames(spark, BASE_N, [edge("e1", "a", "b"), edge("e2", "b", "c"), edge("e3", "c", "a")])[1])) == {"requires_cycle": 1}


def test_a_long_cycle_in_few_rounds(spark):
    ring = [(f"r{(7 * i) % 1000:03}", f"r{(7 * i + 7) % 1000:03}") for i in range(1000)]
    tails = [(f"t{i:03}", f"t{i + 1:03}") for i in range(300)] + [("t300", "r005")] + [("r100", "u000")] + [(f"u{i:03}", f"u{i + 1:03}") for i in range(300)]
    edges = spark.createDataFrame(ring + tails + [("z", "z"), (None, "r001"), ("r001", None)], "source string, target string").repartition(4)
    folder, stored = work_folder(spark), []

    def store(df, name):
        stored.append(name)
        return cut(df, f"{name}-{len(stored)}", folder)

    found = [r.id for r in G.cycle_nodes(edges, store).orderBy("pos").collect()]
    nxt = dict(ring)
    assert found[0] == "r000" and len(found) == 1000 and all(nxt[a] == b for a, b in zip(found, [*found[1:], found[0]]))
    assert len(stored) < 90  # a logarithm of 1,600 edges, not a multiple
    told = G.requires_cycle(edges.withColumn("type", F.lit("requires"))).first()
    assert told.length == 1000 and told.cycle.startswith("r000 -> r007 -> ") and told.cycle.endswith(" -> …")
    assert G.cycle_nodes(edges.where("source like 't%' or source like 'u%'")).count() == 0
    assert [tuple(r) for r in G.cycle_nodes(edges.where("source = 'z'")).collect()] == [(0, "z")]
    assert G.cycle_nodes(edges.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_witness_is_a_cycle_where_there_is_one(spark, seed):
    rng = random.Random(seed)
    pairs = {(rng.randrange(30), rng.randrange(30)) for _ in range(26)}
    edges = spark.createDataFrame(sorted(pairs), "source int, target int")
    found = [r.id for r in G.cycle_nodes(edges).orderBy("pos").collect()]
    left, size = set(pairs), -1
    while size != len(left):
        size = len(left)
        left = {(a, b) for a, b in left if any(x == b for x, _ in left) and any(y == a for _, y in left)}
    assert bool(found) == bool(left)
    assert all(x in pairs for x in zip(found, [*found[1:], *found[:1]])) and found == sorted(set(found), key=found.index)
    assert not found or found[0] == min(found)


def test_deep_hierarchies_and_rows_on_a_cycle(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else "") for i in range(14)] + [("x", "y"), ("y", "x"), ("z", "x")]
    got = {r.id: (r.root, r.depth) for r in G.ancestors(spark.createDataFrame(rows, "id string, parent_id string")).collect()}
    assert got == {f"n{i}": ("n0", i) for i in range(14)}


def test_relations_between_names(spark):
    nodes = spark.createDataFrame([("g1", "knowledge_group", "Whole Numbers"), ("g2", "knowledge_group", "分数"), ("g3", "knowledge_group", "twice"), ("g4", "knowledge_group", "twice"), ("d", "domain", "Area")], "id string, type string, name string")
    relations = spark.createDataFrame([("Whole Numbers", "分数", "requires"), ("twice", "分数", "extends"), ("分数", "Area", "extends"), ("分数", None, "extends")], "source_name string, target_name string, type string")
    edges, rest = K.named_edges(relations, nodes)
    assert [(r.id, r.source, r.target) for r in edges.collect()] == [("kgrel:requires:whole-numbers:分数", "g1", "g2")]
    assert {(r.source_name, r.target_name) for r in rest.collect()} == {("twice", "分数"), ("分数", "Area"), ("分数", None)}
    assert [tuple(r) for r in K.repeated_names(nodes).collect()] == [("twice", 2)]
    own = nodes.where("id = 'g1'").select(K.group_id(F.lit("number"), F.lit(" 数与 运算 "), F.col("name")).alias("x"))
    assert own.first().x == "kg:number:数与-运算:whole-numbers"


def files(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in Path(path).rglob("*") if p.is_file()}


def test_merges_are_seen_whole_or_not_at_all(spark, tmp_path):
    store = GraphStore(spark, f"file://{tmp_path}/g")
    n, e = frames(spark, [node("a"), node("b", 1)], [edge("e1", "a", "b")])
    sources = spark.createDataFrame([("src:a", None)], "source_id string, chunk_id string")
    assert store.version() is None
    first = store.create(n, e, sources)
    batch = frames(spark, [node("c"), node("c", 1, name="later"), node("d", 2, review_state="rejected"), node("a", 3)], [edge("", "a", "c", pos=0), edge("x", "a", "d", pos=1), edge("e1", "b", "a", pos=2)])
    done = store.merge(batch[0].where("pos <> 1"), batch[1], spark.createDataFrame([("src:b", None), ("src:a", "c1")], "source_id string, chunk_id string"))
    assert done.merged and store.version() == done.version != first
    nodes, edges, known = store.read()
    assert {(r.id, r.name) for r in nodes.collect()} == {("a", "a"), ("b", "b"), ("c", "c")} and edges.count() == 2
    assert {r.source_id for r in known.collect()} == {"src:a", "src:b"} and known.count() == 2
    assert store.read(first)[0].count() == 2  # a reader of the old version is not disturbed
    before = {k: v for k, v in files(tmp_path).items()}
    twice = store.merge(*batch)  # an id twice in the batch
    assert not twice.merged and twice.findings.where("rule = 'duplicate_id'").count() == 1
    loop = frames(spark, [], [edge("r1", "a", "b", type="requires"), edge("r2", "b", "a", type="requires", pos=1)])
    bad = store.merge(*loop)
    assert not bad.merged and {r.rule for r in bad.findings.where("severity = 'E'").collect()} == {"requires_cycle"}
    after = files(tmp_path)
    assert {k: after[k] for k in before} == before and store.version() == done.version
    again = store.merge(batch[0].where("pos <> 1"), batch[1])
    assert again.merged and again.outcomes.where("outcome = 'added'").count() == 0
    assert {tuple(map(str, r)) for r in store.read()[0].collect()} == {tuple(map(str, r)) for r in nodes.collect()}
    store.clean()
    assert store.read()[1].count() == 2 and len(list((tmp_path / "g/versions").iterdir())) == 1
