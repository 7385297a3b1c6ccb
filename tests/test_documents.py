"""Documents as trees: nodes at any depth, placeholders, rules of question documents."""

import copy
import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.operators import qij, trees
from graphloom.sources.tables import cut, work_folder


def parsed(spark, docs):
    rows = [(k, json.dumps(d) if not isinstance(d, str) else d) for k, d in docs.items()]
    return spark.createDataFrame(rows, "doc string, body string").select("doc", F.try_parse_json("body").alias("v"))


def walked(value, path=""):
    out = []
    entries = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for key, x in entries:
        own = f"{path}/{str(key).replace('~', '~0').replace('/', '~1')}"
        kind = "object" if isinstance(x, dict) else "array" if isinstance(x, list) else "null" if x is None else "boolean" if isinstance(x, bool) else "string" if isinstance(x, str) else "number"
        out += [(own, path, str(key), kind, x if kind == "string" else str(x).lower() if kind in ("boolean", "number") else None), *walked(x, own)]
    return out


def test_all_nodes_at_any_depth(spark):
    deep = "end"
    for k in range(12):
        deep = {"a/b~": [deep, k]} if k % 2 else [{"x": deep}, None, True]
    docs = {"deep": deep, "flat": {"n": 1, "t": "", "e": {}, "l": []}, "list": [1, 2.5], "none": {}, "scalar": '"text"', "bad": "{not json", "null": "null"}
    got = Counter((r.doc, r.path, r.parent, r.key, r.kind, r.text) for r in trees.tree(parsed(spark, docs)).collect())
    want = Counter((k, *x) for k, d in docs.items() if not isinstance(d, str) for x in walked(d))
    assert got == want


def test_placeholders_three_levels_down(spark):
    docs = {"a": {"x": [{"y": {"z": "still TODO here"}}, "fine"], "TODO": 1}, "b": {"t": "[待补充] TODO"}, "c": {"t": "ok"}}
    got = {(r.doc, r.path, r.marker) for r in trees.placeholders(trees.tree(parsed(spark, docs)), ("TODO", "[待补充]")).collect()}
    assert got == {("a", "/x/0/y/z", "TODO"), ("b", "/t", "TODO"), ("b", "/t", "[待补充]")}


def test_names_both_ways(spark):
    a, b = (spark.createDataFrame([(x,) for x in t], "name string") for t in (["p", "q", "q"], ["q", "r"]))
    assert {tuple(r) for r in trees.compared_names(a, b, "name").collect()} == {("p", "declared"), ("r", "present")}


QUESTION = {
    "kind": "question", "id": "q1", "points": 2,
    "content": [{"type": "asset", "assetId": "fig"}, {"type": "response", "responseId": "a"}, {"type": "table", "columns": ["x", "y"], "rows": [[1, 2], [3, None]]}],
    "responses": [{"id": "a", "type": "choice", "minSelections": 1, "maxSelections": 2, "options": [{"id": "A"}, {"id": "B"}]}, {"id": "b", "type": "number", "min": 0, "max": 1}],
}
SOUND = {
    "items": [{"kind": "group", "id": "g", "content": [], "items": [{"kind": "group", "id": "h", "items": [QUESTION]}]}],
    "assets": {"fig": {"type": "image"}, "w": {"type": "widget", "fallbackAssetId": "fig"}},
    "answerKey": {"q1": {
        "grading": {"a": {"type": "exact", "accepted": ["A"], "points": 1}, "b": {"type": "rubric", "points": 1, "criteria": [{"id": "x", "points": 0.5}, {"id": "y", "points": 0.5}]}},
        "solution": {"methods": [{"id": "m", "steps": [{"id": "s", "actions": [{"assetId": "w"}]}, {"id": "t"}]}, {"id": "n", "steps": [{"id": "s"}]}]},
    }},
}
Q = ("items", 0, "items", 0, "items", 0)
SPOILED = {
    "item_id_repeated": [((*Q, "id"), "h")],
    "asset_not_found": [((*Q, "content", 0, "assetId"), "gone")],
    "response_not_found": [((*Q, "content", 1, "responseId"), "z")],
    "question_not_found": [(("answerKey", "q9"), {"grading": {}})],
    "graded_response_not_found": [(("answerKey", "q1", "grading", "c"), {"type": "manual", "points": 0})],
    "option_not_found": [(("answerKey", "q1", "grading", "a", "accepted"), [["A", "C"]])],
    "points_differ": [((*Q, "points"), 3)],
    "rubric_points_differ": [(("answerKey", "q1", "grading", "b", "criteria", 0, "points"), 0.25)],
    "fallback_missing": [(("assets", "w"), {"type": "widget"})],
    "fallback_is_widget": [(("assets", "v"), {"type": "widget", "fallbackAssetId": "w"})],
    "fallback_circle": [(("assets", "w", "fallbackAssetId"), "w")],
    "action_asset_not_found": [(("answerKey", "q1", "solution", "methods", 0, "steps", 0, "actions", 0, "assetId"), "gone")],
    "group_empty": [(("items", 1), {"kind": "group", "id": "e", "items": []})],
    "method_id_repeated": [(("answerKey", "q1", "solution", "methods", 1, "id"), "m")],
    "step_id_repeated": [(("answerKey", "q1", "solution", "methods", 0, "steps", 1, "id"), "s")],
    "cells_differ": [((*Q, "content", 2, "rows", 0), [1])],
    "number_range": [((*Q, "responses", 1, "min"), 2)],
    "choice_range": [((*Q, "responses", 0, "maxSelections"), 3)],
}


def spoiled(changes):
    doc = copy.deepcopy(SOUND)
    for way, value in changes:
        at = doc
        for k in way[:-1]:
            at = at[k]
        if isinstance(at, list) and way[-1] == len(at):
            at.append(value)
        else:
            at[way[-1]] = value
    return doc


def test_each_rule_once(spark):
    docs = {"sound": SOUND, "empty": {}, **{k: spoiled(v) for k, v in SPOILED.items()}}
    found = qij.semantic_rules(parsed(spark, docs)).collect()
    got = {(r.rule, r.id.split("#")[0]) for r in found}
    also = {("question_not_found", "item_id_repeated"), ("fallback_is_widget", "fallback_circle")}
    # a question under another id is no longer that of the answers
    assert got == {(k, k) for k in SPOILED} | also
    places = {r.rule: r.id.split("#")[1] for r in found if r.id.startswith(r.rule + "#")}
    assert places["asset_not_found"] == "/items/0/items/0/items/0/content/0/assetId" and places["cells_differ"] == "/items/0/items/0/items/0/content/2/rows/0"


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_long_fallback_circles(spark, n):
    ring = {f"w{i}": {"type": "widget", "fallbackAssetId": f"w{(i + 1) % n}"} for i in range(n)}
    tail = {f"t{i}": {"type": "widget", "fallbackAssetId": f"t{i + 1}" if i < 5 else "w0"} for i in range(6)}
    line = {f"l{i}": {"type": "widget", "fallbackAssetId": f"l{i + 1}"} for i in range(9)} | {"l9": {"type": "image"}}
    found = qij.semantic_rules(parsed(spark, {"d": {"assets": ring | tail | line}})).where("rule = 'fallback_circle'").collect()
    assert sorted(r.detail for r in found) == sorted(ring)


def test_rules_are_jobs_of_their_own(spark):
    """No plan holds the joins of many rules: the driver would broadcast and watch them all at once."""
    plans, folder = [], work_folder(spark)

    def store(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df, name, folder)

    found = qij.semantic_rules(parsed(spark, {"sound": SOUND}), store=store)
    plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    assert "Join" not in plans[-1] and "Aggregate" not in plans[-1]
    assert max(len(re.findall(r"\bJoin\b", x)) for x in plans) <= 4


def test_rules_broadcast_nothing(spark):
    """Small files of repetitive rows are large tables: the driver must not gather any for a join."""
    plans, folder = [], work_folder(spark)

    def store(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name, folder)

    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 0
    qij.semantic_rules(parsed(spark, {"sound": SOUND, "circle": {"assets": {"w": {"type": "widget", "fallbackAssetId": "w"}}}}), store=store)
    assert sum(x.count("SortMergeJoin") for x in plans) > 20
    assert not [x for x in plans if "Broadcast" in x]


def test_rules_over_nothing(spark):
    assert qij.semantic_rules(spark.createDataFrame([], "doc string, body string").select("doc", F.try_parse_json("body").alias("v"))).count() == 0
