"""Rules of question documents that a schema cannot state.

The documents' trees are opened once (``trees.tree``); every rule is then a join
or an aggregate over paths, for all documents together.  Findings are rows of
``rule, severity, entity, id, detail``: ``id`` is the document and the JSON
pointer of what is wrong, ``detail`` the value.

A document without a field that a rule reads does not break that rule (the
schema asks for fields); numbers that are none are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.graph import _stored
from graphloom.operators.rules import union, violations
from graphloom.operators.trees import merged, objects, tree

ITEM = r"^(/items/\d+)+$"
RESPONSE = r"^(/items/\d+)+/responses/\d+$"
GRADING = r"^/answerKey/[^/]+/grading/[^/]+$"
ACTION = r"/actions/\d+/assetId$"


def items(nodes: DataFrame, objs: DataFrame | None = None) -> DataFrame:
    """``doc, path, depth, kind, id, points`` of the items of all documents, groups and questions, at any depth."""
    objs = objects(nodes) if objs is None else objs
    f = F.col("f")
    own = objs.where(F.col("path").rlike(ITEM))
    return own.select("doc", "path", ((F.size(F.split("path", "/")) - 1) / 2).cast("bigint").alias("depth"), f["kind"].alias("kind"), f["id"].alias("id"), f["points"].try_cast("double").alias("points"))


def _owner(path: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def _found(df: DataFrame, rule: str, entity: str, detail: Column | str | None) -> DataFrame:
    return violations(df, rule, "E", entity, F.concat_ws("#", F.col("doc").cast("string"), F.col("path")), F.col(detail) if isinstance(detail, str) else detail)


def _repeated(df: DataFrame, rule: str, entity: str, *scope: str) -> DataFrame:
    """An id that several in one scope have: named by the first place."""
    return _found(df.where("id is not null").groupBy("doc", *scope, "id").agg(F.min("path").alias("path"), F.count("*").alias("n")).where("n > 1"), rule, entity, "id")


def _absent(df: DataFrame, known: DataFrame, rule: str, entity: str, *key: str) -> DataFrame:
    return _found(merged(df, known.select("doc", *key).distinct(), ["doc", *key], "left_anti"), rule, entity, key[-1])


def fallback_ends(widgets: DataFrame, store=None) -> DataFrame:
    """Widgets that fall back on themselves, through however many others:
    ``doc, id``.  Each widget points at one asset, so following pointers, twice
    as far each round, leaves after a logarithm of rounds only those on a circle."""
    store = store or _stored(widgets)
    step = store(widgets.select("doc", "id", F.col("to").alias("at")), "fallbacks")
    # only widgets whose target is a widget go on; after n steps of n widgets, what still goes on ends on a circle
    most = step.groupBy("doc").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    far, reach, k = step, 1, 0
    while reach < most:
        ahead = far.select("doc", F.col("id").alias("at"), F.col("at").alias("_next"))
        far = store(merged(far, ahead, ["doc", "at"]).select("doc", "id", F.col("_next").alias("at")), f"fallback_round{k}")
        reach, k = reach * 2, k + 1
    ends = merged(far, step.select("doc", F.col("id").alias("at")), ["doc", "at"], "left_semi")
    return ends.select("doc", F.col("at").alias("id")).distinct()


def semantic_rules(docs: DataFrame, doc: str = "doc", value: str = "v", store=None) -> DataFrame:
    """All fifteen rules over documents in ``value`` (variants).  What several rules
    read is stored, and each rule runs as a job of its own: in one plan their joins
    would all be planned and watched by the driver at once.  Nothing is broadcast."""
    store = store or _stored(docs)
    nodes = store(tree(docs, doc, value, store), "nodes")
    objs = store(objects(nodes), "objects")
    f = F.col("f")
    its = store(items(nodes, objs), "items")
    questions = its.where("kind = 'question'")
    assets = merged(objs.where(F.col("path").rlike("^/assets/[^/]+$")), nodes.select("doc", "path", "key"), ["doc", "path"]).select("doc", "path", F.col("key").alias("id"), f["type"].alias("type"), f["fallbackAssetId"].alias("to"))
    assets = store(assets, "assets")
    responses = objs.where(F.col("path").rlike(RESPONSE)).select("doc", "path", _owner(F.col("path"), r"^(.*)/responses/\d+$").alias("question"), f["id"].alias("response"), f["type"].alias("type"), "f")
    responses = store(responses, "responses")
    keyed = nodes.where(F.col("path").rlike(r"^/answerKey/[^/]+$")).select("doc", "path", F.col("key").alias("id"))
    graded = nodes.where(F.col("path").rlike(GRADING)).select("doc", "path", "parent", F.col("key").alias("response"))
    owner = merged(keyed.select("doc", F.concat("path", F.lit("/grading")).alias("parent"), "id"), questions.select("doc", "id", F.col("path").alias("question")), ["doc", "id"])
    graded = store(merged(graded, owner, ["doc", "parent"], "left"), "graded")
    scalars = nodes.where("text is not null")

    uses = scalars.where("key = 'assetId'").select("doc", "path", F.col("text").alias("id"))
    action = F.col("path").rlike(ACTION)
    placed = scalars.where("key = 'responseId'").select("doc", "path", _owner(F.col("path"), r"^((?:/items/\d+)+)/content/").alias("question"), F.col("text").alias("response")).where("question is not null")

    choices = responses.where("type = 'choice'")
    options = objs.where(F.col("path").rlike(r"/options/\d+$")).select("doc", _owner(F.col("path"), r"^(.*)/options/\d+$").alias("at"), f["id"].alias("option"))
    options = store(options, "options")
    marked = scalars.where(F.col("path").rlike(r"^/answerKey/[^/]+/grading/[^/]+/(accepted|expected)(/\d+)*$")).select("doc", "path", _owner(F.col("path"), r"^(/answerKey/[^/]+/grading/[^/]+)/").alias("rule"), F.col("text").alias("option"))
    rules_of = merged(graded.select("doc", F.col("path").alias("rule"), "question", "response"), choices.select("doc", "question", "response", F.col("path").alias("at")), ["doc", "question", "response"])
    marked = merged(marked, rules_of.select("doc", "rule", "at"), ["doc", "rule"])

    n_responses = responses.groupBy("doc", "question").agg(F.count("*").alias("n"))
    rule_points = merged(graded, objs.select("doc", "path", f["points"].try_cast("double").alias("p")), ["doc", "path"], "left").where("question is not null")
    complete = merged(rule_points, responses.select("doc", "question", "response"), ["doc", "question", "response"], "left_semi").groupBy("doc", "question").agg(F.count("p").alias("with_points"), F.sum("p").alias("total"))
    scored = merged(questions.select("doc", F.col("path").alias("question"), "path", "points"), n_responses, ["doc", "question"])
    scored = merged(scored, complete, ["doc", "question"]).where("with_points = n and points is not null")

    rubrics = objs.where((f["type"] == "rubric") & F.col("path").rlike("/grading")).select("doc", "path", f["points"].try_cast("double").alias("points"))
    criteria = objs.where(F.col("path").rlike(r"/criteria/\d+$")).groupBy("doc", _owner(F.col("path"), r"^(.*)/criteria/\d+$").alias("path")).agg(F.sum(f["points"].try_cast("double")).alias("sum"))
    rubrics = merged(rubrics, criteria, ["doc", "path"], "left").where(F.abs(F.coalesce("sum", F.lit(0.0)) - F.col("points")) > 1e-9)

    widgets = store(assets.where("type = 'widget'"), "widgets")
    to_widget = merged(widgets, widgets.select("doc", F.col("id").alias("to")), ["doc", "to"], "left_semi")

    groups = its.where("kind = 'group'")
    children = its.select("doc", _owner(F.col("path"), r"^(.*)/items/\d+$").alias("path")).where("path is not null")
    methods = objs.where(F.col("path").rlike(r"/solution/methods/\d+$")).select("doc", "path", _owner(F.col("path"), r"^(.*)/\d+$").alias("scope"), f["id"].alias("id"))
    steps = objs.where(F.col("path").rlike(r"/solution/methods/\d+/steps/\d+$")).select("doc", "path", _owner(F.col("path"), r"^(.*)/\d+$").alias("scope"), f["id"].alias("id"))

    entries = nodes.groupBy("doc", "parent").agg(F.count("*").alias("n"))
    tables = objs.where(f["type"] == "table").select("doc", F.col("path").alias("table"), F.concat("path", F.lit("/columns")).alias("parent"))
    tables = merged(tables, entries.withColumnRenamed("n", "columns"), ["doc", "parent"], "left").select("doc", F.concat("table", F.lit("/rows")).alias("parent"), F.coalesce("columns", F.lit(0)).alias("columns"))
    rows = merged(nodes.where("kind = 'array'"), tables, ["doc", "parent"]).select("doc", "path", "columns")
    rows = merged(rows, entries.withColumnRenamed("parent", "path"), ["doc", "path"], "left")

    number = lambda c: f[c].try_cast("double")
    ranges = responses.where((F.col("type") == "number") & (number("min") > number("max")))
    counted = merged(choices, options.groupBy("doc", F.col("at").alias("path")).agg(F.count("*").alias("n_options")), ["doc", "path"], "left").select("doc", "path", number("minSelections").alias("lo"), number("maxSelections").alias("hi"), F.coalesce("n_options", F.lit(0)).alias("n"))
    bad = (F.col("lo") < 0) | (F.col("hi") < 0) | (F.col("lo") > F.col("hi")) | (F.col("lo") > F.col("n")) | (F.col("hi") > F.col("n"))
    counted = counted.where(F.coalesce(bad, (F.col("lo") < 0) | (F.col("lo") > F.col("n")), (F.col("hi") < 0) | (F.col("hi") > F.col("n")), F.lit(False)))

    found = [
        _repeated(its, "item_id_repeated", "item"),
        _absent(uses.where(~action), assets, "asset_not_found", "content", "id"),
        _absent(placed, responses, "response_not_found", "content", "question", "response"),
        _absent(keyed, questions, "question_not_found", "answer", "id"),
        _absent(graded.where("question is not null"), responses, "graded_response_not_found", "grading", "question", "response"),
        _absent(marked, options, "option_not_found", "grading", "at", "option"),
        _found(scored.where(F.abs(F.col("total") - F.col("points")) > 1e-9), "points_differ", "question", F.col("total").cast("decimal(18,2)")),
        _found(rubrics, "rubric_points_differ", "grading", F.coalesce("sum", F.lit(0.0)).cast("decimal(18,2)")),
        _found(widgets.where("to is null"), "fallback_missing", "asset", None),
        _absent(widgets.where("to is not null").select("doc", "path", F.col("to").alias("id")), assets, "fallback_missing", "asset", "id"),
        _found(to_widget, "fallback_is_widget", "asset", "to"),
        _found(merged(widgets, fallback_ends(widgets, store), ["doc", "id"], "left_semi"), "fallback_circle", "asset", "id"),
        _absent(uses.where(action), assets, "action_asset_not_found", "action", "id"),
        _found(merged(groups, children, ["doc", "path"], "left_anti"), "group_empty", "item", "id"),
        _repeated(methods, "method_id_repeated", "method", "scope"),
        _repeated(steps, "step_id_repeated", "step", "scope"),
        _found(rows.where(F.coalesce("n", F.lit(0)) != F.col("columns")), "cells_differ", "table", F.coalesce("n", F.lit(0))),
        _found(ranges, "number_range", "response", number("min").cast("decimal(18,2)")),
        _found(counted, "choice_range", "response", "n"),
    ]
    return union(*(store(rule, f"found{k}") for k, rule in enumerate(found)))
