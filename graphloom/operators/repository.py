"""Rules over the files of content repositories: packs, curricula, skills, manifests.

Input are tables of files, ``folder, file, v`` with the parsed document (null
where it is none), or the trees of such documents.  What is demanded (files,
names, fields) is a parameter.  Findings are rows of ``rule, severity, entity,
id, detail``; ``id`` is folder and file, or the folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import text
from graphloom.operators.graph import _stored
from graphloom.operators.rules import union, violations
from graphloom.operators.trees import compared_names, placeholders, tree

#: What a pack holds, what its files say of themselves, and which lists must have entries; marks of unfinished text; what a curriculum must list.
PACK_FILES = ("kg.json", "learning-pack.json", "knowledge-context.json", "manifest.json")
PACK_CONSTANTS = {"kg.json": {"schema": "cgo.kg.v1", "kind": "kg"}, "learning-pack.json": {"schema": "cgo.learning_pack.v1", "kind": "learning_pack"}}
PACK_IDS = {"kg.json": "id", "learning-pack.json": "id", "manifest.json": "pack_id"}
PACK_LISTS = {"learning-pack.json": ("kg_refs", "objectives", "tasks"), "knowledge-context.json": ("matches",)}
PACK_ARTIFACTS = {"kg": "kg.json", "learning_pack": "learning-pack.json", "knowledge_context": "knowledge-context.json"}
MARKERS = ("[待补充]", "TODO")
CURRICULUM_LISTS = ("curricula", "framework_nodes", "standard_items", "concepts", "relations")
#: What a manifest of a knowledge map must say.
MANIFEST_SCHEMA, MANIFEST_KIND = "cgo.knowledge-map.manifest.v1", "knowledge_map"
MANIFEST_FIELDS = ("id", "title", "version", "owner", "visibility", "source_type", "assets")
OWNER_TYPES = ("official", "user", "shared", "local")
VISIBILITIES = ("public", "private", "shared", "draft")
MAIN_ASSETS = ("group_map", "map", "kg")


def _at(folder: str = "folder", file: str = "file") -> Column:
    return F.concat_ws("/", folder, file)


def _literal(df: DataFrame, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """Each row of ``df`` with each of a few literal ones."""
    return df.select("*", F.explode(F.array(*(F.struct(*(F.lit(x).alias(n) for x, n in zip(r, names))) for r in rows))).alias("_x")).select(*df.columns, "_x.*")


def _said(asked: DataFrame, nodes: DataFrame) -> DataFrame:
    """``asked`` (``folder, file, key, ..``) with ``kind`` and ``text`` of that top-level field, null if it is not there."""
    top = nodes.where("parent = ''").select("folder", "file", "key", "kind", "text")
    return asked.join(top, ["folder", "file", "key"], "left")


def folder_rules(files: DataFrame, demanded: tuple[str, ...]) -> DataFrame:
    """Demanded files that a folder lacks, and those that hold no JSON object."""
    have = files.select("folder", "file")
    asked = _literal(files.select("folder").distinct(), [(f,) for f in demanded], ("file",))
    missing = asked.join(have, ["folder", "file"], "left_anti")
    broken = files.where(F.col("file").isin(*demanded) & ~F.coalesce(F.schema_of_variant("v").like("OBJECT%"), F.lit(False)))
    return union(violations(missing, "missing_file", "E", "folder", F.col("folder"), F.col("file")), violations(broken, "not_an_object", "E", "file", _at()))


def file_trees(files: DataFrame, store=None) -> DataFrame:
    """The trees of all files that hold objects: ``folder, file, path, parent, key, kind, text``."""
    good = files.where(F.schema_of_variant("v").like("OBJECT%"))
    nodes = tree(good.withColumn("doc", F.struct("folder", "file")), "doc", "v", store)
    return nodes.select("doc.*", *(c for c in nodes.columns if c != "doc"))


def pack_rules(files: DataFrame, store=None) -> DataFrame:
    """All rules of packs: files, constants, ids, lists, artifacts, unfinished text at any depth."""
    store = store or _stored(files)
    known = files.where(F.col("file").isin(*PACK_FILES))
    nodes = store(file_trees(known, store), "file_trees")
    good = known.where(F.schema_of_variant("v").like("OBJECT%")).select("folder", "file").distinct()
    constants = _said(_literal(good, [(f, k, v) for f, own in PACK_CONSTANTS.items() for k, v in own.items()], ("_file", "key", "want")).where("file = _file"), nodes)
    ids = _said(_literal(good, list(PACK_IDS.items()), ("_file", "key")).where("file = _file"), nodes)
    lists = _said(_literal(good, [(f, k) for f, own in PACK_LISTS.items() for k in own], ("_file", "key")).where("file = _file"), nodes)
    filled = nodes.where("path rlike '^/[^/]+/0$'").select("folder", "file", F.substring("parent", 2, 1 << 20).alias("key")).distinct()
    lists = lists.join(filled.withColumn("_filled", F.lit(True)), ["folder", "file", "key"], "left")
    mapping = _said(good.where("file = 'manifest.json'").withColumn("key", F.lit("artifacts")), nodes)
    told = nodes.where("file = 'manifest.json' and parent = '/artifacts'").select("folder", "key", "text")
    artifacts = _literal(mapping.where("kind = 'object'").select("folder", "file"), list(PACK_ARTIFACTS.items()), ("key", "want")).join(told, ["folder", "key"], "left")
    marked = placeholders(nodes.withColumn("doc", _at()), MARKERS).select(F.concat_ws("#", "doc", "path").alias("id"), "marker").groupBy("id").agg(F.min("marker").alias("marker"))
    return union(
        folder_rules(files, PACK_FILES),
        violations(constants.where(~F.coalesce(F.col("text") == F.col("want"), F.lit(False))), "constant", "E", "file", _at(), F.col("key")),
        violations(ids.where(~F.coalesce(F.col("text") == F.col("folder"), F.lit(False))), "id_differs", "E", "file", _at(), F.col("text")),
        violations(lists.where("not coalesce(kind = 'array' and _filled, false)"), "empty_list", "E", "file", _at(), F.col("key")),
        violations(mapping.where("not coalesce(kind = 'object', false)"), "no_artifacts", "E", "file", _at()),
        violations(artifacts.where(~F.coalesce(F.col("text") == F.col("want"), F.lit(False))), "artifact", "E", "file", _at(), F.col("key")),
        violations(marked, "placeholder", "E", "text", F.col("id"), F.col("marker")),
    )


def curriculum_rules(files: DataFrame, store=None) -> DataFrame:
    """What the data set of a curriculum says of itself, and which lists it must have."""
    own = files.where("file = 'ucs-kg.json'").where(F.schema_of_variant("v").like("OBJECT%"))
    kind = lambda k: F.schema_of_variant(F.try_variant_get("v", f"$.{k}", "variant"))
    said = lambda k: F.coalesce(F.try_variant_get("v", f"$.{k}", "string"), F.lit(""))
    lists = [F.when(~F.coalesce(kind(k).like("ARRAY%"), F.lit(False)), F.lit(k)) for k in CURRICULUM_LISTS]
    return union(
        violations(own.where(said("schema_version") != "ucs-kg-v0.1"), "constant", "E", "file", _at(), F.lit("schema_version")),
        violations(own.where(said("dataset_id") != F.col("folder")), "id_differs", "E", "file", _at(), said("dataset_id")),
        violations(own.select("folder", "file", F.explode(F.array_compact(F.array(*lists))).alias("k")), "no_list", "E", "file", _at(), F.col("k")),
    )


def skill_rules(present: DataFrame, declared: DataFrame, notes: DataFrame) -> DataFrame:
    """Folders of skills, held against the declared ones both ways; demanded files
    (``skill, file`` of ``declared``; of ``present`` what is there); and the front
    matter of each (``skill, name, description``)."""
    names = compared_names(declared.select(F.col("skill").alias("name")).distinct(), present.select(F.col("skill").alias("name")).distinct(), "name")
    both = declared.join(present.select("skill").distinct(), "skill", "left_semi")
    lacking = both.join(present, ["skill", "file"], "left_anti")
    return union(
        violations(names, "skill_folder", "E", "skill", F.col("name"), F.when(F.col("side") == "declared", "missing").otherwise("unexpected")),
        violations(lacking, "missing_file", "E", "skill", F.col("skill"), F.col("file")),
        violations(notes.where(~F.coalesce(F.col("name") == F.col("skill"), F.lit(False))), "name_differs", "E", "skill", F.col("skill"), F.col("name")),
        violations(notes.where(text(F.col("description")).isNull()), "no_description", "E", "skill", F.col("skill")),
    )


def manifest_rules(docs: DataFrame, doc: str = "doc", value: str = "v", store=None) -> DataFrame:
    """All rules of manifests: constants, required fields, owner, visibility, lists and maps, each asset, and whether there is a main one."""
    store = store or _stored(docs)
    nodes = store(tree(docs, doc, value, store), "manifest_trees")
    base = docs.where(F.schema_of_variant(value).like("OBJECT%")).select(F.col(doc).alias("doc"))
    top = nodes.where("parent = ''")
    field = lambda *keys: base.select("doc", F.explode(F.array(*map(F.lit, keys))).alias("key")).join(top.select("doc", "key", "kind", "text"), ["doc", "key"], "left")
    is_ = lambda c, *want: F.coalesce(F.trim(F.col(c)).isin(*want), F.lit(False))
    constants = field("schema", "kind").where(~F.coalesce(F.col("text") == F.when(F.col("key") == "schema", MANIFEST_SCHEMA).otherwise(MANIFEST_KIND), F.lit(False)))
    absent = field(*MANIFEST_FIELDS).where("kind is null or kind = 'null' or (kind = 'string' and text = '')")
    owner = field("owner")
    owned = nodes.where("parent = '/owner'")
    inside = owner.where("kind = 'object'").select("doc", F.explode(F.array(F.lit("type"), F.lit("name"))).alias("key")).join(owned.select("doc", "key", "text"), ["doc", "key"], "left")
    bad_owner = inside.where(F.when(F.col("key") == "type", ~is_("text", *OWNER_TYPES)).otherwise(text(F.col("text")).isNull()))
    shapes = top.where("kind <> 'null'").where("(key = 'legacy_ids' and kind <> 'array') or (key in ('task_links', 'overlays') and kind <> 'object')")
    assets = nodes.where("parent = '/assets'")
    held = field("assets").join(assets.select("doc").distinct().withColumn("_some", F.lit(True)), "doc", "left")
    parts = nodes.where("parent rlike '^/assets/[^/]+$'").groupBy("doc", "parent").agg(*(F.max(F.when(F.col("key") == k, F.col("text"))).alias(k) for k in ("path", "bytes", "sha256")))
    each = _assets(assets, parts)
    size = F.col("bytes").try_cast("double")
    problems = F.array_compact(F.array(
        F.when(text(F.col("key")).isNull(), F.lit("key")),
        F.when((F.col("kind") == "string") & text(F.col("text")).isNull(), F.lit("path")),
        F.when(~F.col("kind").isin("string", "object"), F.lit("shape")),
        F.when((F.col("kind") == "object") & text(F.col("path")).isNull(), F.lit("path")),
        F.when((F.col("kind") == "object") & F.col("bytes").isNotNull() & (size.isNull() | (size <= -1)), F.lit("bytes")),
        F.when((F.col("kind") == "object") & text(F.col("sha256")).isNotNull() & ~F.trim("sha256").rlike("^[0-9a-f]{64}$"), F.lit("sha256")),
    ))
    main = base.join(assets.where(F.col("key").isin(*MAIN_ASSETS)).select("doc").distinct(), "doc", "left_anti")
    id_ = F.col("doc").cast("string")
    return union(
        violations(constants, "constant", "E", "manifest", id_, F.col("key")),
        violations(absent, "missing_field", "E", "manifest", id_, F.col("key")),
        violations(owner.where("not coalesce(kind = 'object', false)"), "owner", "E", "manifest", id_, F.lit("shape")),
        violations(bad_owner, "owner", "E", "manifest", id_, F.col("key")),
        violations(field("visibility").where(~is_("text", *VISIBILITIES)), "visibility", "E", "manifest", id_, F.col("text")),
        violations(shapes, "shape", "E", "manifest", id_, F.col("key")),
        violations(held.where("not coalesce(kind = 'object' and _some, false)"), "no_assets", "E", "manifest", id_),
        violations(each.select("doc", "key", F.explode(problems).alias("problem")), "asset", "E", "asset", F.concat_ws("#", "doc", "key"), F.col("problem")),
        violations(main, "no_main_asset", "W", "manifest", id_),
    )


def _assets(assets: DataFrame, parts: DataFrame) -> DataFrame:
    """Each asset, a text or an object, with the fields of the latter."""
    own = assets.select("doc", F.col("path").alias("parent"), "key", "kind", "text")
    return own.join(parts, ["doc", "parent"], "left")

