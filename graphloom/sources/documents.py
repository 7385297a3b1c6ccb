"""Readers and writers of JSON documents, texts, page caches and reports.

JSON is read leniently, as variants: a file must hold an object, its arrays
become rows with their position, and entries that are no objects are passed over.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import compact_text, edge_id, first_text, is_noise, ocr_fixups, paragraphs, slug_base, slugify, text
from graphloom.operators.graph import orphans, review_state
from graphloom.operators.rules import EDGE_TYPES, NODE_TYPES

#: Keys of well-known files in a manifest.
ASSET_KEYS = {"ucs-kg.json": "ucs_kg", "cgo-kg-candidates.json": "kg_candidates", "cgo-kg.json": "kg", "knowledge-groups.json": "knowledge_groups", "knowledge-map-data.json": "map", "knowledge-group-map-data.json": "group_map"}
#: Endings and parts of names that a repository must not hold, and folders that are passed over.
FORBIDDEN_ENDINGS = (".pdf", ".png", ".jpg", ".jpeg", ".gif", ".webp", ".bmp", ".tif", ".tiff", ".heic")
FORBIDDEN_NAMES = ("screenshot", "screen-shot", "screenshoot", "textbook", "publisher", "scan", "scanned", "教材", "课本", "教科书", "截图", "扫描")
IGNORED_PARTS = (".git", ".mypy_cache", ".pytest_cache", ".ruff_cache", ".venv", "__pycache__", "node_modules", "tmp")


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """``path, v``: one row for each file that holds an object."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("v"))
    return raw.where(F.schema_of_variant("v").like("OBJECT%"))


def objects(docs: DataFrame, array: str) -> DataFrame:
    """``path, pos, item`` of the objects in a top-level array."""
    items = F.try_variant_get("v", f"$.{array}", "array<variant>")
    rows = docs.select("path", F.posexplode(items).alias("pos", "item"))
    return rows.where(F.schema_of_variant("item").like("OBJECT%"))


def field(item: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(item, f"$.{path}", kind)


def list_field(item: str, path: str) -> Column:
    """A list, or one value as a list of it, or an empty list."""
    one = field(item, path)
    return F.coalesce(field(item, path, "array<string>"), F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def graph_nodes(docs: DataFrame) -> DataFrame:
    """The columns of nodes, with open maps as JSON text."""
    return objects(docs, "nodes").select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        *(field("item", c).alias(c) for c in ("id", "type", "name", "name_en", "subject", "stage", "curriculum", "domain", "grade", "difficulty", "definition", "summary")),
        *(list_field("item", c).alias(c) for c in ("aliases", "tags", "source_refs")),
        field("item", "skills", "array<string>").alias("skills"),
        field("item", "confidence", "double").alias("confidence"),
        F.coalesce(field("item", "review.state"), F.lit("")).alias("review_state"),
        field("item", "compat.external_ids.knowledge_map").alias("ext_map"),
        field("item", "compat.external_ids.product").alias("ext_product"),
        field("item", "properties").alias("properties"),
    )


def graph_edges(docs: DataFrame) -> DataFrame:
    return objects(docs, "edges").select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        *(field("item", c).alias(c) for c in ("id", "type", "source", "target", "evidence", "reason")),
        list_field("item", "source_refs").alias("source_refs"),
        field("item", "confidence", "double").alias("confidence"),
        F.coalesce(field("item", "review.state"), F.lit("")).alias("review_state"),
    )


def graph_sources(docs: DataFrame) -> DataFrame:
    """``source_id, chunk_id``, the latter null for a source's own row."""
    rows = objects(docs, "sources").select(field("item", "id").alias("source_id"), F.explode_outer(field("item", "chunks", "array<variant>")).alias("c"))
    return rows.select("source_id", field("c", "id").alias("chunk_id"))


def imported(docs: DataFrame, source: str = "") -> DataFrame:
    """Foreign node rows in the shape of candidates: defaults for what is missing,
    ``concept`` for unknown types, ``source`` for rows without a reference."""

    def own(*names: str) -> Column:
        return F.coalesce(*(F.nullif(field("item", n), F.lit("")) for n in names))

    kind, number = field("item", "type"), field("item", "confidence", "double")
    id_ = F.coalesce(own("id"), slugify(F.coalesce(own("name", "name_en"), F.lit("node"))))
    given = list_field("item", "source_refs")
    return objects(docs, "nodes").select(
        "path",
        "pos",
        id_.alias("id"),
        F.when(kind.isin(*NODE_TYPES), kind).otherwise("concept").alias("type"),
        F.coalesce(own("name", "display_name", "name_en"), id_).alias("name"),
        F.array_compact(F.array(own("display_name"), own("name_en"))).alias("aliases"),
        *(F.coalesce(own(c), F.lit("")).alias(c) for c in ("definition", "subject", "stage", "curriculum")),
        F.array_compact(F.array(own("domain"))).alias("tags"),
        F.when(F.size(given) > 0, given).otherwise(F.array(F.lit(source))).alias("source_refs"),
        F.when(F.coalesce(number, F.lit(0.0)) != 0, number).otherwise(0.75).alias("confidence"),
        F.when(F.schema_of_variant(F.try_variant_get("item", "$.review", "variant")).like("OBJECT%"), F.coalesce(field("item", "review.state"), F.lit(""))).otherwise("needs_review").alias("review_state"),
        F.col("item").alias("raw"),
    )


#: Fixed value: why an imported edge without a reason is there.
IMPORTED_REASON = "Imported edge did not provide enough relationship semantics."


def imported_edges(docs: DataFrame) -> DataFrame:
    """Foreign edge rows in the shape of candidates: either pair of names for the
    ends, ``related_to`` for unknown types, an id made of type and ends, a default
    reason, and less confidence in what is only related.  Rows without both ends go."""

    def own(*names: str) -> Column:
        return F.coalesce(*(F.nullif(field("item", n), F.lit("")) for n in names))

    rows = objects(docs, "edges").select("path", "pos", "item", own("source", "from").alias("source"), own("target", "to").alias("target"), field("item", "type").alias("_type"), field("item", "confidence", "double").alias("_conf"))
    rows = rows.where("source is not null and target is not null").withColumn("type", F.when(F.col("_type").isin(*EDGE_TYPES), F.col("_type")).otherwise("related_to"))
    less = F.when(F.col("type") == "related_to", 0.55).otherwise(0.75)
    review = F.schema_of_variant(F.try_variant_get("item", "$.review", "variant")).like("OBJECT%")
    return rows.select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        F.coalesce(own("id"), edge_id(F.col("type"), F.col("source"), F.col("target"))).alias("id"),
        "type",
        "source",
        "target",
        F.coalesce(own("evidence"), F.lit("")).alias("evidence"),
        F.coalesce(own("reason"), F.lit(IMPORTED_REASON)).alias("reason"),
        list_field("item", "source_refs").alias("source_refs"),
        F.when(F.coalesce("_conf", F.lit(0.0)) != 0, F.col("_conf")).otherwise(less).alias("confidence"),
        F.when(review, F.coalesce(field("item", "review.state"), F.lit(""))).otherwise("needs_review").alias("review_state"),
        F.col("item").alias("raw"),
    )


def ingested(texts: DataFrame, id_: str, value: str, most: int = 1200) -> DataFrame:
    """Paragraph chunks ``c001`` and so on of a text, cut to ``most`` characters."""
    rows = texts.select(id_, F.posexplode(paragraphs(F.col(value))).alias("i", "t"))
    return rows.select(id_, F.format_string("c%03d", F.col("i") + 1).alias("chunk_id"), F.concat(F.lit("paragraph:"), (F.col("i") + 1).cast("string")).alias("locator"), F.substring("t", 1, most).alias("text"))


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, type, value`` of Markdown and plain text files."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.withColumn("type", F.when(F.lower("path").rlike(r"\.(md|markdown)$"), "markdown").otherwise("text"))


def page_lines(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """``page, pos, line`` of cached pages in range, repaired and without noise."""
    docs = json_documents(spark, path)
    number = F.coalesce(field("v", "source.pdf_page", "int"), F.nullif(F.regexp_extract("path", r"page-(\d+)[^/]*$", 1), F.lit("")).try_cast("int"), F.lit(0))
    own = docs.select(number.alias("page"), field("v", "text").alias("t")).where(F.col("page").between(first, last))
    return lines(own, "page", "t")


def lines(texts: DataFrame, id_: str, value: str) -> DataFrame:
    rows = texts.select(id_, F.posexplode(F.split(F.col(value), r"\r\n|[\n\r]", -1)).alias("pos", "raw"))
    rows = rows.select(id_, F.col("pos").cast("bigint").alias("pos"), ocr_fixups(F.col("raw")).alias("line"))
    return rows.where(~is_noise(F.col("line")))


def layout_pages(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Elements of layout files; a file's page is its place in ``paths``."""
    order = spark.createDataFrame([(p.rsplit("/", 1)[-1], i) for i, p in enumerate(paths)], "name string, page bigint")
    docs = json_documents(spark, paths).where(field("v", "elements", "array<variant>").isNotNull())
    named = docs.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(F.broadcast(order), "name")
    rows = named.select("page", F.posexplode(field("v", "elements", "array<variant>")).alias("pos", "item"))
    box = [field("item", f"bbox.{c}", "double").alias(c) for c in ("x", "y", "width", "height")]
    return rows.select(F.lit(0).alias("doc"), "page", (F.col("page") * 1_000_000 + F.col("pos")).alias("pos"), field("item", "id").alias("id"), field("item", "type").alias("type"), field("item", "content").alias("content"), *box)


def profile(path: str) -> dict:
    """A small settings file, JSON or, where the library is there, YAML; an object."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        out = yaml.safe_load(raw)
    else:
        out = json.loads(raw)
    if not isinstance(out, dict):
        raise ValueError("a profile must be an object")
    return out


def front_matter(c: Column) -> Column:
    """What stands between the fences at the top of a text, null if nothing does."""
    return F.nullif(F.regexp_extract(c, r"(?s)^---\s*\n(.*?)\n---", 1), F.lit(""))


def front_matter_field(c: Column, name: str) -> Column:
    return text(F.regexp_extract(front_matter(c), rf"(?m)^{name}:[ \t]*[\"']?(.*?)[\"']?[ \t]*$", 1))


def tree(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes, sha256`` of all files below a folder.  Spark's readers pass
    over names that begin with a dot or an underscore; such files come from a
    listing of the file system, without a digest."""
    seen = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(context._jsc.hadoopConfiguration())
    top, found, hidden = system.makeQualified(folder).toString(), system.listFiles(folder, True), []
    while found.hasNext():
        file = found.next()
        name = file.getPath().toString()
        if any(part[:1] in "._" for part in name.removeprefix(top).split("/") if part):
            hidden.append((name, file.getLen(), None))
    hidden = spark.createDataFrame(hidden, seen.schema)
    return seen.join(hidden, "path", "left_anti").select(*seen.columns).unionByName(hidden)


def file_policy(files: DataFrame, root: str = "", endings: tuple[str, ...] = FORBIDDEN_ENDINGS, names: tuple[str, ...] = FORBIDDEN_NAMES) -> DataFrame:
    """``path, problem``: system leftovers, forbidden endings, forbidden parts of the name.
    Folders are judged below ``root``, as it stands in ``path``."""
    parts = F.split(F.regexp_replace("path", F.lit("^" + re.escape(root)), F.lit("")), "/")
    name = F.lower(F.element_at(parts, -1))
    own = files.where(~F.arrays_overlap(parts, F.array(*map(F.lit, IGNORED_PARTS)))).select("path", name.alias("name"))
    ending = F.regexp_extract("name", r".(\.[^.]*)$", 1)
    banned = F.exists(F.array(*map(F.lit, names)), lambda x: F.col("name").contains(x))
    problem = F.when(F.col("name") == ".ds_store", "leftover").when(ending.isin(*endings), "extension").when(banned, "name")
    return own.select("path", problem.alias("problem")).where("problem is not null")


def asset_key(name: Column) -> Column:
    """A known file's own key, else its stem as a slug with underscores."""
    known = F.try_element_at(F.create_map(*(F.lit(x) for kv in ASSET_KEYS.items() for x in kv)), name)
    return F.coalesce(known, F.replace(slug_base(F.regexp_replace(name, r"\.[^.]*$", "")), F.lit("-"), F.lit("_")))


def manifest(files: DataFrame) -> DataFrame:
    """``asset, path, bytes, sha256``."""
    return files.select(asset_key(F.element_at(F.split("path", "/"), -1)).alias("asset"), "path", "bytes", "sha256")


def manifest_rules(assets: DataFrame) -> DataFrame:
    """Problems of manifest assets: no path, bad size, bad digest."""
    bad = F.array(F.when(text(F.col("path")).isNull(), F.lit("path")), F.when(F.col("bytes").isNull() | (F.col("bytes") < 0), F.lit("bytes")), F.when(~F.coalesce(F.col("sha256"), F.lit("")).rlike("^[0-9a-fA-F]{64}$"), F.lit("sha256")))
    return assets.select("asset", F.explode(F.filter(bad, lambda x: x.isNotNull())).alias("problem"))


def placeholders(docs: DataFrame, id_: str, value: str, markers: tuple[str, ...] = ("TODO", "TBD", "FIXME", "待补充", "占位")) -> DataFrame:
    """``id, marker`` for each marker in a document's text."""
    found = F.array(*(F.when(F.col(value).contains(m), F.lit(m)) for m in markers))
    return docs.select(id_, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("marker"))


def page_index(blocks: DataFrame, doc: str, page: str, pos: str, value: str, level: str) -> DataFrame:
    """Per page: characters, the first 8 headings, a preview of 260 characters."""
    heads = F.array_sort(F.collect_list(F.when(F.col(level) > 0, F.struct(F.col(pos).alias("p"), F.col(value).alias("t")))))
    all_ = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("t"))))
    return blocks.groupBy(doc, page).agg(F.sum(F.length(value)).cast("bigint").alias("char_count"), F.array_join(F.transform(F.slice(heads, 1, 8), lambda x: x["t"]), " | ").alias("headings"), compact_text(F.array_join(F.transform(all_, lambda x: x["t"]), " "), 260).alias("preview"))


def lesson_candidates(chunked: DataFrame, source: str, most: int = 220) -> DataFrame:
    """A chunk as a draft node that refers to it, and two tasks to review it."""
    ref = F.concat(F.lit(source), F.lit("#"), F.col("chunk_id"))
    return chunked.select(F.concat(F.lit("node:"), F.col("chunk_id")).alias("id"), F.lit("source_chunk").alias("type"), compact_text(F.col("text"), most).alias("summary"), ref.alias("source_ref"), F.lit(1.0).alias("confidence"), F.lit("draft").alias("review_state"), F.array(F.lit("extract_concepts"), F.lit("check_evidence")).alias("tasks"))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object on each line, null fields left out."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


def _numbered(df: DataFrame, base: int, line: Column, *order) -> DataFrame:
    """At most a few dozen rows, so the window is over one small group."""
    return df.select((F.lit(base) + F.row_number().over(W.orderBy(*order))).cast("bigint").alias("line_no"), line.alias("line"))


def report(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``line_no, line`` of a Markdown health report."""
    waiting = nodes.where(review_state().isin("needs_review", "draft"))
    lone = orphans(nodes, edges)
    spark = nodes.sparkSession

    def count(df, base, label):
        return df.agg(F.count("*").alias("n")).select(F.lit(base).cast("bigint").alias("line_no"), F.concat(F.lit(label), F.col("n").cast("string")).alias("line"))

    def types(df, base):
        return _numbered(df.groupBy("type").agg(F.count("*").alias("n"), F.min("pos").alias("p")), base, F.concat(F.lit("- `"), "type", F.lit("`: "), F.col("n").cast("string")), F.desc("n"), "p")

    parts = [
        spark.createDataFrame([(1, "# KG Report")], "line_no bigint, line string"),
        count(nodes, 2, "- Nodes: "),
        count(edges, 3, "- Edges: "),
        types(nodes, 100),
        types(edges, 200),
        count(waiting, 300, "- Nodes needing review/draft: "),
        _numbered(waiting.orderBy("pos").limit(20), 300, F.concat(F.lit("  - node `"), "id", F.lit("`: "), "name"), "pos"),
        count(lone, 400, "- Orphan nodes: "),
        _numbered(lone.orderBy("id").limit(30), 400, F.concat(F.lit("  - `"), "id", F.lit("`")), "id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Fields of a learning pack that hold text, lists with something in them, and lists that may be left out.
PACK_TEXTS = ("id", "title", "version")
PACK_LISTS = ("kg_refs", "objectives", "tasks")
PACK_OPTIONAL = ("misconceptions", "remediations")


def pack_rules(packs: DataFrame, schema: str, kind: str = "learning_pack") -> DataFrame:
    """``pack, problem`` for packs of ``pack, v``: the names of the fields that
    break a rule, or ``object`` where ``v`` holds no object."""
    known = lambda f: F.schema_of_variant(field("v", f, "variant"))
    holds = {f: field("v", f) == value for f, value in (("schema", schema), ("kind", kind))}
    holds |= {f: (known(f) == "STRING") & text(field("v", f)).isNotNull() for f in PACK_TEXTS}
    holds |= {f: known(f).like("ARRAY%") & (F.size(field("v", f, "array<variant>")) > 0) for f in PACK_LISTS}
    holds |= {f: F.coalesce(known(f), F.lit("VOID")).rlike("^(VOID$|ARRAY)") for f in PACK_OPTIONAL}
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(f)) for f, c in holds.items())))
    is_object = F.coalesce(F.schema_of_variant("v").like("OBJECT%"), F.lit(False))
    return packs.select("pack", F.explode(F.when(is_object, broken).otherwise(F.array(F.lit("object")))).alias("problem"))
