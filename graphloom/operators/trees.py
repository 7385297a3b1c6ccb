"""JSON documents as tables of their nodes.

A document is opened level by level: each round explodes the objects and arrays
that the last one found, until a level has none, so documents may be nested to
any depth and nothing is recursed into row by row.  Every node has the JSON
pointer of its place, so rules over documents are joins and aggregates of paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.graph import _stored


def _kind(v: Column) -> Column:
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (s == "VOID"), "null")
        .when(s.startswith("OBJECT"), "object")
        .when(s.startswith("ARRAY"), "array")
        .when(s == "BOOLEAN", "boolean")
        .when(s == "STRING", "string")
        .otherwise("number")
    )


def merged(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join that sends both sides by their keys.  Nodes and what is read from them
    repeat themselves so much that files of 3 MB hold tables of 100 MB; Spark judges
    by the files, and would gather and broadcast those through the driver."""
    return left.join(right.hint("merge"), keys, how)


def tree(docs: DataFrame, doc: str = "doc", value: str = "v", store=None) -> DataFrame:
    """``doc, path, parent, key, kind, text`` of every node below the root of each
    variant: ``path`` is a JSON pointer, ``key`` its last part, ``text`` what a
    scalar says.  Numbers are as Spark prints them.  A null variant, or a root
    that is a scalar, has no rows; a null in a document is a node of kind null."""
    store = store or _stored(docs)
    spark = docs.sparkSession
    level = docs.select(F.col(doc).alias("doc"), F.lit("").alias("path"), F.col(value).alias("v")).where(_kind(F.col("v")).isin("object", "array"))
    out, k = None, 0
    while True:
        # pos is set for entries of arrays and of objects, key for those of objects only
        opened = spark.sql("SELECT doc, path AS parent, CASE WHEN key IS NULL THEN CAST(pos AS STRING) ELSE key END AS key, value AS v FROM {level}, LATERAL variant_explode(v)", level=level)
        escaped = F.replace(F.replace("key", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        opened = opened.select("doc", F.concat("parent", F.lit("/"), escaped).alias("path"), "parent", "key", _kind(F.col("v")).alias("kind"), "v")
        opened = store(opened, f"tree{k}")
        scalar = F.when(~F.col("kind").isin("object", "array", "null"), F.try_variant_get("v", "$", "string"))
        rows = opened.select("doc", "path", "parent", "key", "kind", scalar.alias("text"))
        out = rows if out is None else out.unionByName(rows)
        level, k = opened.where("kind in ('object', 'array')").select("doc", "path", "v"), k + 1
        if level.isEmpty():
            return out


def objects(nodes: DataFrame) -> DataFrame:
    """``doc, path, f`` of every object (but the roots): ``f`` maps its scalar
    fields to their texts; of a repeated key the first in order counts."""
    fields = nodes.where("text is not null").groupBy("doc", "parent", "key").agg(F.min("text").alias("text"))
    maps = fields.groupBy("doc", "parent").agg(F.map_from_entries(F.collect_list(F.struct("key", "text"))).alias("f")).withColumnRenamed("parent", "path")
    own = merged(nodes.where("kind = 'object'").select("doc", "path"), maps, ["doc", "path"], "left")
    return own.withColumn("f", F.coalesce("f", F.create_map().cast("map<string,string>")))


def strings(nodes: DataFrame) -> DataFrame:
    """``doc, path, text`` of all texts, at any depth."""
    return nodes.where("kind = 'string'").select("doc", "path", "text")


def placeholders(nodes: DataFrame, markers: tuple[str, ...]) -> DataFrame:
    """``doc, path, marker`` of the markers in the texts of a document, at any depth."""
    marks = F.explode(F.filter(F.array(*map(F.lit, markers)), lambda m: F.col("text").contains(m)))
    return strings(nodes).select("doc", "path", marks.alias("marker"))


def compared_names(declared: DataFrame, present: DataFrame, *key: str) -> DataFrame:
    """Both differences of two sets of names in one pass: ``key.., side`` with side
    ``declared`` for what is not there, and ``present`` for what was not declared."""
    both = declared.select(*key, F.lit(1).alias("_d"), F.lit(0).alias("_p")).unionByName(present.select(*key, F.lit(0).alias("_d"), F.lit(1).alias("_p")))
    found = both.groupBy(*key).agg(F.max("_d").alias("_d"), F.max("_p").alias("_p")).where("_d <> _p")
    return found.select(*key, F.when(F.col("_d") == 1, "declared").otherwise("present").alias("side"))
