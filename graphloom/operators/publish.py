"""Stored graphs: merged as a whole or not at all.

A graph is a folder of versions, each with its nodes, edges and sources as
Parquet, and a pointer to the version that counts.  A merge writes a new
version, judges the whole graph in it, and only then moves the pointer by one
rename, so readers see all of a batch or nothing of it.  A batch that breaks a
rule, or would make the graph break one, leaves pointer and tables as they were.
A batch that is merged again adds nothing.  Merges of one graph must follow each
other; readers need no lock.

Candidates need their columns only: a missing review state is accepted, a missing
confidence 0.8, once they are in.  Null ids are errors of the batch.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import text
from graphloom.operators.graph import edge_id, merge, requires_cycle
from graphloom.operators.rules import union, validate_candidates, validate_graph

PARTS = ("nodes", "edges", "sources")


@dataclass
class Merged:
    """What a merge did.  ``outcomes`` has a row per candidate, ``findings`` the broken rules, errors or not."""

    merged: bool
    version: str
    outcomes: DataFrame | None
    findings: DataFrame


def _one_of_each(df: DataFrame, *key: str, order: str = "pos") -> DataFrame:
    """The first row of each key, by a partial aggregate."""
    whole = F.min_by(F.struct(*df.columns), order).alias("x")
    return df.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key))).agg(whole).select("x.*")


class GraphStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- files ---------------------------------------------------------------------

    def _fs(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> str | None:
        """The version that counts: the one pointer file's name says it."""
        folder, fs = self._fs("current")
        if not fs.exists(folder):
            return None
        names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
        return names[-1].split(".", 1)[1] if names else None

    def _publish(self, version: str) -> None:
        """Rename a file into the folder of pointers; the last in order counts, so there is no moment without one."""
        folder, fs = self._fs("current")
        fs.mkdirs(folder)
        n = max((int(s.getPath().getName().split(".", 1)[0]) for s in fs.listStatus(folder)), default=0) + 1
        ready, _ = self._fs(f"pointer-{version}")
        fs.create(ready).close()
        pointer, _ = self._fs(f"current/{n:012d}.{version}")
        if not fs.rename(ready, pointer):
            raise OSError(f"cannot publish {version}")

    def _drop(self, version: str) -> None:
        p, fs = self._fs(f"versions/{version}")
        fs.delete(p, True)

    def _write(self, version: str, tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            df.write.parquet(f"{self.path}/versions/{version}/{name}")

    def read(self, version: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Nodes, edges, sources; a reader keeps the version that it began with."""
        version = version or self.version()
        if version is None:
            raise FileNotFoundError(f"no graph in {self.path}")
        return tuple(self.spark.read.parquet(f"{self.path}/versions/{version}/{p}") for p in PARTS)

    def create(self, nodes: DataFrame, edges: DataFrame, sources: DataFrame) -> str:
        version = uuid.uuid4().hex
        self._write(version, dict(zip(PARTS, (nodes, edges, sources))))
        self._publish(version)
        return version

    # -- merge ---------------------------------------------------------------------

    def merge(self, node_candidates: DataFrame, edge_candidates: DataFrame, sources: DataFrame | None = None) -> Merged:
        """Add what can be added of a batch, if the batch and the merged graph keep the rules."""
        old = self.version()
        nodes, edges, known = self.read(old)
        version = uuid.uuid4().hex
        folder = f"{self.path}/versions/{version}"

        def stored(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        found = stored(validate_candidates(node_candidates, edge_candidates), "batch_findings")
        if not found.where("severity = 'E'").isEmpty():
            return Merged(False, old, None, found)

        outcomes = stored(merge(nodes, edges, node_candidates, edge_candidates), "outcomes")
        added = outcomes.where("outcome = 'added'")
        state = F.coalesce(text(F.col("review_state")), F.lit("accepted"))
        sure = F.coalesce("confidence", F.lit(0.8))
        new_nodes = node_candidates.join(added.where("entity = 'node'").select("id", "pos"), ["id", "pos"], "left_semi")
        new_nodes = _one_of_each(new_nodes, "id").withColumns({"review_state": state, "confidence": sure})
        own_id = F.coalesce(F.nullif(F.col("id"), F.lit("")), edge_id(F.col("type"), F.col("source"), F.col("target")))
        new_edges = edge_candidates.withColumn("id", own_id).join(added.where("entity = 'edge'").select("id", "pos"), ["id", "pos"], "left_semi")
        new_edges = _one_of_each(new_edges, "id").withColumns({"review_state": state, "confidence": sure})
        all_sources = known
        if sources is not None:
            fresh = sources.where(text(F.col("source_id")).isNotNull()).join(known.select("source_id").distinct(), "source_id", "left_anti")
            all_sources = union(known, fresh.select(*known.columns).distinct())
        # the new rows are added after the old ones, so those keep their places
        last = lambda df: df.agg(F.coalesce(F.max("pos"), F.lit(0))).first()[0]
        shift = lambda df, by: df.withColumn("pos", F.col("pos") + F.lit(by + 1))
        whole = {
            "nodes": nodes.unionByName(shift(new_nodes, last(nodes)), allowMissingColumns=True).select(*nodes.columns),
            "edges": edges.unionByName(shift(new_edges, last(edges)), allowMissingColumns=True).select(*edges.columns),
            "sources": all_sources,
        }
        self._write(version, whole)
        merged_nodes, merged_edges, merged_sources = self.read(version)
        cycle = requires_cycle(merged_edges)
        found = stored(union(found, validate_graph(merged_nodes, merged_edges, merged_sources, cycle)), "findings")
        if not found.where("severity = 'E'").isEmpty():
            return Merged(False, old, outcomes, found)
        self._publish(version)
        return Merged(True, version, outcomes, found)

    def clean(self) -> None:
        """Delete all versions but the one that counts; when no reader holds an older one."""
        folder, fs = self._fs("versions")
        kept = self.version()
        for s in fs.listStatus(folder):
            if s.getPath().getName() != kept:
                fs.delete(s.getPath(), True)
