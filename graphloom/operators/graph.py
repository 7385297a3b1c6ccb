"""Graph operators: selection, merging, neighbourhoods, cycles, degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import edge_id, text, trim_u
from graphloom.operators.rules import refs
from graphloom.sources.tables import cut, work_folder


def _stored(df: DataFrame):
    """Working tables in a fresh shared folder."""
    folder = work_folder(df.sparkSession)
    return lambda table, name: cut(table, name, folder)


def review_state(c: str = "review_state") -> Column:
    return F.coalesce(trim_u(F.col(c)), F.lit(""))


def promotable() -> Column:
    """Accepted, or sure enough and sourced; never if rejected."""
    state = review_state()
    sure = (F.coalesce(F.col("confidence"), F.lit(0.0)) >= 0.8) & (F.size(F.coalesce("source_refs", F.array().cast("array<string>"))) > 0)
    return (state != "rejected") & ((state == "accepted") | sure)


def selected(df: DataFrame, types: tuple[str, ...], states: tuple[str, ...], least: float) -> DataFrame:
    """Rows of the types and review states whose confidence is not below ``least``."""
    return df.where(trim_u(F.col("type")).isin(*types) & review_state().isin(*states) & (F.col("confidence").isNull() | (F.col("confidence") >= least)))


def with_both_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between nodes that are there."""
    ids = nodes.select("id").distinct()
    a, b = ids.withColumnRenamed("id", "source"), ids.withColumnRenamed("id", "target")
    return edges.join(a, "source", "left_semi").join(b, "target", "left_semi")


def first_of(df: DataFrame, *key: str, order: str = "pos") -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(order))).where("_n = 1").drop("_n")


def repeats(df: DataFrame, *key: str, order: str = "pos") -> DataFrame:
    """All but the first row of each key."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(order))).where("_n > 1").drop("_n")


def endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source").alias("id")).unionByName(edges.select(F.col("target").alias("id")))


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids of nodes at neither end of any edge."""
    return nodes.select("id").distinct().join(endpoints(edges).distinct(), "id", "left_anti")


def degrees(edges: DataFrame) -> DataFrame:
    """Edges at each id, both ends counted."""
    return endpoints(edges).groupBy("id").agg(F.count("*").alias("degree"))


def merge(nodes: DataFrame, edges: DataFrame, node_candidates: DataFrame, edge_candidates: DataFrame) -> DataFrame:
    """What a merge does with each candidate: ``entity, id, outcome``.  Outcomes in
    order of precedence: exists, endpoint_missing, not_promotable, added; of
    candidates with one id that could all be added, the first is."""
    have = nodes.select("id").distinct().withColumn("_have", F.lit(True))
    judged = node_candidates.join(have, "id", "left").withColumn("_ok", promotable())
    first = F.row_number().over(W.partitionBy("id", F.col("_have").isNull() & F.col("_ok")).orderBy("pos"))
    judged = judged.withColumn("outcome", F.when(F.col("_have"), "exists").when(~F.col("_ok"), "not_promotable").when(first > 1, "exists").otherwise("added"))
    known = nodes.select("id").unionByName(judged.where("outcome = 'added'").select("id")).distinct()
    own = edge_candidates.withColumn("id", F.coalesce(F.nullif(F.col("id"), F.lit("")), edge_id(F.col("type"), F.col("source"), F.col("target"))))
    have = edges.select("id").distinct().withColumn("_have", F.lit(True))
    a = known.select(F.col("id").alias("source"), F.lit(True).alias("_a"))
    b = known.select(F.col("id").alias("target"), F.lit(True).alias("_b"))
    own = own.join(have, "id", "left").join(a, "source", "left").join(b, "target", "left").withColumn("_ok", promotable())
    good = F.col("_have").isNull() & F.col("_a").isNotNull() & F.col("_b").isNotNull() & F.col("_ok")
    first = F.row_number().over(W.partitionBy("id", good).orderBy("pos"))
    own = own.withColumn("outcome", F.when(F.col("_have"), "exists").when(F.col("_a").isNull() | F.col("_b").isNull(), "endpoint_missing").when(~F.col("_ok"), "not_promotable").when(first > 1, "exists").otherwise("added"))
    return judged.select(F.lit("node").alias("entity"), "id", "pos", "outcome").unionByName(own.select(F.lit("edge").alias("entity"), "id", "pos", "outcome"))


def neighbourhood(nodes: DataFrame, edges: DataFrame, center: str, depth: int = 1, edge_type: str | None = None, directed: bool = False, store=None) -> DataFrame:
    """``id, depth`` of the nodes within ``depth`` steps of ``center``.  Each step
    is a join of the last frontier with the edges and an anti-join with what was
    reached, so work is bounded by the edges and not by the number of walks.
    Steps and frontiers are working tables (``store(df, name)``; Parquet in the
    shared folder unless given), so no step is planned or run twice."""
    store = store or _stored(nodes)
    own = edges if edge_type is None else edges.where(F.col("type") == edge_type)
    own = own.where((F.coalesce("source", F.lit("")) != "") & (F.coalesce("target", F.lit("")) != ""))
    ids = store(nodes.select("id").distinct(), "ids")
    own = with_both_ends(own.select("source", "target").distinct(), ids)
    steps = own.select(F.col("source").alias("a"), F.col("target").alias("b"))
    if not directed:
        steps = steps.unionByName(own.select(F.col("target").alias("a"), F.col("source").alias("b")))
    reached = ids.where(F.col("id") == center).withColumn("depth", F.lit(0).cast("bigint"))
    frontier = reached
    if depth:
        steps = store(steps, "steps")
    for d in range(1, depth + 1):
        new = steps.join(frontier.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        frontier = store(new.join(reached.select("id"), "id", "left_anti").withColumn("depth", F.lit(d).cast("bigint")), f"frontier{d}")
        reached = reached.unionByName(frontier)
    return reached


def induced(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """Edges between reached nodes."""
    return with_both_ends(edges, reached)


def referenced_sources(reached_nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Sources that the selection refers to, by the part before the chunk."""
    each = reached_nodes.select(F.explode(refs()).alias("r")).unionByName(edges.select(F.explode(refs()).alias("r")))
    return each.select(F.substring_index("r", "#", 1).alias("source_id")).distinct()


def simple_cycles(edges: DataFrame, longest: int | None = None) -> DataFrame:
    """``cycle, length``: all simple cycles (up to a length, if one is given), each
    from its least node on.  For small graphs, such as those of types, as there
    may be very many; ``cycle_nodes`` finds one in a graph of any size."""
    e = edges.select("source", "target").distinct()
    paths = e.where("source <= target").select(F.col("source").alias("start"), F.array("source").alias("path"), F.col("target").alias("at"))
    out = paths.where("start = at").select("path")
    paths, n = paths.where("start <> at"), 1
    while n != longest and (longest is not None or not paths.isEmpty()):
        n += 1
        paths = paths.select("start", F.concat("path", F.array("at")).alias("path"), "at")
        step = paths.join(e, paths["at"] == e["source"]).select("start", "path", F.col("target").alias("at")).where("at >= start")
        out = out.unionByName(step.where("at = start").select("path"))
        paths = step.where(~F.array_contains("path", F.col("at")))
    return out.select(F.concat(F.array_join("path", " -> "), F.lit(" -> "), F.element_at("path", 1)).alias("cycle"), F.size("path").cast("bigint").alias("length"))


def followed(steps: DataFrame, store, name: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Where each row of ``id, to`` (one row an id) ends if it is followed as far
    as there are rows, or for at least as many steps as there are rows: each round
    goes twice as far as the last.  ``extra``: columns that are put together on
    the way, by SQL over ``a`` (so far) and ``b`` (what follows)."""
    extra = extra or {}
    far, reach, k = store(steps, f"{name}0"), 1, 0
    n = far.count()
    while reach < n:
        a, b = far.alias("a"), far.alias("b")
        on = [F.coalesce(F.expr(x), F.col(f"a.{c}")).alias(c) for c, x in extra.items()]
        further = a.join(b, F.col("a.to") == F.col("b.id"), "left").select(F.col("a.id").alias("id"), F.coalesce("b.to", "a.to").alias("to"), *on, F.col("b.to").isNotNull().alias("_moved"))
        reach, k = reach * 2, k + 1
        far = store(further, f"{name}{k}")
        moved = not far.where("_moved").isEmpty()
        far = far.drop("_moved")
        if not moved:
            break
    return far


def _without_ends(e: DataFrame, store, name: str, a: str, b: str) -> DataFrame:
    """Edges without those of nodes that lead from ``a`` to ``b`` to an end only:
    nodes that no edge leaves, and chains of nodes of one edge each down to those."""
    ends = store(e.select(F.col(b).alias("id")).distinct().join(e.select(F.col(a).alias("id")).distinct(), "id", "left_anti"), f"{name}ends")
    if ends.isEmpty():
        return e
    single = e.groupBy(F.col(a).alias("id")).agg(F.count("*").alias("_n"), F.min(b).alias("to")).where("_n = 1").drop("_n")
    last = followed(single, store, name)
    dead = ends.unionByName(last.join(ends.select(F.col("id").alias("to")), "to", "left_semi").select("id"))
    return e.join(dead.select(F.col("id").alias(a)), a, "left_anti").join(dead.select(F.col("id").alias(b)), b, "left_anti").select("source", "target")


def cyclic_core(edges: DataFrame, store=None) -> DataFrame:
    """Edges left when nodes that nothing enters or leaves are taken away until
    none is: not empty exactly if there is a cycle.  A round takes whole chains
    (by pointers that are followed twice as far each time), so a chain of any
    length costs a logarithm of it; ``store(df, name)`` writes a table and reads
    it back."""
    store = store or _stored(edges)
    e = store(edges.select("source", "target").where("source is not null and target is not null").distinct(), "core0")
    before, n, k = -1, e.count(), 0
    while 0 < n != before:
        k += 1
        down = _without_ends(e, store, f"down{k}_", "source", "target")
        down = down if down is e else store(down, f"core{k}a")
        up = _without_ends(down, store, f"up{k}_", "target", "source")
        e = up if up is down else store(up, f"core{k}b")
        before, n = n, e.count()
    return e


def cycle_nodes(edges: DataFrame, store=None) -> DataFrame:
    """``pos, id`` of one cycle, from its least node on; no rows if there is none.

    In the cyclic core every node has an edge; each takes the least of its
    targets, and following these ends on cycles.  Of those the one with the least
    node is returned.  Rounds: those of the core, and a logarithm of its nodes."""
    store = store or _stored(edges)
    core = cyclic_core(edges, store)
    steps = store(core.groupBy(F.col("source").alias("id")).agg(F.min("target").alias("to")), "steps")
    least = followed(steps.withColumn("least", F.least("id", "to")), store, "least", {"least": "least(a.least, b.least)"})
    on_cycles = least.select(F.col("to").alias("id")).distinct()
    rooted = store(least.select("id", "least").join(on_cycles, "id", "left_semi"), "rooted")
    root = rooted.agg(F.min("least").alias("root")).where("root is not null")
    own = rooted.join(F.broadcast(root), F.col("least") == F.col("root")).select("id", "root")
    # from each node to the root: the root's own pointer is left out, so distances end there
    back = own.join(steps, "id").where("id <> root").select("id", "to", F.lit(1).cast("bigint").alias("d"))
    away = followed(back, store, "away", {"d": "a.d + b.d"})
    n = own.agg(F.count("*").alias("n"))
    placed = own.join(away.select("id", "d"), "id", "left").join(F.broadcast(n))
    return placed.select(F.when(F.col("d").isNull(), 0).otherwise(F.col("n") - F.col("d")).cast("bigint").alias("pos"), "id")


#: Nodes that a reported cycle names; ``cycle_nodes`` has all.
NAMED = 50


def requires_cycle(edges: DataFrame, store=None) -> DataFrame:
    """``cycle, length``: one row if the ``requires`` edges have a cycle, of
    whatever length, with the names of its first nodes."""
    nodes = cycle_nodes(edges.where("type = 'requires'"), store)
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("pos") < NAMED, F.struct("pos", "id")))), lambda x: x["id"]), " -> ")
    first = F.min(F.when(F.col("pos") == 0, F.col("id")))
    closed = F.when(F.count("*") > NAMED, F.lit("…")).otherwise(first)
    return nodes.agg(F.concat(told, F.lit(" -> "), closed).alias("cycle"), F.count("*").alias("length")).where("length > 0")


def ancestors(df: DataFrame, id_: str = "id", parent: str = "parent_id", store=None) -> DataFrame:
    """``id, root, depth, path`` from each root down, one level a round, until a
    level is empty.  A root has no parent in the table; rows that only hang on a
    cycle have no root and are left out."""
    store = store or _stored(df)
    base = store(df.select(F.col(id_).alias("id"), text(F.col(parent)).alias("parent")), "links")
    known = base.select(F.col("id").alias("parent")).distinct()
    level = base.join(known, "parent", "left_anti").select("id", F.col("id").alias("root"), F.lit(0).cast("bigint").alias("depth"), F.array("id").alias("way"))
    links = base.where("parent <> id").withColumnRenamed("id", "child")
    out, k = None, 0
    while out is None or not level.isEmpty():
        level, k = store(level, f"level{k}"), k + 1
        out = level if out is None else out.unionByName(level)
        down = level.join(links, level["id"] == links["parent"]).where(~F.array_contains("way", F.col("child")))
        level = down.select(F.col("child").alias("id"), "root", (F.col("depth") + 1).alias("depth"), F.concat("way", F.array("child")).alias("way"))
    return out.select("id", "root", "depth", F.array_join("way", "/").alias("path"))
