"""Connected components of a distributed edge list, by minimum labels and
pointer jumping.  Nothing but two counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.store import cut, shared_folder


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for the nodes of ``edges``; a component's label is its
    least node.  Self-loops and repeated edges do no harm; no edges, no rows."""
    folder = shared_folder(edges.sparkSession)
    s, t = F.col(a), F.col(b)
    pairs = F.array(*(F.struct(x.alias("s"), y.alias("t")) for x, y in ((s, t), (t, s), (s, s), (t, t))))
    both = cut(edges.select(F.explode(pairs).alias("e")).select("e.s", "e.t").distinct(), "edges", folder)
    labels = both.groupBy(F.col("s").alias("node")).agg(F.min("t").alias("label"))
    step = 0
    while True:
        labels = cut(labels, f"labels{step}", folder)
        if step and not labels.where("moved").limit(1).count():
            return labels.select("node", "label")
        step += 1
        own = F.min(F.when(F.col("s") == F.col("t"), F.col("label")))
        lower = both.join(labels.select("node", "label"), F.col("t") == F.col("node")).groupBy("s").agg(F.min("label").alias("label"), own.alias("was"))
        lower = cut(lower.withColumnRenamed("s", "node"), f"lower{step}", folder)
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("to"))
        labels = lower.join(jump, "label").select("node", F.col("to").alias("label"), (F.col("to") != F.col("was")).alias("moved"))
