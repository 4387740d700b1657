"""Connected components of an edge table, by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import drop_staged, salted_lookup, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable.

    Labels fall to the smallest label among the neighbours and then to the label of that
    label, until nothing changes; paths shorten by half a round. Every round is a written
    table and only its number of changes reaches the driver. Lookups are salted, so neither a
    node with many edges nor a component with a large part of all nodes fills one task.
    No edges give no rows; loops and repeated edges change nothing.
    """
    both = stage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    now = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        of_b = salted_lookup(both, "b", now.select(F.col("node").alias("b"), "root"), ["a"], "inner")
        seen = of_b.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_seen"))
        hooked = now.join(seen, "node").select(
            "node", F.col("root").alias("_old"), F.least("root", "_seen").alias("_root"))
        jump = now.where("node <> root").select(F.col("node").alias("_root"), F.col("root").alias("_next"))
        jumped = salted_lookup(hooked, "_root", jump, ["node"]).select(
            "node", "_old", F.least("_root", F.coalesce("_next", F.col("_root"))).alias("root"))
        after = stage(jumped, "labels")
        changed = after.where("root <> _old").limit(1).count()
        drop_staged(now)
        now = after
        if not changed:
            drop_staged(both)
            return now.select("node", "root")
