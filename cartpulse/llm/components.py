"""Connected components of a graph by rounds of joins.

Every node keeps the smallest node it has heard of. A round takes the smallest
parent among the neighbours and then the parent's parent. Each round is written to
the shared folder, so a lost executor costs one round at most. Sums per node are
formed before rows move, and joins with a node that has very many edges are between
written tables, whose large partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.frames import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b); component is the smallest node.

    Self-loops and repeated edges are allowed, nulls are left out. Nodes without an
    edge do not appear.
    """
    both = edges.select("a", "b").where("a is not null and b is not null")
    both = written(both.union(both.select("b", "a")).distinct(), "components-edges")
    nodes = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                    .select("node", F.least("node", "least").alias("component")), "components")
    while True:
        heard = both.join(nodes.select(F.col("node").alias("b"), "component"), "b")
        least = written(heard.groupBy(F.col("a").alias("node"))
                        .agg(F.min("component").alias("least")), "components-heard")
        stepped = written(nodes.join(least, "node").select(
            "node", F.col("component").alias("old"),
            F.least("component", "least").alias("component")), "components-step")
        up = stepped.select(F.col("node").alias("component"),
                            F.col("component").alias("further"))
        jumped = written(stepped.join(up, "component").select(
            "node", "old", F.least("component", "further").alias("component")), "components")
        nodes = jumped.select("node", "component")
        if jumped.where("old <> component").isEmpty():
            return nodes
