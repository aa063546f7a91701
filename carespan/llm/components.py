"""Connected components of an edge table by label spreading with shortcuts.

Only nodes that have an edge take part. Every round joins the edges with the labels
(both stay distributed), then replaces each label by its label's label, so the number
of rounds grows with the logarithm of the longest chain rather than its length. Each
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm.storage import kept


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable."""
    both = kept(
        edges.where("a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .distinct(),
        "edges",
    )
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        # hang the old root, too, under the smallest label seen beside any of its members
        told = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("best"))
        told = kept(told, "told")
        hung = told.groupBy(F.col("root").alias("old")).agg(F.min("best").alias("hung"))
        merged = told.join(hung, told.root == hung.old).select("node", F.least("best", "hung").alias("root"))
        jumped = (
            merged.alias("m")
            .join(merged.alias("up"), F.col("m.root") == F.col("up.node"), "left")
            .select(F.col("m.node").alias("node"), F.coalesce("up.root", "m.root").alias("root"))
        )
        after = kept(jumped, "labels")
        moved = after.join(labels.withColumnRenamed("root", "was"), "node").where("root <> was").limit(1).count()
        labels = after
        if not moved:
            return labels
