"""Connected components by hooking and shortcuts, in about as many rounds as the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.operators.lineage import cut, release


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of edges (u, v); a node without another has an edge to itself.

    Each node has a parent, at first itself. In a round a node, and its parent, take the smallest grandparent among the node's neighbours if that is less, and every node its grandparent. Rows
    of a node with many neighbours are reduced within tasks; nothing is gathered by component. Ends when no parent changes. Rows with a null are left out.
    """
    known = edges.where("u IS NOT NULL AND v IS NOT NULL")
    both = cut(known.select("u", "v").unionByName(known.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "graph")
    parents = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select("node", F.least("node", "v").alias("parent")), "parents")
    while True:
        above = parents.select(F.col("node").alias("of"), F.col("parent").alias("grand"))
        grand = cut(parents.join(above, F.col("parent") == F.col("of")).select("node", "parent", "grand"), "grand")
        least = both.join(grand.select(F.col("node").alias("v"), "grand"), "v").groupBy("u").agg(F.min("grand").alias("least"))
        seen = grand.join(least, F.col("node") == F.col("u")).select("node", "parent", "grand", "least")
        offered = seen.select("node", F.least("grand", "least").alias("parent")).unionByName(seen.select(F.col("parent").alias("node"), F.col("least").alias("parent")))
        after = cut(offered.unionByName(parents).groupBy("node").agg(F.min("parent").alias("parent")), "parents")
        old = parents.select(F.col("node").alias("of"), F.col("parent").alias("old"))
        changed = after.join(old, F.col("node") == F.col("of")).where("parent <> old").limit(1).count()
        release(grand)
        release(parents)
        parents = after
        if not changed:
            release(both)
            return parents.select("node", F.col("parent").alias("component"))
