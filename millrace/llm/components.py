"""Connected components of a table of links, by hooking roots and contracting, all in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``a, b`` in; ``node, label`` out for every node of a link, the label being the smallest node reachable.

    Each round hooks every root to the smallest root it is linked to, follows these
    hooks to their ends by doubling, and goes on with the links between the roots
    that are left. The number of rounds grows with the logarithm of the longest chain.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = fixed(nodes.withColumn("label", F.col("node")), name)
    left = fixed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    while not left.isEmpty():
        hooks = fixed(left.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("to")), name)
        while True:
            ahead = hooks.select(F.col("root").alias("to"), F.col("to").alias("further"))
            doubled = fixed(
                hooks.join(ahead, "to", "left").select(
                    "root", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")
                ),
                name,
            )
            hooks = doubled.drop("moved")
            if doubled.filter("moved").isEmpty():
                break
        renamed = hooks.withColumnsRenamed({"root": "label", "to": "end"})
        labels = fixed(labels.join(renamed, "label", "left").select("node", F.coalesce("end", "label").alias("label")), name)
        one, two = (hooks.withColumnsRenamed({"root": c, "to": f"{c}_end"}) for c in ("a", "b"))
        moved = left.join(one, "a", "left").join(two, "b", "left")
        ends = moved.select(F.coalesce("a_end", "a").alias("a"), F.coalesce("b_end", "b").alias("b")).filter("a <> b")
        left = fixed(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    return labels
