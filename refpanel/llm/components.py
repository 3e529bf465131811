"""Connected components of links kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refpanel.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round every node points to its smallest neighbour if that is smaller, pointers are
    shortened until they end at roots, and the links between roots are what the next round works
    on; at least one end of every link vanishes, so links shrink quickly, also for long chains.
    Only grouped minima and equi-joins; nothing is gathered by node.
    """
    links = store(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        up = store(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "up")
        while True:
            nxt = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = store(up.join(nxt, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "up")
            up = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        if roots is None:
            roots = up
        else:
            top = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = store(roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
        ends = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        links = links.join(ends, "a").join(ends.toDF("b", "rb"), "b").filter("ra <> rb")
        links = store(links.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    return roots if roots is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
