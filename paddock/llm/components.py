"""Connected components of a link table, by contraction, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import landed


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); the nodes of a component share a root among them.

    Each round hooks every node to its smallest neighbour, follows two more hooks, and replaces the ends of the links
    by where they point; links inside a group fall away. Every node that is not smaller than all its neighbours
    joins another, so that the number of nodes at least halves each round. Rounds end in written tables; minima
    combine before the shuffle, and joins may split the links of a hub.
    """
    spark = links.sparkSession
    left = landed(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    roots = spark.createDataFrame([], "node long, root long")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = landed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "hooks")
        for _ in range(2):
            further = hook.select(F.col("node").alias("to"), F.col("to").alias("next"))
            hook = hook.join(further, "to").select("node", F.col("next").alias("to"))
        hook = landed(hook, "hooks")
        moved = roots.join(hook.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        new = hook.join(roots.select("node"), "node", "left_anti").select("node", F.col("to").alias("root"))
        roots = landed(moved.unionByName(new), "roots")
        left = landed(left.join(hook.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                      .join(hook.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                      .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct(), "links")
    return roots
