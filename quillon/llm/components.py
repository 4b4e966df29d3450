"""Connected components of a graph given as a table of edges, by hooking and pointer jumping in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import discard, materialized


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node of its component.

    Each round hooks every node, and the parent of every node, under the smallest parent among its neighbours, then halves
    the paths. Rounds grow with the logarithm of a component's diameter; each is written to the shared folder, so lineage
    stays short. Hubs are only ever one side of an equi-join or of a partial aggregation.
    """
    both = materialized(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    parents = materialized(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), f"{name}-parents")
    while True:
        of_a = parents.select(F.col("node").alias("a"), F.col("root").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("root").alias("pb"))
        seen = both.join(of_b, "b").groupBy("a").agg(F.min("pb").alias("pb")).join(of_a, "a")
        offers = seen.select(F.col("a").alias("node"), F.least("pa", "pb").alias("root")).unionByName(seen.filter("pb < pa").select(F.col("pa").alias("node"), F.col("pb").alias("root")))
        hooked = offers.groupBy("node").agg(F.min("root").alias("root"))
        above = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = hooked.join(above, "root").select("node", F.col("top").alias("root"))
        after = materialized(jumped, f"{name}-parents")
        changed = after.join(parents.withColumnRenamed("root", "old"), "node").filter("root <> old").limit(1).count()
        discard(parents)
        parents = after
        if not changed:
            discard(both)
            return parents
