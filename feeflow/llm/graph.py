"""Connected components of a large edge list by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.store import saved


def components(edges: DataFrame) -> DataFrame:
    """node, comp (long): for every node of ``edges`` (a, b long), an id shared by exactly
    the nodes of its component.

    Each round sends every node to the smallest of itself and its neighbours and rewrites
    the edges between those; edges inside one node vanish. Ids should be hashes: then a
    round leaves a constant fraction of the nodes even on long chains, and rounds grow with
    the logarithm of the longest one. Parents and edges are written tables, so that both
    sides of every join are plain exchanges (a hot node's rows can be split) and nothing
    of a lost executor is recomputed. No edges give no rows.
    """
    edges = saved(edges.filter("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    parents: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = saved(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("up")),
            "parents",
        )
        parents.append(parent)
        half = edges.join(parent.select(F.col("node").alias("a"), F.col("up").alias("pa")), "a").select("pa", "b")
        whole = half.join(parent.select(F.col("node").alias("b"), F.col("up").alias("pb")), "b").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")
        )
        edges = saved(whole.filter("a <> b").distinct(), "edges")
    if not parents:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = parents[0].select("node", F.col("up").alias("comp"))
    for parent in parents[1:]:
        step = parent.select(F.col("node").alias("comp"), "up")
        out = out.join(step, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
    return out
