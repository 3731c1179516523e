"""Connected components by repeated contraction to a neighbour that a per-round hash ranks lowest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.llm._scratch import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (src long, dst long) -> (node, root): one row per node that has an edge to another node;
    nodes share a root exactly when edges connect them. No edges: no rows.

    Each round sends a node to the lowest of itself and its neighbours in a random order that changes
    every round, then contracts. Long chains and stars both shrink by a constant factor a round, so
    rounds grow with the logarithm of the graph. Only minima are aggregated (combined before the
    shuffle), no neighbour list is ever gathered, and each round is cut in the shared folder.
    """
    edges = materialize(edges.where("src <> dst").select("src", "dst").distinct())
    found, step = None, 0
    while not edges.isEmpty():
        step += 1
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(step)).alias("h"), c.alias("id"))  # noqa: B023, E731
        both = edges.union(edges.select("dst", "src")).toDF("node", "near")
        hop = both.groupBy("node").agg(F.min(rank(F.col("near"))).alias("low"))
        hop = hop.select("node", F.least("low", rank(F.col("node"))).getField("id").alias("to"))
        hop = materialize(hop)
        if found is None:
            found = hop.toDF("node", "root")
        else:
            found = found.join(hop.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        found = materialize(found)
        a, b = hop.toDF("src", "a"), hop.toDF("dst", "b")
        edges = edges.join(a, "src").join(b, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        edges = materialize(edges.where("src <> dst").distinct())
    return found if found is not None else edges.toDF("node", "root")


def with_least(placed: DataFrame, root: str, value: str, name: str, hot: int = 256, most: int = 100_000) -> DataFrame:
    """placed (materialised) with the least `value` of each root, null only where it has no other. Roots of many rows don't meet in
    one task: they hold more than `hot` rows and more than one in `most`, so there are fewer than `most` of them, and theirs is broadcast."""
    counts = materialize(placed.groupBy(root).agg(F.min(value).alias(name), F.count("*").alias("n_of_root")))
    total = counts.agg(F.sum("n_of_root")).first()[0] or 0
    large = F.col("n_of_root") > max(hot, total // most)
    big, small = counts.where(large).drop("n_of_root"), counts.where(~large).drop("n_of_root")
    there = placed.join(F.broadcast(big), root)
    rest = placed.join(F.broadcast(big.select(root)), root, "left_anti").join(small.hint("merge"), root)
    return there.select(*placed.columns, name).unionByName(rest.select(*placed.columns, name))
