"""Connected components of a graph that only exists as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.operators.lineage import checkpoint


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b); component: the smallest node reachable.

    Alternating stars: each round hooks the larger neighbours of a node to its smallest
    neighbour, then its smaller ones, until nothing changes; the graph shrinks to one
    star for each component in a logarithmic number of rounds. Edges never leave the
    executors; each round is cut off by a checkpoint. A node with many neighbours is a
    large key of a minimum (summed in the map tasks) and of joins whose large
    partitions are split. Loops and repeated edges are dropped, edges with a null end
    as well; no edges give no rows.
    """
    found = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    found = checkpoint(found.filter(edges["a"].isNotNull() & edges["b"].isNotNull()).filter("u > v").distinct())
    state = _state(found)
    while state[0]:
        both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = checkpoint(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = checkpoint(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state, before = _state(found), state
        if state == before:
            break
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
