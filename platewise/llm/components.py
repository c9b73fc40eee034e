"""Connected components of an undirected graph by alternating star operations on its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node of an edge, the component being its smallest node.

    Each round joins every node's larger neighbours to its smallest neighbour, then every node's smaller neighbours to the
    smallest of them. Both only regroup edges, there are never more than before, and after a number of rounds that grows with the
    logarithm of the longest chain every node hangs on its component's smallest. Each round is stored in the shared folder;
    that nothing changed is read off a sum of hashes. Loops, repeated edges and nulls are ignored; no edges give no rows.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = stored(pairs.distinct(), "components")
    before = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both, only_larger=True)
        small = _to_smallest(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), only_larger=False)
        now = stored(small.distinct(), "components")
        check = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == check:
            break
        before = check
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _to_smallest(pairs: DataFrame, only_larger: bool) -> DataFrame:
    """Join the neighbours ``v`` of every ``u`` to the smallest of them and of ``u`` itself; edges (u, v) with u > v.

    The smallest neighbours are aggregated first, one row per node, so a node with very many neighbours is not gathered: its
    edges are joined with that row, and adaptive execution splits a hot node.
    """
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    smallest = stored(smallest, "components-smallest")
    joined = pairs.join(smallest, pairs["u"] == smallest["node"])
    if only_larger:
        found = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = smallest.filter(F.col("node") > F.col("m")).select(F.col("node").alias("u"), F.col("m").alias("v"))
    else:
        found = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = smallest.select(F.col("node").alias("u"), F.col("m").alias("v"))
    return found.unionByName(own).filter(F.col("u") != F.col("v"))
