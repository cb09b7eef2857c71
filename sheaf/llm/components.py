"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour that is larger (smaller or equal) to the node's smallest neighbour or itself."""
    if large:
        own = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        own = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = own.groupBy("a").agg(F.min("b").alias("low"))
    linked = own.join(least, "a").select(F.least("low", "a").alias("low"), "a", "b")
    if large:
        out = linked.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(linked.select("a", F.col("low").alias("b")))
    out = out.filter("a <> b")
    return out if large else out.distinct()  # an edge gives one row at most for larger neighbours, which the next step reads


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in the edges (a, b); component is its smallest node.

    Each round links nodes to ever smaller neighbours, in numbers of rows that
    never exceed the edges; rounds grow with the logarithm of the longest path.
    Every round is written to the shared folder, and the one before it deleted.
    """
    now = materialize(edges.select("a", "b").filter("a <> b").distinct(), "components")
    mark = None
    while True:
        large = materialize(_star(now, True), "components")
        discard(now)
        now = materialize(_star(large, False), "components")
        discard(large)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark = seen
    out = materialize(now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "components")
    discard(now)
    return out
