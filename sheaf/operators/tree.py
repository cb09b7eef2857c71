"""Section trees from rows in order: parents, paths, children and ancestors.

Trees are flat tables of (key, pos, parent_pos); nothing is recursive in the
data. Parents come from one window over each document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_DEPTH = 7


def parents(rows: DataFrame, depth: str, key: str = "doc_id", pos: str = "pos", deepest: int = MAX_DEPTH, scope: list[str] | None = None) -> DataFrame:
    """Adds parent_pos: the nearest earlier row of smaller depth; rows without a depth hang under the latest row that has one.

    ``scope`` names further columns within which alone rows may nest, as inside
    a box. One shuffle serves all depths.
    """
    w = W.partitionBy(key, *(scope or [])).orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    latest = {k: F.last(F.when(F.col(depth) == k, F.col(pos)), True).over(w) for k in range(1, deepest + 1)}
    below = F.lit(None).cast(rows.schema[pos].dataType)
    case = F.when(F.col(depth).isNull(), F.greatest(*latest.values()))
    for k in range(1, deepest + 1):
        nearer = [latest[j] for j in range(1, k)]
        case = case.when(F.col(depth) == k, F.greatest(*nearer) if len(nearer) > 1 else nearer[0] if nearer else below)
    return rows.withColumn("parent_pos", case)


def paths(nodes: DataFrame, node: str, parent: str, keys: list[str] | None = None, deepest: int = MAX_DEPTH) -> DataFrame:
    """Adds path, the ancestors from the root to the node itself, and depth, by a bounded number of joins.

    A node on a cycle, or deeper than the bound, gets a null path.
    """
    keys = keys or []
    up = nodes.select(*keys, F.col(node).alias("_node"), F.col(parent).alias("_up")).distinct()
    walk = nodes.withColumn("_at", F.col(parent)).withColumn("path", F.array(node))
    for _ in range(deepest):
        nearest = up.select(*keys, F.col("_node").alias("_at"), F.col("_up"))
        joined = walk.join(nearest, [*keys, "_at"], "left")
        step = F.when(F.col("_at").isNull(), F.col("path")).otherwise(F.concat(F.array("_at"), "path"))
        walk = joined.withColumn("path", step).withColumn("_at", F.when(F.array_contains("path", F.col("_up")), F.col("_at")).otherwise(F.col("_up"))).drop("_up")
    return walk.withColumn("path", F.when(F.col("_at").isNull(), F.col("path"))).withColumn("depth", F.size("path")).drop("_at")


def ancestors(nodes: DataFrame, node: str, path: str = "path") -> DataFrame:
    """A row for each ancestor of each node: node, ancestor, distance."""
    return nodes.select(F.col(node).alias("node"), F.posexplode(F.reverse(path)).alias("distance", "ancestor")).filter("distance > 0").select("node", "ancestor", "distance")


def child_counts(nodes: DataFrame, node: str, parent: str, keys: list[str] | None = None) -> DataFrame:
    """Adds child_count, 0 for leaves."""
    keys = keys or []
    counts = nodes.filter(F.col(parent).isNotNull()).groupBy(*keys, F.col(parent).alias("_p")).agg(F.count("*").alias("child_count"))
    renamed = reduce(lambda d, k: d.withColumnRenamed(k, f"_{k}"), keys, counts)
    on = reduce(lambda a, b: a & b, [F.col(node) == F.col("_p"), *(F.col(k) == F.col(f"_{k}") for k in keys)])
    return nodes.join(renamed, on, "left").drop("_p", *(f"_{k}" for k in keys)).withColumn("child_count", F.coalesce("child_count", F.lit(0)))


def segments(number: Column) -> Column:
    """A dotted number as integers, for sorting 4.10 after 4.9; other parts sort as null."""
    return F.transform(F.split(number, r"\."), lambda p: p.try_cast("int"))


def promoted(seeds: DataFrame, candidates: DataFrame, number: str = "number", key: str = "doc_id", rounds: int = 6) -> DataFrame:
    """Numbers of candidates whose parent number is a seed, an ancestor of one, or itself promoted.

    A dotted number is at most as deep as the rounds, each a semi-join.
    """
    parent = F.expr(f"substring_index({number}, '.', size(split({number}, '[.]')) - 1)")
    known = seeds.select(key, number).distinct()
    up = known
    for _ in range(rounds - 1):
        up = up.filter(F.col(number).contains(".")).select(key, parent.alias(number)).distinct()
        known = known.unionByName(up)
    known = known.distinct()
    out = None
    for _ in range(rounds):
        new = candidates.filter(F.col(number).contains(".")).select(key, number, parent.alias("_parent")).join(known.select(F.col(key), F.col(number).alias("_parent")), [key, "_parent"], "left_semi").select(key, number).distinct()
        known = known.unionByName(new).distinct()
        out = new
    return out


def outline_differences(old: DataFrame, new: DataFrame, key: str, pos: str, title: str) -> DataFrame:
    """Outlines side by side by position: where titles differ or one side has none."""
    a = old.select(key, pos, F.col(title).alias("old_title"))
    b = new.select(key, pos, F.col(title).alias("new_title"))
    return a.join(b, [key, pos], "full").filter(~F.col("old_title").eqNullSafe(F.col("new_title")))
