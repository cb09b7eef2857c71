"""Graph and catalogue views of structure tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_CUT = 400


def nodes_of(*parts: tuple[DataFrame, str, str, Column, Column]) -> DataFrame:
    """(id, kind, parent, title) of several tables; titles are cut at 400 characters."""
    each = [rows.select(F.col(node).cast("string").alias("id"), F.lit(kind).alias("kind"), parent.cast("string").alias("parent"), F.substring(title, 1, TEXT_CUT).alias("title")) for rows, kind, node, parent, title in parts]
    return reduce(DataFrame.unionByName, each)


def edges_of(nodes: DataFrame, kind: str = "HAS_CHILD") -> DataFrame:
    """Distinct edges from parents to nodes."""
    return nodes.filter("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("id").alias("target"), F.lit(kind).alias("type")).distinct()


def counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """How many nodes of each kind and edges of each type there are."""
    a = nodes.groupBy(F.col("kind").alias("name")).agg(F.count("*").alias("n")).withColumn("what", F.lit("node"))
    return a.unionByName(edges.groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")).withColumn("what", F.lit("edge")))


def core(nodes: DataFrame, edges: DataFrame, dropped: list[str]) -> tuple[DataFrame, DataFrame]:
    """The graph without nodes of some kinds and the edges that touch them."""
    kept = nodes.filter(~F.col("kind").isin(dropped))
    ids = kept.select("id")
    return kept, edges.join(ids, edges["source"] == ids["id"], "left_semi").join(ids, edges["target"] == ids["id"], "left_semi")


def faults(nodes: DataFrame, edges: DataFrame, kinds: list[str], types: list[str]) -> DataFrame:
    """What a graph's schema forbids: unknown kinds or types, repeated ids, edges to nowhere."""
    bad_kind = nodes.filter(~F.col("kind").isin(kinds)).select(F.lit("unknown kind").alias("fault"), F.col("id").alias("subject"))
    bad_type = edges.filter(~F.col("type").isin(types)).select(F.lit("unknown type").alias("fault"), F.col("source").alias("subject"))
    twice = nodes.groupBy("id").count().filter("count > 1").select(F.lit("repeated id").alias("fault"), F.col("id").alias("subject"))
    ids = nodes.select(F.col("id").alias("_id"))
    lost = edges.join(ids, F.col("target") == F.col("_id"), "left_anti").select(F.lit("missing target").alias("fault"), F.col("target").alias("subject"))
    return bad_kind.unionByName(bad_type).unionByName(twice).unionByName(lost)
