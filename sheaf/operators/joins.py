"""Joins that aren't on equal keys: overlaps, bands and greedy matches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_overlap(left: DataFrame, right: DataFrame, key: str, least_share: float = 0.5, width: float | None = None) -> DataFrame:
    """For each left interval the right one it overlaps most, if by at least a share of its own length.

    Both sides have key, id, x0 and x1; ties go to the right interval that
    begins first, then to the smaller id. With a ``width`` the intervals meet in
    buckets of that width, so a key with very many intervals needs no
    comparison of all of them.
    """
    a = left.select(key, F.col("id").alias("left_id"), F.col("x0").alias("a0"), F.col("x1").alias("a1"))
    b = right.select(key, F.col("id").alias("right_id"), F.col("x0").alias("b0"), F.col("x1").alias("b1"))
    on = [key]
    if width:
        cover = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width)))
        a, b, on = a.withColumn("_cell", cover("a0", "a1")), b.withColumn("_cell", cover("b0", "b1")), [key, "_cell"]
    overlap = F.least("a1", "b1") - F.greatest("a0", "b0")
    met = a.join(b, on).withColumn("overlap", overlap).filter((F.col("overlap") > 0) & (F.col("overlap") >= least_share * (F.col("a1") - F.col("a0"))))
    best = met.groupBy(key, "left_id").agg(F.min_by(F.struct("right_id", "overlap"), F.struct(-F.col("overlap"), F.col("b0"), F.col("right_id"))).alias("_b"))
    return best.select(key, "left_id", "_b.right_id", "_b.overlap")


def clusters(rows: DataFrame, group: list[str], value: str, gap: float, name: str = "cluster") -> DataFrame:
    """Numbers one-dimensional clusters: a value over ``gap`` beyond the one before begins another."""
    w = W.partitionBy(*group).orderBy(value)
    begins = F.when(F.col(value) - F.lag(value).over(w) > gap, 1).otherwise(0)
    held = rows.withColumn("_new", begins)
    return held.withColumn(name, F.sum("_new").over(w.rangeBetween(W.unboundedPreceding, W.currentRow)) + 1).drop("_new")


def nearest_line(left: DataFrame, right: DataFrame, key: str, pos: str, text: str, model: Column | None = None, reach: int = 6) -> DataFrame:
    """For each left line the right line with an equal model text, else the most similar within reach.

    Similarity is one less the edit distance's share of the longer text. The
    band is met by bucket: a line meets the buckets around its own.
    """
    model = model if model is not None else F.col(text)
    a = left.select(key, F.col(pos).alias("left_pos"), F.col(text).alias("left_text"), model.alias("_m"))
    b = right.select(key, F.col(pos).alias("right_pos"), F.col(text).alias("right_text"), model.alias("_m"))
    exact = a.join(b, [key, "_m"]).groupBy(key, "left_pos").agg(F.min_by("right_pos", F.struct(F.abs(F.col("left_pos") - F.col("right_pos")), "right_pos")).alias("right_pos")).withColumn("similarity", F.lit(1.0))
    rest = a.join(exact.select(key, "left_pos"), [key, "left_pos"], "left_anti")
    around = F.explode(F.array(*(F.floor(F.col("left_pos") / reach) + k for k in (-1, 0, 1))))
    near = rest.withColumn("_cell", around).join(b.drop("_m").withColumn("_cell", F.floor(F.col("right_pos") / reach)), [key, "_cell"]).filter(F.abs(F.col("left_pos") - F.col("right_pos")) <= reach)
    alike = 1 - F.levenshtein("left_text", "right_text") / F.greatest(F.length("left_text"), F.length("right_text"), F.lit(1))
    close = near.withColumn("similarity", alike).groupBy(key, "left_pos").agg(F.min_by(F.struct("right_pos", "similarity"), F.struct(-F.col("similarity"), F.abs(F.col("left_pos") - F.col("right_pos")), "right_pos")).alias("_b"))
    return exact.unionByName(close.select(key, "left_pos", "_b.right_pos", "_b.similarity"))


def spliced(primary: DataFrame, second: DataFrame, keys: list[str], pos: str, body: str) -> DataFrame:
    """primary with its n-th body within the keys replaced by the n-th of the second source.

    Nothing is replaced within keys where the two count differently.
    """
    w = W.partitionBy(*keys).orderBy(pos)
    a = primary.withColumn("_n", F.row_number().over(w)).withColumn("_all", F.count("*").over(W.partitionBy(*keys)))
    b = second.select(*keys, F.row_number().over(w).alias("_n"), F.count("*").over(W.partitionBy(*keys)).alias("_all"), F.col(body).alias("_body"))
    return a.join(b, [*keys, "_n", "_all"], "left").withColumn("replaced", F.col("_body").isNotNull()).withColumn(body, F.coalesce("_body", body)).drop("_n", "_all", "_body")


def greedy_pairs(candidates: DataFrame, key: str) -> DataFrame:
    """One-to-one matches of (left_id, right_id) by rising cost within each key.

    The choice depends on all choices before it, so it runs by key in Python;
    a key is one document's figures.
    """

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, keep = set(), set(), []
        for row in pdf.sort_values(["cost", "left_id", "right_id"], kind="stable").itertuples():
            if row.left_id not in left and row.right_id not in right:
                left.add(row.left_id)
                right.add(row.right_id)
                keep.append(row.Index)
        return pdf.loc[keep]

    picked = candidates.select(key, "left_id", "right_id", "cost")
    return picked.groupBy(key).applyInPandas(choose, picked.schema)


def in_order(rows: DataFrame, key: str, pos: str, text: str, separator: str = "\n") -> DataFrame:
    """key and its texts joined in order."""
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos, text))), lambda s: s[text]), separator).alias(text))
