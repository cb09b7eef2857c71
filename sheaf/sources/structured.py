"""Structured documents stored as nested JSON, read into flat tables; and a table of runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEPTH = 8
_CONTENT = "array<struct<id:string,presentationType:string,sortOrder:int,textContent:string>>"


def node_type(depth: int = DEPTH) -> str:
    """The type of a node whose children nest so deep: types can't be recursive."""
    children = f",children:array<{node_type(depth - 1)}>" if depth else ""
    return f"struct<id:string,nodeType:string,level:int,number:string,title:string,term:string,englishTerm:string,sortOrder:int,contentElements:{_CONTENT}{children}>"


def read_structured(spark: SparkSession, path: str, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, title and their root) and the files that are no such document."""
    schema = f"id string, metadata map<string,string>, structuralRoot {node_type(depth)}, _corrupt string"
    got = spark.read.schema(schema).option("multiLine", "true").option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("path", F.input_file_name())
    broken = F.col("_corrupt").isNotNull() | F.col("structuralRoot").isNull()
    return got.filter(~broken).select(F.coalesce("id", "path").alias("doc_id"), "metadata", F.col("structuralRoot").alias("root"), "path"), got.filter(broken).select("path", F.col("_corrupt").alias("text"))


def structure(documents: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, node_id, parent_id, depth, path and fields of every node below the roots, level by level."""
    level = documents.select("doc_id", F.col("root.id").alias("parent_id"), F.array(F.col("root.id")).alias("path"), F.explode("root.children").alias("n"))
    out = []
    for k in range(1, depth + 1):
        rows = level.select("doc_id", "parent_id", F.concat("path", F.array("n.id")).alias("path"), "n")
        out.append(rows.select("doc_id", F.col("n.id").alias("node_id"), "parent_id", F.lit(k).alias("depth"), "path", F.col("n.nodeType").alias("node_type"), "n.level", "n.number", "n.title", "n.term", F.col("n.sortOrder").alias("sort_order"), F.col("n.contentElements").alias("contents")))
        if k < depth:
            level = rows.select("doc_id", F.col("n.id").alias("parent_id"), "path", F.explode("n.children").alias("n"))
    return reduce(DataFrame.unionByName, out)


def contents(nodes: DataFrame) -> DataFrame:
    """Content elements with the node each stands under."""
    return nodes.select("doc_id", "node_id", F.explode("contents").alias("c")).select("doc_id", F.col("node_id").alias("parent_id"), F.col("c.id").alias("content_id"), F.col("c.presentationType").alias("presentation"), F.col("c.sortOrder").alias("sort_order"), F.col("c.textContent").alias("text"))


def runs(files: DataFrame, issues: DataFrame) -> DataFrame:
    """One row for each document of a run: hash, issues, and whether it is complete, partial or failed."""
    counts = issues.groupBy("doc_id").agg(F.count("*").alias("n_issues"))
    status = F.when(F.col("fatal"), "failed").when(F.col("n_issues") > 0, "partial").otherwise("complete")
    return files.join(counts, "doc_id", "left").select("doc_id", "sha256", F.coalesce("n_issues", F.lit(0)).alias("n_issues"), status.alias("status"))
