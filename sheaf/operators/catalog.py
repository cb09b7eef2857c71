"""Look-ups and summaries over stored documents and their structure rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.functions.citations import squeezed
from sheaf.operators import checks, tree

#: Elements of a standard by title, with their code, nature and group.
ELEMENTS = (
    ("前言", "foreword", "informative", "front"),
    ("引言", "introduction", "informative", "front"),
    ("范围", "scope", "normative", "body"),
    ("规范性引用文件", "normativeReferences", "informative", "body"),
    ("术语和定义", "terms", "normative", "body"),
    ("符号", "symbols", "normative", "body"),
    ("分类", "classification", "normative", "body"),
    ("要求", "requirements", "normative", "body"),
    ("试验方法", "testMethods", "normative", "body"),
    ("检验规则", "inspectionRules", "normative", "body"),
    ("标志", "marking", "normative", "body"),
    ("参考文献", "bibliography", "informative", "back"),
    ("索引", "index", "informative", "back"),
)
ROLES = {"proposing": r"本文件由(.+?)提出", "secretariat": r"本文件由(.+?)归口", "units": r"起草单位[:：](.+?)[。\n]", "drafters": r"主要起草人[:：](.+?)[。\n]"}


def documents(store: DataFrame) -> DataFrame:
    return store.orderBy("standard_number")


def document(store: DataFrame, doc_id: str) -> DataFrame:
    return store.filter(F.col("doc_id") == doc_id)


def structure(rows: DataFrame, doc_id: str) -> DataFrame:
    """A document's rows by sort order, then number."""
    return rows.filter(F.col("doc_id") == doc_id).orderBy(F.coalesce("sort_order", F.lit(0)), "number")


def row(rows: DataFrame, doc_id: str, node_id: str) -> DataFrame:
    return rows.filter((F.col("doc_id") == doc_id) & (F.col("id") == node_id))


def children(rows: DataFrame, doc_id: str, parent_id: str | None) -> DataFrame:
    """Rows under a parent, the roots for None, with their own child counts."""
    counted = tree.child_counts(rows.filter(F.col("doc_id") == doc_id), "id", "parent_id")
    return counted.filter(F.col("parent_id").eqNullSafe(F.lit(parent_id))).orderBy(F.coalesce("sort_order", F.lit(0)), "number")


def source_lines(lines: DataFrame, doc_id: str, first: int, last: int, most: int = 200) -> DataFrame:
    """Lines first to last, counted from 1, at most ``most`` of them."""
    first = max(1, first)
    return lines.filter((F.col("doc_id") == doc_id) & F.col("pos").between(first - 1, min(last, first + most - 1) - 1)).orderBy("pos")


def detail(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Counts by kind of each document's nodes and blocks."""
    a = nodes.groupBy("doc_id").agg(*(F.count_if(F.col("node_type") == k).alias(f"n_{k}") for k in ("section", "clause", "subClause", "annex", "annexSection")))
    b = blocks.groupBy("doc_id").agg(*(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("paragraph", "list", "table", "image", "formula", "note")))
    return a.join(b, "doc_id", "full").na.fill(0)


def terms(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Entries of the terms chapter with their Latin name and definition, by number.

    An entry is a numbered heading, its name there or in the line after it; the
    first paragraph that opens no bracket defines it.
    """
    w = W.partitionBy("doc_id").orderBy("pos")
    chapter = F.last(F.when((F.col("kind") == "heading") & F.col("number").rlike(r"^\d+$"), F.col("title").contains("术语")), True).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    held = blocks.withColumn("_in", F.coalesce(chapter, F.lit(False))).filter("_in")
    entry = (F.col("kind") == "heading") & F.col("number").contains(".")
    held = held.withColumn("_entry", F.sum(F.when(entry, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).filter("_entry > 0")
    said = F.when((F.col("kind") == "paragraph") & ~F.col("text").startswith("["), F.col("text"))
    made = held.groupBy("doc_id", "_entry").agg(F.min_by("number", "pos").alias("number"), F.min_by("title", "pos").alias("_title"), F.array_sort(F.collect_list(F.when(said.isNotNull(), F.struct("pos", said.alias("text"))))).alias("_said"))
    name = F.when(F.coalesce("_title", F.lit("")) != "", F.col("_title")).otherwise(F.try_element_at("_said", F.lit(1))["text"])
    nth = F.when(F.coalesce("_title", F.lit("")) != "", 1).otherwise(2)
    out = made.select("doc_id", "number", name.alias("_name"), F.try_element_at("_said", nth)["text"].alias("definition"))
    latin = F.regexp_extract("_name", r"(?U)([A-Za-z][A-Za-z \-;,()]*)$", 1)
    return out.select("doc_id", "number", F.trim(F.regexp_replace(F.col("_name"), r"(?U)[\s　]*[A-Za-z][A-Za-z \-;,()]*$", "")).alias("term"), F.when(latin != "", F.trim(latin)).alias("english_term"), "definition").orderBy("doc_id", tree.segments(F.col("number")))


def organisations(blocks: DataFrame) -> DataFrame:
    """Who proposed, keeps and drafted a document, from its foreword."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), "\n")
    made = blocks.filter("kind = 'paragraph'").filter(F.col("text").rlike("提出|归口|起草")).groupBy("doc_id").agg(F.concat(text, F.lit("\n")).alias("_t"))
    found = {k: F.regexp_extract("_t", p, 1) for k, p in ROLES.items()}
    split = lambda c: F.filter(F.split(c, "[、，,]"), lambda v: v != "")
    return made.select("doc_id", *(F.when(found[k] != "", F.trim(found[k])).alias(k) for k in ("proposing", "secretariat")), *(split(found[k]).alias(k) for k in ("units", "drafters")))


def element_of(title: Column, node_type: Column) -> Column:
    """(code, nature, part) of a top-level node; annexes and others by kind."""
    out = F.struct(F.lit("technical").alias("code"), F.lit("normative").alias("nature"), F.lit("body").alias("part"))
    for name, code, nature, part in reversed(ELEMENTS):
        out = F.when(squeezed(title).contains(name), F.struct(F.lit(code).alias("code"), F.lit(nature).alias("nature"), F.lit(part).alias("part"))).otherwise(out)
    annex = F.struct(F.lit("annex").alias("code"), F.when(title.contains("资料性"), "informative").otherwise("normative").alias("nature"), F.lit("annex").alias("part"))
    return F.when(node_type == "annex", annex).otherwise(out)


def elements(nodes: DataFrame) -> DataFrame:
    """Top-level nodes with what element each is."""
    return nodes.filter("parent_pos IS NULL AND node_type IS NOT NULL").select("doc_id", "pos", "title", element_of(F.col("title"), F.col("node_type")).alias("_e")).select("doc_id", "pos", "title", "_e.*")


def element_coverage(nodes: DataFrame) -> DataFrame:
    """Which elements the documents have, and in how many places."""
    return checks.coverage(elements(nodes), "code", [code for _, code, _, _ in ELEMENTS] + ["annex"])


def contents(nodes: DataFrame, depth: int = 2) -> DataFrame:
    """Entries of a table of contents: numbered headings down to a depth, annexes, front and back matter."""
    known = F.col("title").rlike("^(?:前言|引言|参考文献|索引)")
    kept = (F.col("node_type") == "annex") | (F.col("number").isNotNull() & (F.size(F.split("number", r"\.")) <= depth) & F.col("node_type").isin("section", "clause")) | known
    return nodes.filter("kind = 'heading'").filter(kept).select("doc_id", "pos", "number", "title", F.lead("title").over(W.partitionBy("doc_id").orderBy("pos")).alias("next_title")).orderBy("doc_id", "pos")
