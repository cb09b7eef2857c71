"""Blocks of canonical Markdown: line classes, then runs of lines that belong together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.operators import lines

#: What a line of each class looks like, in order of precedence.
CLASSES = (
    ("box", r"(?U)^<!--\s*ssir:/?box\b.*-->\s*$"),
    ("columns", r"(?U)^<!--\s*ssir:/?columns?\b.*-->\s*$"),
    ("page", r"(?U)^<!--\s*/?ssir:mineru-pages\b.*-->\s*$"),
    ("footnote", r"(?U)^<!--\s*ssir:foot:[0-9A-Za-z_-]+\s*-->"),
    ("directive", r"(?U)^<!--\s*ssir:[a-z-]+.*-->\s*$"),
    ("heading", r"(?U)^#{1,6}\s+\S"),
    ("table", r"^\s*\|.*\|\s*$"),
    ("image", r"(?U)^!\[.*?\]\(.*?\)\s*$"),
    ("quote", r"^>"),
    ("list", r"(?U)^(?:[-—–]+|[*+]\s+|[●•·○])\s*\S|^(?:[A-Za-z]+|[0-9]+)[)）]"),
    ("caption", r"(?U)^\*\*[表图]\S+(?:\s+.+?)?\*\*$"),
    ("unit", r"(?U)^单位\s*[为:：]\s*\S{1,8}$"),
)
ATTRIBUTE = r'([A-Za-z][A-Za-z0-9-]*)="((?:\\.|[^"\\])*)"'
NUMBERED = r"(?U)^([A-Z]?\d*(?:\.\d+)*)\s*(.*)$"
TOC_HEADING = r"(?U)^#{1,6}\s+目\s*[次录]\s*$"
TOC_ENTRY = r"(?U)^\s*$|(?:\.{2,}|…+|·{2,}|\s)\s*[0-9IVXivx]+\s*$"
QUOTES = (("example", r"(?U)^示例\s*\d*\s*[:：]?"), ("note", r"(?U)^注\s*\d*\s*[:：]"), ("warning", "^(?:警告|注意|危险)"), ("figure", r"^!\["))
#: Kinds of which each line is a block of its own.
SINGLE = ("heading", "directive", "box", "columns", "page", "image", "caption", "unit", "footnote")


def classified(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, pos, line, kind and fence state; lines of a table of contents are gone."""
    kind = F.when(F.trim("line") == "", "blank")
    for name, pattern in CLASSES:
        kind = kind.when(F.col("line").rlike(pattern), name)
    cut = lines.lines(docs, key, text)
    cut = lines.fence_parity(cut, F.col("line").rlike("^```"), key, name="in_code").withColumnRenamed("unclosed", "open_code")
    formula = F.col("line").rlike(r"(?U)^\$\$") & ~F.col("line").rlike(r"(?U)^\$\$.*\$\$\s*$") & ~F.col("in_code") | (F.col("line").rlike(r"(?U)\$\$\s*$") & ~F.col("line").rlike(r"(?U)^\$\$") & ~F.col("in_code"))
    cut = lines.fence_parity(cut, formula, key, name="in_formula").withColumnRenamed("unclosed", "open_formula")
    cut = cut.withColumn("kind", F.when(F.col("in_code") | F.col("line").rlike("^```"), "code").when(F.col("in_formula") | F.col("line").rlike(r"(?U)^\$\$|\$\$\s*$"), "formula").otherwise(kind.otherwise("paragraph")))
    toc = lines.until_broken(cut, (F.col("kind") == "heading") & F.col("line").rlike(TOC_HEADING), F.col("line").rlike(TOC_ENTRY) & (F.col("kind") != "heading"), key, name="in_toc")
    return toc.filter(~F.col("in_toc")).drop("in_toc", "in_code", "in_formula")


def attributes(line: Column) -> Column:
    """Attributes of a directive as a map; the last of a name counts."""
    names, values = (F.regexp_extract_all(line, F.lit(ATTRIBUTE), F.lit(k)) for k in (1, 2))
    return F.map_from_arrays(F.array_distinct(names), F.transform(F.array_distinct(names), lambda n: F.element_at(F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda p: p["n"] == n), -1)["v"]))


def blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, pos, kind, start_line, end_line, text, level, number, title and attributes of every block.

    A block is a run of lines of one kind; blank lines between list items
    don't end a list, and a fenced formula or code is one block.
    """
    cut = classified(docs, key, text)
    w = W.partitionBy(key).orderBy("pos")
    solid = cut.filter("kind <> 'blank'").withColumns({"_before": F.lag("kind").over(w), "_before_pos": F.lag("pos").over(w), "_before_line": F.lag("line").over(w)})
    opens = F.col("line").rlike(r"(?U)^\$\$") & (F.col("kind") == "formula") & F.col("_before_line").rlike(r"(?U)\$\$\s*$")
    begins = (
        ~F.col("kind").eqNullSafe(F.col("_before"))
        | F.col("kind").isin(*SINGLE)
        | ((F.col("pos") - F.col("_before_pos") > 1) & ~F.col("kind").isin("list", "code", "formula"))
        | opens
    )
    held = solid.withColumn("_b", lines.running(F.when(begins, 1).otherwise(0), key))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), "\n")
    made = held.groupBy(key, "_b").agg(F.min("pos").alias("start_line"), F.max("pos").alias("end_line"), F.first("kind").alias("kind"), joined.alias("text"))
    level = F.when(F.col("kind") == "heading", F.length(F.regexp_extract("text", "^(#+)", 1)))
    name = F.when(F.col("kind") == "heading", F.regexp_replace("text", r"(?U)^#+\s+|\s+$", ""))
    annex = F.regexp_extract(name, r"(?U)^附\s*录\s*([A-Z])(?![A-Za-z])", 1)
    plain = F.regexp_extract(name, r"(?U)^([A-Z](?:\.\d+)+|\d+(?:\.\d+)*)(?=[\s一-龥A-Za-z（(]|$)", 1)
    number = F.when(annex != "", annex).when(plain != "", plain)
    kind = F.col("kind")
    inner = F.regexp_replace("text", r"(?U)^>\s*", "")
    for quote, pattern in reversed(QUOTES):
        kind = F.when((F.col("kind") == "quote") & inner.rlike(pattern), quote).otherwise(kind)
    out = made.withColumns({"level": level, "name": name, "number": number}).withColumn("kind", kind)
    title = F.when(F.col("number").isNotNull(), F.regexp_replace("name", r"(?U)^(?:附\s*录\s*[A-Z]|[A-Z](?:\.\d+)+|\d+(?:\.\d+)*)\s*", "")).otherwise(F.col("name"))
    # runs are numbered from 1 without gaps, so a run's number is its block's place
    return out.select(key, F.col("_b").cast("int").alias("pos"), "kind", "start_line", "end_line", "text", "level", "number", title.alias("title"), F.when(F.col("kind").isin("directive", "box", "columns"), attributes(F.col("text"))).alias("attributes"))


def folded_units(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tables and figures take the unit line or bold caption right before them; those blocks are gone."""
    w = W.partitionBy(key).orderBy("pos")
    before = {k: (F.lag("kind", k).over(w), F.lag("text", k).over(w)) for k in (1, 2)}
    target = F.col("kind").isin("table", "figure", "image")

    def taken(kind: str) -> Column:
        return F.when(target, F.coalesce(F.when(before[1][0] == kind, before[1][1]), F.when((before[2][0] == kind) & before[1][0].isin("unit", "caption"), before[2][1])))

    ahead = F.when(F.lead("kind").over(w).isin("unit", "caption"), F.lead("kind", 2).over(w)).otherwise(F.lead("kind").over(w))
    folded = F.col("kind").isin("unit", "caption") & ahead.isin("table", "figure", "image")
    held = rows.withColumns({"unit": F.regexp_extract(taken("unit"), r"(?U)^单位\s*[为:：]\s*(\S+)$", 1), "caption": F.regexp_replace(taken("caption"), r"^\*\*|\*\*$", ""), "_gone": F.coalesce(folded, F.lit(False))})
    held = held.withColumn("unit", F.when(F.col("unit") != "", F.col("unit")))
    return held.filter(~F.col("_gone")).drop("_gone")


def cells(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Cells of pipe tables: key, pos, row, col, cell; the separator row is gone and an escaped bar is text."""
    cut = rows.filter("kind = 'table'").select(key, "pos", F.posexplode(F.split("text", "\n")).alias("_r", "_line"))
    real = cut.filter(~F.col("_line").rlike(r"(?U)^\s*\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)*\|?\s*$"))
    real = real.withColumn("row", F.row_number().over(W.partitionBy(key, "pos").orderBy("_r")) - 1)
    inner = F.regexp_replace("_line", r"^\s*\||\|\s*$", "")
    parts = F.split(inner, r"(?<!\\)(?:\\\\)*\|", -1)
    return real.select(key, "pos", "row", F.posexplode(parts).alias("col", "_c")).select(key, "pos", "row", "col", F.regexp_replace(F.trim("_c"), r"\\\|", "|").alias("cell"))


def items(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Items of lists: key, pos, item, marker, marker_kind and text; ) is written ）."""
    cut = rows.filter("kind = 'list'").select(key, "pos", F.posexplode(F.split("text", "\n")).alias("item", "_line"))
    marker = F.regexp_replace(F.regexp_extract("_line", r"(?U)^([-—–]+|[*+]|[●•·○]|[A-Za-z]+[)）]|\d+[)）])", 1), r"\)$", "）")
    kind = F.when(F.col("marker").rlike("^[A-Za-z]"), "letter").when(F.col("marker").rlike("^[0-9]"), "digit").otherwise("symbol")
    held = cut.withColumn("marker", marker).withColumn("marker_kind", kind)
    return held.select(key, "pos", "item", "marker", "marker_kind", F.regexp_replace("_line", r"(?U)^(?:[-—–]+|[*+]|[●•·○]|[A-Za-z]+[)）]|\d+[)）])\s*", "").alias("text"))


def padded(grid: DataFrame, key: str = "doc_id") -> DataFrame:
    """Cells with blank ones where a row is shorter than the first; rows that are longer are marked too_long."""
    rows = grid.groupBy(key, "pos", "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "cell"))).alias("_cells"), (F.max("col") + 1).alias("_n"))
    width = F.max(F.when(F.col("row") == 0, F.col("_n"))).over(W.partitionBy(key, "pos"))
    every = F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest("_width", "_n") - 1), lambda c: F.coalesce(F.try_element_at("_cells", c), F.lit(""))))
    return rows.withColumn("_width", width).filter("_width IS NOT NULL").select(key, "pos", "row", every.alias("col", "cell"), (F.col("_n") > F.col("_width")).alias("too_long"))


def sections(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Heading nodes with the blocks under them: key, pos, kind, level, number, title, node_type, parent_pos.

    The first heading of level 1 names the document and is no node; annex
    sections hang under their annex by letter, other blocks under the latest
    heading.
    """
    from sheaf.operators import tree

    depth = F.when(F.col("kind") == "heading", F.when(F.col("number").rlike(r"^[0-9A-Z]+(?:\.[0-9]+)*$"), F.size(F.split("number", r"\."))).otherwise(F.greatest(F.col("level") - 1, F.lit(1))))
    first = F.min(F.when((F.col("kind") == "heading") & (F.col("level") == 1), F.col("pos"))).over(W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))  # the order of the parents' window: one sort
    own = rows.withColumn("_first", first).filter(~F.col("pos").eqNullSafe(F.col("_first"))).drop("_first").withColumn("depth", depth)
    kind = (
        F.when(F.col("kind") != "heading", F.lit(None))
        .when(F.col("number").rlike("^[A-Z]$"), "annex")
        .when(F.col("number").rlike(r"^[A-Z]\."), "annexSection")
        .when(F.col("number").rlike(r"^\d+$"), "section")
        .when(F.col("number").rlike(r"^\d+\.\d+$"), "clause")
        .when(F.col("number").isNotNull(), "subClause")
        .otherwise("documentBlock")
    )
    return tree.parents(own.withColumn("node_type", kind), "depth", key)


def canonical(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and the Markdown that its blocks make, a blank line between blocks."""
    from sheaf.operators.joins import in_order

    return in_order(rows, key, "pos", "text", "\n\n")
