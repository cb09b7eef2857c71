"""Content under the nodes: notes, footnotes, declarations, semantic tags and layout matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.operators.joins import clusters, greedy_pairs
from sheaf.operators.rules import finding

#: How footnotes, their marks and variable lines are written.
FOOT = r"(?s)<!--\s*ssir:foot:([0-9A-Za-z_-]+)\s*-->(.*?)<!--\s*ssir:/\s*foot\s*-->"
CITE = r"\[foot:([0-9A-Za-z_-]+(?:[、,，][0-9A-Za-z_-]+)*)\]"
VARIABLE = r"(?U)^(\S{1,20}?)\s*[—–-]{1,2}\s*(.+?)[；;。.]?$"
PRESENTATION = {"paragraph": "paragraph", "heading": "heading", "list": "list", "table": "table", "image": "figure", "figure": "figure", "formula": "formula", "note": "note", "example": "example", "warning": "warning", "quote": "quote", "footnote": "footnote"}


def footnotes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, position, label and definition of footnotes; several may stand in one text."""
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(FOOT), F.lit(1)).alias("label"), F.regexp_extract_all(text, F.lit(FOOT), F.lit(2)).alias("definition"))
    return docs.select("doc_id", F.posexplode(pairs).alias("position", "_f")).select("doc_id", "position", "_f.label", F.trim("_f.definition").alias("definition"))


def footnote_citations(blocks: DataFrame) -> DataFrame:
    """doc_id, pos and each label that a block cites; a mark may name several."""
    marks = F.flatten(F.transform(F.regexp_extract_all("text", F.lit(CITE), F.lit(1)), lambda m: F.split(m, "[、,，]")))
    return blocks.select("doc_id", "pos", F.explode(F.array_distinct(marks)).alias("label"))


def anchored(citations: DataFrame, definitions: DataFrame, ancestors: DataFrame) -> DataFrame:
    """For each citation the definition in its own node, else in the nearest ancestor, else the only one of that label.

    citations have doc_id, node and label; definitions doc_id, node, label and
    note_id; ancestors doc_id, node, ancestor and distance.
    """
    reach = ancestors.select("doc_id", "node", "ancestor", "distance").unionByName(ancestors.select("doc_id", "node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")).distinct())
    reach = reach.unionByName(citations.select("doc_id", "node", F.col("node").alias("ancestor"), F.lit(0).alias("distance"))).distinct()
    near = citations.join(reach, ["doc_id", "node"]).join(definitions.select("doc_id", F.col("node").alias("ancestor"), "label", "note_id"), ["doc_id", "ancestor", "label"])
    best = near.groupBy("doc_id", "node", "label").agg(F.min_by("note_id", F.struct("distance", "note_id")).alias("_near"))
    alone = definitions.groupBy("doc_id", "label").agg(F.count("*").alias("_n"), F.min("note_id").alias("_only"))
    joined = citations.join(best, ["doc_id", "node", "label"], "left").join(alone, ["doc_id", "label"], "left")
    return joined.withColumn("note_id", F.coalesce("_near", F.when(F.col("_n") == 1, F.col("_only")))).drop("_near", "_n", "_only")


def presentation_of(kind: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(v) for kv in PRESENTATION.items() for v in kv)), kind), F.lit("other"))


def semantic_types(chapter_number: Column, chapter_title: Column) -> Column:
    """What a block's chapter makes of it: scope, normativeReference, testMethod, inspectionRule."""
    tags = F.array(
        F.when((chapter_number == "1") | chapter_title.contains("范围"), "scope"),
        F.when(chapter_title.contains("规范性引用文件"), "normativeReference"),
        F.when(chapter_title.contains("试验"), "testMethod"),
        F.when(chapter_title.contains("检验"), "inspectionRule"),
    )
    return F.filter(tags, lambda t: t.isNotNull())


def list_intros(blocks: DataFrame, node: str = "parent_pos") -> DataFrame:
    """List blocks with the sibling right before them, what introduces the list."""
    return blocks.withColumn("intro_pos", F.lag("pos").over(W.partitionBy("doc_id", node).orderBy("pos"))).filter("kind = 'list'")


def formula_variables(blocks: DataFrame) -> DataFrame:
    """Lines after a lone 式中： as symbol and definition; a group has two lines at least."""
    w = W.partitionBy("doc_id").orderBy("pos")
    is_intro, is_item = F.col("text").rlike(r"(?U)^式中\s*[:：]\s*$"), F.col("text").rlike(VARIABLE)
    held = blocks.withColumn("_group", F.sum(F.when(is_intro, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    g = W.partitionBy("doc_id", "_group").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = held.filter("_group > 0").withColumn("_off", F.max(F.when(is_intro | is_item, 0).otherwise(1)).over(g)).filter(F.col("_off") == 0).filter(~is_intro)
    kept = run.withColumn("_n", F.count("*").over(W.partitionBy("doc_id", "_group"))).filter("_n >= 2")
    last = F.col("pos") == F.max("pos").over(W.partitionBy("doc_id", "_group"))
    parts = {k: F.regexp_extract("text", VARIABLE, i) for i, k in ((1, "symbol"), (2, "definition"))}
    line = F.concat(parts["symbol"], F.lit("——"), parts["definition"], F.when(last | F.col("text").endswith("。"), "。").otherwise("；"))
    return kept.select("doc_id", "pos", *(c.alias(k) for k, c in parts.items()), line.alias("text"))


def absorbed_notes(blocks: DataFrame) -> DataFrame:
    """Tables whose last row begins with 注 take the notes and continuations after them, joined by a break."""
    w = W.partitionBy("doc_id").orderBy("pos")
    last_row = F.element_at(F.split("text", "\n"), -1)
    opens = (F.col("kind") == "table") & last_row.rlike(r"(?U)^\s*\|\s*注\s*\d*\s*[:：]")
    follows = (F.col("kind") == "paragraph") & F.col("text").rlike(r"(?U)^(?:注\s*\d*\s*[:：]|[a-z]\s*(?:[)）]|\s))")
    held = blocks.withColumn("_t", F.last(F.when(opens, F.col("pos")).when(~follows, F.lit(-1)), True).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    taken = held.filter(follows & (F.col("_t") >= 0))
    spill = taken.groupBy("doc_id", F.col("_t").alias("pos")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), "<br>").alias("_spill"))
    rest = blocks.join(taken.select("doc_id", "pos"), ["doc_id", "pos"], "left_anti").join(spill, ["doc_id", "pos"], "left")
    return rest.withColumn("text", F.when(F.col("_spill").isNotNull(), F.regexp_replace("text", r"(?U)\s*\|\s*$", F.concat(F.lit("<br>"), "_spill", F.lit(" |")))).otherwise(F.col("text"))).drop("_spill")


def demoted_index_letters(blocks: DataFrame) -> DataFrame:
    """Single-letter headings inside the index become paragraphs."""
    w = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    letter = (F.col("kind") == "heading") & F.concat_ws("", "number", "title").rlike("^[A-Z]$")
    index = F.last(F.when((F.col("kind") == "heading") & ~letter, F.regexp_replace("title", r"(?U)\s", "").startswith("索引")), True).over(w)
    hit = letter & F.coalesce(index, F.lit(False))
    return blocks.withColumn("issue", F.when(hit, "CSM-OCR-019")).withColumn("kind", F.when(hit, "paragraph").otherwise(F.col("kind")))


def reference_chapter(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Findings on chapter 2: its title, its lead-in, numbered list markers, entries without a number."""
    chapter = nodes.filter("number = '2' AND node_type = 'section'").select("doc_id", F.col("pos").alias("parent_pos"), "title")
    own = blocks.join(chapter.select("doc_id", "parent_pos"), ["doc_id", "parent_pos"])
    leads = own.filter("kind = 'paragraph'").groupBy("doc_id").agg(F.max(F.col("text").rlike("下列文件|没有规范性引用文件|无规范性引用文件").cast("int")).alias("_lead"))
    title = finding(chapter.filter(~F.col("title").contains("规范性引用文件")), F.col("title"), "GBT-C06", "must", "chapter 2 is not the list of references")
    lead = finding(chapter.join(leads, "doc_id", "left").filter("coalesce(_lead, 0) = 0"), F.lit("lead-in"), "GBT-C06", "must", "the list has no lead-in")
    marked = finding(own.filter((F.col("kind") == "list") & F.col("text").rlike(r"(?m)^(?:\d+|[a-z])[)）]")), F.col("pos"), "GBT-C06", "should", "entries are numbered")
    return title.unionByName(lead).unionByName(marked)


def standard_names(meta: DataFrame) -> DataFrame:
    """Findings on titles: no word of the kind, no known kind; meta has doc_id and a map."""
    from sheaf.functions import titles

    held = meta.select("doc_id", F.coalesce(F.try_element_at("meta", F.lit("title")), F.lit("")).alias("title")).withColumn("_k", titles.kind_of(F.col("title"))["kind"])
    odd = finding(held.filter(~titles.fits_kind(F.col("title"), F.col("_k"))), F.col("title"), "GBT-N01", "should", "title lacks a word of its kind")
    return odd.unionByName(finding(held.filter(F.col("_k") == titles.OTHER), F.col("title"), "GBT-N02", "should", "title names no kind"))


def source_sizes(assets: DataFrame, boxes: DataFrame, most_apart: float = 0.12, density: tuple[float, float] = (1.2, 4.0)) -> DataFrame:
    """Each asset's size in points from the box that fits its shape, one box to an asset.

    assets have doc_id, asset, width and height in pixels; boxes doc_id, box,
    width and height in points. Shapes may differ by ``most_apart``, pixels to a
    point lie within ``density``; what finds no box gets the upper median
    density of those that do, or 200/72.
    """
    a = assets.select("doc_id", F.col("asset").alias("left_id"), F.col("width").alias("aw"), F.col("height").alias("ah"))
    b = boxes.select("doc_id", F.col("box").alias("right_id"), F.col("width").alias("bw"), F.col("height").alias("bh"))
    shape = F.abs(F.col("aw") / F.col("ah") - F.col("bw") / F.col("bh")) / (F.col("bw") / F.col("bh"))
    met = a.join(b, "doc_id").withColumns({"cost": shape, "density": F.col("aw") / F.col("bw")}).filter((F.col("cost") < most_apart) & F.col("density").between(*density))
    pairs = greedy_pairs(met, "doc_id").select("doc_id", "left_id", "right_id").join(met, ["doc_id", "left_id", "right_id"])
    ranked = pairs.withColumn("_r", F.row_number().over(W.partitionBy("doc_id").orderBy("density"))).withColumn("_n", F.count("*").over(W.partitionBy("doc_id")))
    median = ranked.filter(F.col("_r") == F.floor(F.col("_n") / 2) + 1).select("doc_id", F.col("density").alias("_median"))
    joined = a.join(pairs.select("doc_id", "left_id", "right_id", "bw", "bh"), ["doc_id", "left_id"], "left").join(median, "doc_id", "left")
    by = F.coalesce("_median", F.lit(200 / 72))
    return joined.select("doc_id", F.col("left_id").alias("asset"), F.col("right_id").alias("box"), F.coalesce("bw", F.col("aw") / by).alias("width"), F.coalesce("bh", F.col("ah") / by).alias("height"))


def side_by_side(boxes: DataFrame, gap: float = 20.0) -> DataFrame:
    """Boxes that stand beside others: doc_id, page, id, band and column, for bands of two or three columns.

    Bands are runs of boxes whose vertical ranges touch; within one, boxes
    cluster by their left edges.
    """
    w = W.partitionBy("doc_id", "page").orderBy("y0")
    below = F.max("y1").over(w.rowsBetween(W.unboundedPreceding, -1))
    banded = boxes.withColumn("_new", F.when(F.col("y0") >= F.coalesce(below, F.lit(float("-inf"))), 1).otherwise(0))
    banded = banded.withColumn("band", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("_new")
    columns = clusters(banded, ["doc_id", "page", "band"], "x0", gap, "column")
    counted = columns.withColumn("n_columns", F.max("column").over(W.partitionBy("doc_id", "page", "band")))
    return counted.filter(F.col("n_columns").between(2, 3)).select("doc_id", "page", "id", "band", "column", "n_columns")


def quality_status(documents: DataFrame, issues: DataFrame, figures: DataFrame) -> DataFrame:
    """partial where a document has an issue, else complete; confidence is half where a figure lacks its asset."""
    counts = issues.groupBy("doc_id").agg(F.count("*").alias("n_issues"))
    lost = figures.groupBy("doc_id").agg(F.count_if(F.coalesce("asset_ref", F.lit("")) == "").alias("_lost"))
    held = documents.select("doc_id").join(counts, "doc_id", "left").join(lost, "doc_id", "left")
    return held.select("doc_id", F.coalesce("n_issues", F.lit(0)).alias("n_issues"), F.when(F.col("n_issues") > 0, "partial").otherwise("complete").alias("status"), F.when(F.col("_lost") > 0, 0.5).otherwise(1.0).alias("figure_confidence"))
