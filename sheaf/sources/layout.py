"""Page layout JSON: blocks in reading order, figures, captions and cover lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.operators.joins import best_overlap

_LINE = "array<struct<bbox:array<double>,spans:array<struct<type:string,content:string,latex:string,html:string,image_path:string,bbox:array<double>>>>>"
_BLOCK = f"type:string,bbox:array<double>,merge_prev:boolean,lines:{_LINE}"
SCHEMA = f"pdf_info array<struct<page_idx:int,para_blocks:array<struct<{_BLOCK},blocks:array<struct<{_BLOCK}>>>>,discarded_blocks:array<struct<{_BLOCK}>>>>"
LATIN = "[A-Za-z0-9]"
KEPT_LINES = ("ref_text", "index", "list")
KNOWN = ("title", "text", "table", "image", "chart", "interline_equation", *KEPT_LINES)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the path) and the pages of layout files."""
    return spark.read.schema(SCHEMA).json(path, multiLine=True).withColumn("doc_id", F.input_file_name())


def page_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, page, block and the block's parts, in reading order; ``unknown`` marks kinds that are skipped."""
    pages = docs.select("doc_id", F.explode("pdf_info").alias("p"))
    each = pages.select("doc_id", F.col("p.page_idx").alias("page"), F.posexplode("p.para_blocks").alias("block", "b"))
    return each.select("doc_id", "page", "block", "b.type", "b.bbox", F.coalesce("b.merge_prev", F.lit(False)).alias("merge_prev"), "b.lines", "b.blocks", (~F.col("b.type").isin(*KNOWN)).alias("unknown"))


def _span(span: Column) -> Column:
    return F.when(span["type"] == "inline_equation", F.concat(F.lit("$"), F.coalesce(span["latex"], span["content"]), F.lit("$"))).otherwise(F.coalesce(span["content"], F.lit("")))


def glued(parts: Column) -> Column:
    """Texts joined: a space between Latin ends, nothing next to Han."""
    gap = lambda a, b: F.when(a.rlike(LATIN + "$") & b.rlike("^" + LATIN), F.lit(" ")).otherwise("")
    return F.aggregate(F.filter(parts, lambda p: p != ""), F.lit(""), lambda a, b: F.concat(a, gap(a, b), b))


def text_of(lines: Column, kind: Column) -> Column:
    """A block's text; lists and references keep their lines."""
    each = F.transform(lines, lambda line: glued(F.transform(line["spans"], _span)))
    return F.when(kind.isin(*KEPT_LINES), F.array_join(F.filter(each, lambda t: t != ""), "\n")).otherwise(glued(each))


def paragraphs(blocks: DataFrame) -> DataFrame:
    """doc_id, page, block and text of titles and texts, continued ones glued to the block they continue."""
    own = blocks.filter(F.col("type").isin("title", "text", *KEPT_LINES)).withColumn("text", text_of(F.col("lines"), F.col("type")))
    w = W.partitionBy("doc_id").orderBy("page", "block").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = own.withColumn("_run", F.sum(F.when(F.col("merge_prev") & (F.col("type") == "text"), 0).otherwise(1)).over(w))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page", "block", "text"))), lambda s: s["text"])
    made = run.groupBy("doc_id", "_run").agg(F.min(F.struct("page", "block", "type")).alias("_s"), glued(parts).alias("text"))
    return made.select("doc_id", "_s.page", "_s.block", "_s.type", F.when(F.col("_s.type") == "title", F.concat(F.lit("## "), "text")).otherwise(F.col("text")).alias("text"))


def inner_boxes(blocks: DataFrame, ending: str) -> DataFrame:
    """doc_id, page, id, x0, x1, y0, y1 and text of inner blocks whose type ends so (caption, body, footnote)."""
    each = blocks.filter("blocks IS NOT NULL").select("doc_id", "page", "block", F.posexplode("blocks").alias("inner", "i")).filter(F.col("i.type").endswith(ending))
    return each.select("doc_id", "page", (F.col("block") * 1000 + F.col("inner")).alias("id"), "block", *(F.col("i.bbox")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))), text_of(F.col("i.lines"), F.col("i.type")).alias("text"), F.filter(F.flatten(F.transform("i.lines", lambda line: line["spans"])), lambda s: s["image_path"].isNotNull())[0]["image_path"].alias("asset"))


def captioned_figures(blocks: DataFrame) -> DataFrame:
    """For each figure caption the figure box it overlaps most across, if by half its width; else null."""
    captions, figures = inner_boxes(blocks, "image_caption"), inner_boxes(blocks, "image_body")
    keyed = lambda d: d.withColumn("_page", F.concat_ws(":", "doc_id", F.col("page").cast("string")))
    best = best_overlap(keyed(captions), keyed(figures), "_page")
    named = figures.select(F.col("id").alias("right_id"), F.concat_ws(":", "doc_id", F.col("page").cast("string")).alias("_page"), F.col("asset").alias("figure_asset"))
    return keyed(captions).join(best.withColumnRenamed("left_id", "id"), ["_page", "id"], "left").join(named, ["_page", "right_id"], "left").select("doc_id", "page", "id", "text", "right_id", "figure_asset", "overlap")


def figure_sizes(blocks: DataFrame, least: float = 10, cover_least: float = 100, share: float = 0.5, most_cut: float = 0.3) -> DataFrame:
    """asset, width and height of figures, less the tallest caption band that reaches into them."""
    figures = inner_boxes(blocks, "image_body").withColumns({"width": F.col("x1") - F.col("x0"), "height": F.col("y1") - F.col("y0")})
    figures = figures.filter((F.col("width") >= least) & (F.col("height") >= F.when(F.col("page") == 0, cover_least).otherwise(least)))
    c = inner_boxes(blocks, "caption").select("doc_id", "page", *(F.col(n).alias(f"c_{n}") for n in ("x0", "y0", "x1", "y1")))
    across = F.least("x1", "c_x1") - F.greatest("x0", "c_x0")
    into = F.least("y1", "c_y1") - F.greatest("y0", "c_y0")
    met = figures.join(c, ["doc_id", "page"], "left").withColumn("_cut", F.when((across >= share * (F.col("c_x1") - F.col("c_x0"))) & (into > 0) & (into <= most_cut * F.col("height")), into).otherwise(0.0))
    return met.groupBy("doc_id", "page", "id", "asset", "width", "height").agg(F.max("_cut").alias("_cut")).select("doc_id", "asset", "width", (F.col("height") - F.col("_cut")).alias("height"))


def cover_hints(docs: DataFrame) -> DataFrame:
    """doc_id with the first ICS and CCS number in the first page's discarded lines."""
    pages = docs.select("doc_id", F.explode("pdf_info").alias("p")).filter("p.page_idx = 0")
    cut = pages.select("doc_id", F.posexplode("p.discarded_blocks").alias("pos", "b")).select("doc_id", "pos", text_of(F.col("b.lines"), F.col("b.type")).alias("line"))
    ics, ccs = F.regexp_extract("line", r"ICS\s*([0-9]{2}(?:\.[0-9]+)*)", 1), F.regexp_extract("line", r"(?:CCS\s*)?\b([A-Z]\s?[0-9]{2})\b", 1)
    pick = lambda c: F.min_by(F.when(c != "", c), F.when(c != "", F.col("pos")))
    return cut.groupBy("doc_id").agg(pick(ics).alias("ics"), pick(F.when(~F.col("line").contains("ICS"), ccs).otherwise("")).alias("ccs"))


def example_styles(frames: DataFrame) -> DataFrame:
    """Per document whether examples are framed or filled: framed on a tie; frames have doc_id and style."""
    strokes, fills = F.count_if(F.col("style") == "stroke"), F.count_if(F.col("style") == "fill")
    return frames.groupBy("doc_id").agg(F.when(strokes >= fills, "frame").otherwise("fill").alias("example_style"))


# The caption of one of several pictures in a figure, and Han characters.
SUB_CAPTION = "^[A-Za-z][)）]"
HAN = "[一-鿿]"


def _piece(span: Column) -> Column:
    """A span as text: the HTML of a table, the address of a picture, else what it says."""
    picture = F.concat(F.lit("![]("), span["image_path"], F.lit(")"))
    return F.coalesce(span["html"], F.when(F.coalesce(span["content"], span["latex"]).isNull(), picture), _span(span))


def _inner_texts(ending: str) -> Column:
    """Texts of a block's inner blocks whose type ends so, in order; empty ones are left out."""
    own = F.filter("blocks", lambda b: b["type"].endswith(ending))
    texts = F.transform(own, lambda b: F.trim(glued(F.transform(F.flatten(F.transform(b["lines"], lambda line: line["spans"])), _piece))))
    return F.coalesce(F.filter(texts, lambda t: t != ""), F.array().cast("array<string>"))


def object_texts(blocks: DataFrame) -> DataFrame:
    """doc_id, page, block, type, text and warning of tables, figures and equations.

    A table is its caption, its body (HTML or a picture) and its footnotes, a
    blank line between; without a body the caption stays and a mark says so. A
    figure is its pictures, the last with the caption in its alternative text:
    that of a part (a) ...) where several are there, else the first. An equation
    is a formula block, with its picture named where the formula holds Han
    characters, or the picture alone. What has nothing to show has an empty text
    and a warning.
    """
    caption, body, notes = _inner_texts("_caption"), _inner_texts("_body"), _inner_texts("_footnote")
    last = lambda texts: F.try_element_at(texts, F.lit(-1))
    lost = F.concat(F.lit("> ["), last(caption), F.lit("（表格结构未识别，原始抽取未提供表格正文）]"))
    table = F.concat(F.filter(F.array(last(caption), F.coalesce(last(body), lost)), lambda t: t.isNotNull()), notes)

    chosen = F.coalesce(F.try_element_at(F.filter(caption, lambda t: t.rlike(SUB_CAPTION)), F.lit(1)), F.try_element_at(caption, F.lit(1)))
    named = F.when(chosen.isNotNull(), F.concat(F.lit("!["), chosen, F.lit("]("), F.regexp_extract(last(body), r"^!\[.*?\]\((.*)\)$", 1), F.lit(")"))).otherwise(last(body))
    is_picture = last(body).rlike(r"^!\[.*?\]\(.*\)$")
    pictures = F.when(is_picture, F.concat(F.slice(body, F.lit(1), F.greatest(F.size(body) - 1, F.lit(0))), F.array(named))).otherwise(F.concat(body, caption))
    figure = F.when(F.size(body) > 0, F.concat(pictures, notes)).otherwise(F.concat(caption, notes))

    spans = F.flatten(F.transform("lines", lambda line: line["spans"]))
    latex = last(F.filter(F.transform(spans, lambda s: F.coalesce(s["content"], s["latex"])), lambda t: F.coalesce(t, F.lit("")) != ""))
    asset = last(F.filter(F.transform(spans, lambda s: s["image_path"]), lambda t: F.coalesce(t, F.lit("")) != ""))
    formula = F.concat(F.lit("$$\n"), latex, F.lit("\n$$"))
    drawn = F.concat(F.lit('<!-- ssir:formula asset-ref="'), asset, F.lit('" -->\n\n'), formula)
    equation = F.coalesce(F.when(latex.rlike(HAN), drawn), formula, F.concat(F.lit("![]("), asset, F.lit(")")), F.lit(""))

    kind = F.col("type")
    text = F.when(kind == "table", F.array_join(table, "\n\n")).when(kind.isin("image", "chart"), F.array_join(figure, "\n\n")).otherwise(equation)
    warning = (
        F.when((kind == "table") & (F.size(body) == 0), F.when(F.size(caption) > 0, "table without body").otherwise("table without caption and body"))
        .when(kind.isin("image", "chart") & (F.size(body) == 0), "figure without picture")
        .when(kind.isin("image", "chart") & ~is_picture & (F.size(caption) > 0), "figure that is no picture")
        .when((kind == "interline_equation") & (equation == ""), "equation without formula and picture")
    )
    own = blocks.filter(kind.isin("table", "image", "chart", "interline_equation"))
    return own.select("doc_id", "page", "block", "type", text.alias("text"), warning.alias("warning"))
