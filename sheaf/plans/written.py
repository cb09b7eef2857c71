"""Queries that read layouts, files and structured documents and write Markdown, HTML and JSON, on documents of several shapes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions import text
from sheaf.operators import catalog, content, graph, markdown, repair
from sheaf.plans.shapes import BLOCK, block, cases, heading
from sheaf.sources import layout, sinks, structured
from sheaf.sources import markdown as source

LONG = "长" * 2000

# ---- what is written

cases("canonical_texts", BLOCK, "text string", [
    ([heading(1, None, "a{k}"), block("paragraph", "b"), block("list", "— c\n— d")], [("# a{k}\n\nb\n\n— c\n— d",)]),
    ([block("paragraph", LONG)], [(LONG,)]),
], markdown.canonical)

cases("plain_texts", BLOCK, "markdown string", [
    ([block("directive", "<!-- ssir:x -->"), heading(1, "4", "a{k}"), heading(6, None, "b"), block("paragraph", "c<!-- d\ne -->f")], [("## 4 a{k}\n\n###### b\n\ncf",)]),
], sinks.plain_markdown)

cases("html_texts", BLOCK, "html string", [
    ([heading(1, None, "a<{k}>"), block("paragraph", 'b & "c"'), block("list", "x\ny"), block("note", "> n"), block("code", "z<"), block("page", "p")],
     [("<h2>a&lt;{k}&gt;</h2>\n<p>b &amp; &quot;c&quot;</p>\n<ul><li>x</li><li>y</li></ul>\n<blockquote>n</blockquote>\n<pre>z&lt;</pre>",)]),
], sinks.html)

cases("rendered_tables", "t int, row int, col int, rowspan int, colspan int, is_header boolean, cell string", "t int, html string", [
    ([(1, 0, 0, 1, 2, True, "h{k}"), (1, 1, 1, 1, 1, False, "b"), (1, 1, 0, 2, 1, False, "a<"), (2, 0, 0, 1, 1, False, "")],
     [(1, '<table><tr><th colspan="2">h{k}</th></tr><tr><td rowspan="2">a&lt;</td><td>b</td></tr></table>'), (2, "<table><tr><td></td></tr></table>")]),
], lambda d: sinks.table_html(d, ["doc_id", "t"]))

cases("sorted_json_rows", "b string, a int", "json string", [
    ([("x{k}", 1)], [('{"a":1,"b":"x{k}","doc_id":{k}}',)]),
    ([(None, None)], [('{"a":null,"b":null,"doc_id":{k}}',)]),
], lambda d: sinks.sorted_json(d.drop("pos")).withColumn("doc_id", F.get_json_object("json", "$.doc_id").cast("long")))

cases("run_statuses", "side string, sha256 string, fatal boolean", "sha256 string, n_issues long, status string", [
    ([("file", "s{k}", False), ("issue", None, None), ("issue", None, None)], [("s{k}", 2, "partial")]),
    ([("file", "s", True), ("issue", None, None)], [("s", 1, "failed")]),
    ([("file", None, False)], [(None, 0, "complete")]),
], lambda d: structured.runs(d.filter("side = 'file'"), d.filter("side = 'issue'")))

cases("volume_differences", "rendition string, pages int, bytes int, chars int", "left_pages int, right_chars int, delta_pages int, delta_bytes int", [
    ([("left", 3, 10, 5), ("right", 5, 7, 6)], [(3, 6, 2, -3)]),
    ([("right", 1, 1, 1)], [(None, 1, None, None)]),
], lambda d: sinks.volumes(d, "left", "right"))

cases("graph_schema_faults", "side string, id string, kind string, target string", "fault string, subject string", [
    ([("node", "{k}:a", "clause", None), ("node", "{k}:a", "clause", None), ("node", "{k}:b", "odd", None), ("edge", "{k}:a", "HAS", "{k}:b"), ("edge", "{k}:b", "ODD", "{k}:z")],
     [("unknown kind", "{k}:b"), ("unknown type", "{k}:b"), ("repeated id", "{k}:a"), ("missing target", "{k}:z")]),
    ([("node", "{k}:c", "clause", None)], []),
], lambda d: graph.faults(d.filter("side = 'node'").select("id", "kind"), d.filter("side = 'edge'").select(F.col("id").alias("source"), F.col("kind").alias("type"), "target"), ["clause"], ["HAS"]).withColumn("doc_id", F.split("subject", ":")[0].cast("long")))

# ---- blocks of the format

cases("format_blocks", "text string", "pos int, kind string, start_line int, end_line int, level int, number string, title string", [
    ([("# 风机{k}\n\n## 1 范围\n正文\n续行\n\n$$\na\n$$\n![a](b.png)\n> 注1：x\n> y\n\n> 示例：z\n\n```\n# no\n```\n|a|b|\n|---|---|\n|1|2|\n**表1 甲**\n单位：mm",)],
     [(1, "heading", 0, 0, 1, None, "风机{k}"), (2, "heading", 2, 2, 2, "1", "范围"), (3, "paragraph", 3, 4, None, None, None), (4, "formula", 6, 8, None, None, None), (5, "image", 9, 9, None, None, None), (6, "note", 10, 11, None, None, None), (7, "example", 13, 13, None, None, None), (8, "code", 15, 17, None, None, None), (9, "table", 18, 20, None, None, None), (10, "caption", 21, 21, None, None, None), (11, "unit", 22, 22, None, None, None)]),
    ([("",)], []),
    ([(None,)], []),
    ([("## A.1 试验{k}\r\n## 附录B 乙\n<!-- ssir:box style=\"a\" -->\n—甲\n\n—乙",)],
     [(1, "heading", 0, 0, 2, "A.1", "试验{k}"), (2, "heading", 1, 1, 2, "B", "乙"), (3, "box", 2, 2, None, None, None), (4, "list", 3, 5, None, None, None)]),
], markdown.blocks)

cases("list_items", BLOCK, "pos int, item int, marker string, marker_kind string, text string", [
    ([block("list", "— 甲{k}\n- 乙"), block("list", "a) x\nb） y"), block("list", "10) z"), block("paragraph", "— no")],
     [(0, 0, "—", "symbol", "甲{k}"), (0, 1, "-", "symbol", "乙"), (1, 0, "a）", "letter", "x"), (1, 1, "b）", "letter", "y"), (2, 0, "10）", "digit", "z")]),
], markdown.items)

cases("folded_captions", BLOCK, "pos int, kind string, caption string, unit string", [
    ([block("caption", "**表1 甲{k}**"), block("unit", "单位：mm"), block("table", "|a|"), block("unit", "单位为：kg"), block("paragraph", "x"), block("caption", "**图2 乙**"), block("image", "![](a)")],
     [(2, "table", "表1 甲{k}", "mm"), (3, "unit", None, None), (4, "paragraph", None, None), (6, "image", "图2 乙", None)]),
], markdown.folded_units)

# ---- texts

cases("emphasized_texts", "text string", "text string", [
    ([("*a{k}* **b** ***c***",)], [("<em>a{k}</em> <strong>b</strong> <strong><em>c</em></strong>",)]),
    ([("2 * 3 * 4 *open",)], [("2 * 3 * 4 *open",)]),
    ([(None,)], [(None,)]),
], lambda d: d.withColumn("text", text.emphasis("text")))

cases("cover_banners", "number string", "number string, banner string", [
    ([("GB/T {k}",), ("DB11/1",), ("Q/AB 1",)], [("GB/T {k}", "中华人民共和国国家标准"), ("DB11/1", "地方标准"), ("Q/AB 1", "企业标准")]),
    ([("ISO 1",), ("",), (None,)], [("ISO 1", None), ("", None), (None, None)]),
], lambda d: d.withColumn("banner", text.banner(F.col("number"))))


def _emblems(rows: DataFrame) -> DataFrame:
    """Numbers of each document beside the prefixes that have an emblem."""
    known = rows.sparkSession.createDataFrame([("GB", "g"), ("GB/Z", "z")], "prefix string, emblem string")
    return text.emblems(rows.select("doc_id", F.col("number").alias("standard_number")), known)


cases("cover_emblems", "number string", "standard_number string, emblem string", [
    ([("GB/T {k}",)], [("GB/T {k}", "g")]),
    ([("GB/Z 1",)], [("GB/Z 1", "z")]),
    ([("ISO",)], [("ISO", None)]),
    ([(None,)], [(None, None)]),
], _emblems)

cases("unglued_titles", "title string", "title string", [
    ([("generalrules for {k} x",)], [("general rules for {k} x",)]),
    ([("electricalmachines, rotatingelectricalmachines",)], [("electrical machines, rotatingelectricalmachines",)]),
    ([("unknownword",)], [("unknownword",)]),
    ([(None,)], [(None,)]),
], lambda d: text.unglued(d, "title", ["general", "rules", "rotating", "electrical", "machines"]))

cases("cover_metadata", "text string", "number string, title string, published string, effective string, replaces string", [
    ([("GB/T 1.{k}—2020\n# 标准{k}\n代替 GB/T 1—2009\n2020-03-31 发布\n2020-10-01 实施\n## 1 范围\n2000-01-01 发布",)], [("GB/T 1.{k}—2020", "标准{k}", "2020-03-31", "2020-10-01", "GB/T 1—2009")]),
    ([("## x",)], [(None, None, None, None, None)]),
], lambda d: d.select("doc_id", text.cover_facts(F.col("text")).alias("c")).select("doc_id", "c.*"))

cases("damaged_layers", "line string", "n_orphans long, n_truncated long, damaged boolean", [
    ([("4.",), ("",), ("足够长的一行文字用来计数，共十五字以上",), ("5.2.试",), ("6.1.验",), ("7. 法",)], [(1, 3, True)]),
    ([("4.",), ("短",)], [(0, 0, False)]),
    ([(None,)], [(0, 0, False)]),
], repair.damaged_text_layers)

cases("decoded_files", "hex string", "text string, fatal boolean, n_issues int", [
    ([("EFBBBF610D0A62",)], [("a\nb", False, 2)]),
    ([("FF61",)], [(None, True, 1)]),
    ([("E4B8AD",)], [("中", False, 0)]),
    ([("",)], [("", False, 0)]),
], lambda d: source.decoded(d.select("doc_id", F.unhex("hex").alias("content"))).withColumn("n_issues", F.size("issues")))

cases("completed_metadata", "title string, body string", "title string, language string, n_filled int", [
    ([(None, "# 风机 {k}\nx")], [("风机 {k}", "zh-CN", 5)]),
    ([("T{k}", "plain")], [("T{k}", "und", 4)]),
    ([(" ", "no heading")], [(" ", "und", 4)]),
], lambda d: source.completed(d.select("doc_id", "body", F.when(F.col("title").isNotNull(), F.create_map(F.lit("title"), "title")).otherwise(F.create_map().cast("map<string,string>")).alias("meta"))).select("doc_id", F.col("meta")["title"].alias("title"), F.col("meta")["language"].alias("language"), F.size("filled").alias("n_filled")))

cases("image_addresses", "text string", "position int, alt string, url string, remote boolean", [
    ([("![a{k}](b.png) x ![](https://c/d.png)",)], [(0, "a{k}", "b.png", False), (1, "", "https://c/d.png", True)]),
    ([("none",)], []),
    ([(None,)], []),
], source.images)

# ---- layouts


def page(blocks: list[dict], number: int = 0, discarded: list[dict] | None = None) -> dict:
    return {"page_idx": number, "para_blocks": blocks, "discarded_blocks": discarded or []}


def said(kind: str, *lines: str, box: tuple = (0, 0, 1, 1), **more) -> dict:
    return {"type": kind, "bbox": list(box), "lines": [{"bbox": list(box), "spans": [{"type": "text", "content": t}]} for t in lines], **more}


def outer(kind: str, *inner: dict) -> dict:
    return {"type": kind, "bbox": [0, 0, 1, 1], "blocks": list(inner)}


def picture(asset: str, box: tuple) -> dict:
    return {"type": "image_body", "bbox": list(box), "lines": [{"bbox": list(box), "spans": [{"type": "image", "image_path": asset}]}]}


def pages(*all_: dict) -> str:
    return json.dumps({"pdf_info": list(all_)}, ensure_ascii=False)


def laid(run):
    """A plan on layout JSON given as text."""
    return lambda d: run(d.select("doc_id", F.from_json("text", layout.SCHEMA).alias("j")).select("doc_id", "j.pdf_info"))


cases("page_paragraphs", "text string", "page int, block int, type string, text string", [
    ([(pages(page([said("title", "标题"), said("text", "GB", "1{k}"), said("ref_text", "[1] a", "[2] b")]), page([said("text", "续", merge_prev=True), said("text", "新")], 1)),)],
     [(0, 0, "title", "## 标题"), (0, 1, "text", "GB 1{k}"), (0, 2, "ref_text", "[1] a\n[2] b续"), (1, 1, "text", "新")]),
    ([(pages(page([])),)], []),
    ([(None,)], []),
], laid(lambda d: layout.paragraphs(layout.page_blocks(d))))

def shown(kind: str, **span) -> dict:
    return {"type": kind, "bbox": [0, 0, 1, 1], "lines": [{"bbox": [0, 0, 1, 1], "spans": [span]}]}


GRID = "<table><tr><td>1</td></tr></table>"

cases("layout_objects", "text string", "block int, type string, text string, warning string", [
    ([(pages(page([outer("table", said("table_caption", "表1"), shown("table_body", type="table", html=GRID), said("table_footnote", "a 注{k}"), said("table_footnote", " ")), outer("table", said("table_caption", "表2"), said("table_footnote", "b")), outer("table", said("table_footnote", "c")), said("text", "no")])),)],
     [(0, "table", "表1\n\n" + GRID + "\n\na 注{k}", None), (1, "table", "表2\n\n> [表2（表格结构未识别，原始抽取未提供表格正文）]\n\nb", "table without body"), (2, "table", "c", "table without caption and body")]),
    ([(pages(page([outer("image", picture("a.png", (0, 0, 1, 1)), picture("b{k}.png", (0, 0, 1, 1)), said("image_caption", "图1 甲"), said("image_caption", "a) 乙"), said("image_footnote", "注")), outer("chart", shown("chart_body", type="image", image_path="c.png")), outer("image", said("image_caption", "图3")), outer("image", said("image_body", "text"), said("image_caption", "图4"))])),)],
     [(0, "image", "![](a.png)\n\n![a) 乙](b{k}.png)\n\n注", None), (1, "chart", "![](c.png)", None), (2, "image", "图3", "figure without picture"), (3, "image", "text\n\n图4", "figure that is no picture")]),
    ([(pages(page([shown("interline_equation", type="interline_equation", latex="a+{k}", image_path="e.png"), shown("interline_equation", type="interline_equation", latex="差错率", image_path="e.png"), shown("interline_equation", type="interline_equation", image_path="e.png"), shown("interline_equation", type="interline_equation")])),)],
     [(0, "interline_equation", "$$\na+{k}\n$$", None), (1, "interline_equation", '<!-- ssir:formula asset-ref="e.png" -->\n\n$$\n差错率\n$$', None), (2, "interline_equation", "![](e.png)", None), (3, "interline_equation", "", "equation without formula and picture")]),
    ([(pages(page([])),)], []),
], laid(lambda d: layout.object_texts(layout.page_blocks(d))))

FIGURES = pages(page([outer("image", picture("a{k}.png", (0, 0, 100, 200)), said("image_caption", "图1", box=(10, 190, 90, 210)))]), page([outer("image", picture("b.png", (0, 0, 100, 100)))], 1))

cases("figure_captions", "text string", "page int, text string, figure_asset string, overlap double", [
    ([(FIGURES,)], [(0, "图1", "a{k}.png", 80.0)]),
    ([(pages(page([outer("image", picture("a.png", (0, 0, 10, 10)), said("image_caption", "远{k}", box=(50, 0, 90, 10)))])),)], [(0, "远{k}", None, None)]),
], laid(lambda d: layout.captioned_figures(layout.page_blocks(d))))

cases("figure_heights", "text string", "asset string, width double, height double", [
    ([(FIGURES,)], [("a{k}.png", 100.0, 190.0), ("b.png", 100.0, 100.0)]),
    ([(pages(page([outer("image", picture("small.png", (0, 0, 9, 9)))], 1)),)], []),
], laid(lambda d: layout.figure_sizes(layout.page_blocks(d))))

cases("cover_numbers", "text string", "ics string, ccs string", [
    ([(pages(page([], 0, [said("header", "ICS 23.120"), said("header", "CCS J 72"), said("header", "K 10")])),)], [("23.120", "J 72")]),
    ([(pages(page([], 0, [said("header", "none{k}")])),)], [(None, None)]),
], laid(layout.cover_hints))

cases("boxes_side_by_side", "page int, id int, x0 double, y0 double, y1 double", "page int, id int, band long, place long, n_columns long", [
    ([(1, 1, 0.0, 0.0, 10.0), (1, 2, 100.0, 5.0, 12.0), (1, 3, 0.0, 20.0, 30.0), (2, 4, 0.0, 0.0, 5.0), (2, 5, 5.0, 1.0, 5.0)], [(1, 1, 1, 1, 2), (1, 2, 1, 2, 2)]),
], lambda d: content.side_by_side(d).withColumnRenamed("column", "place"))

# ---- structured documents


def tree_of(*children: dict) -> str:
    return json.dumps({"id": "r", "children": list(children)}, ensure_ascii=False)


ITEM = {"id": "c", "nodeType": "clause", "number": "1.1", "contentElements": [{"id": "e1", "presentationType": "paragraph", "sortOrder": 1, "textContent": "甲{k}"}, {"id": "e2", "presentationType": "note"}]}

cases("structured_nodes", "text string", "node_id string, parent_id string, depth int, node_type string, number string", [
    ([(tree_of({"id": "a", "nodeType": "section", "number": "1", "children": [ITEM]}, {"id": "b{k}", "nodeType": "annex"}),)],
     [("a", "r", 1, "section", "1"), ("c", "a", 2, "clause", "1.1"), ("b{k}", "r", 1, "annex", None)]),
    ([(tree_of(),)], []),
], lambda d: structured.structure(d.select("doc_id", F.from_json("text", structured.node_type()).alias("root"))))

cases("structured_contents", "text string", "parent_id string, content_id string, presentation string, sort_order int, text string", [
    ([(tree_of({"id": "a", "children": [ITEM]}),)], [("c", "e1", "paragraph", 1, "甲{k}"), ("c", "e2", "note", None, None)]),
    ([(tree_of(),)], []),
], lambda d: structured.contents(structured.structure(d.select("doc_id", F.from_json("text", structured.node_type()).alias("root")))))

# ---- the catalogue

cases("organisation_roles", BLOCK, "proposing string, secretariat string, units string", [
    ([block("paragraph", "本文件由甲部提出。"), block("paragraph", "本文件由乙会{k}归口。"), block("paragraph", "起草单位：丙厂、丁所。"), block("list", "本文件由戊提出")], [("甲部", "乙会{k}", "丙厂|丁所")]),
    ([block("paragraph", "x")], []),
], lambda d: catalog.organisations(d).withColumn("units", F.array_join("units", "|")))

cases("contents_entries", "kind string, node_type string, number string, title string", "pos int, number string, title string, next_title string", [
    ([("heading", "section", "1", "范围{k}"), ("heading", "clause", "1.1", "a"), ("heading", "subClause", "1.1.1", "b"), ("heading", "annex", "A", "c"), ("paragraph", None, None, None), ("heading", "documentBlock", None, "索引"), ("heading", "documentBlock", None, "d")],
     [(0, "1", "范围{k}", "a"), (1, "1.1", "a", "c"), (3, "A", "c", "索引"), (5, None, "索引", None)]),
], catalog.contents)


def _sizes(rows: DataFrame) -> DataFrame:
    """Assets and boxes of each document apart."""
    own = rows.filter("side = 'asset'").select("doc_id", F.col("id").alias("asset"), "width", "height")
    return content.source_sizes(own, rows.filter("side = 'box'").select("doc_id", F.col("id").alias("box"), "width", "height"))


cases("figure_source_sizes", "side string, id string, width double, height double", "asset string, box string, width double, height double", [
    ([("asset", "a{k}", 200.0, 100.0), ("asset", "b", 300.0, 30.0), ("box", "x", 100.0, 50.0)], [("a{k}", "x", 100.0, 50.0), ("b", None, 150.0, 15.0)]),
    ([("asset", "a", 400.0, 200.0)], [("a", None, 144.0, 72.0)]),
], _sizes)
