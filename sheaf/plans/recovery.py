"""Queries that recover lists, ellipses, paragraphs and places, and validate documents, on documents of several shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators import alignment, annexes, declarations, footnotes, lines, markdown, patterns, prose, repair, spans, tree, validation
from sheaf.plans.shapes import cases

LONG = "长" * 3000

# ---- lists that a colon leads in

LIST = "pos int, item int, kind string, marker string, text string, issue string"
FOUND = "CSM-OCR-016"

cases("colon_led_lists", "kind string, text string", LIST, [
    # dashes lost on plain paragraphs; the list is one block again
    ([("paragraph", "下列内容{k}："), ("paragraph", "甲；"), ("list", "— 乙；\n— 丙；"), ("paragraph", "丁。")],
     [(0, 0, "paragraph", None, "下列内容{k}：", None), (1, 0, "list", "—", "甲；", FOUND), (1, 1, "list", "—", "乙；", FOUND), (1, 2, "list", "—", "丙；", FOUND), (1, 3, "list", "—", "丁。", FOUND)]),
    # first item glued to the intro, letters counted anew, a semicolon read as a colon
    ([("paragraph", "内容：分类{k}；"), ("list", "b) 乙；"), ("paragraph", "丙："), ("paragraph", "丁；"), ("list", "d) 戊。")],
     [(0, 0, "paragraph", None, "内容：", None), (1, 0, "list", "a)", "分类{k}；", FOUND), (1, 1, "list", "b)", "乙；", FOUND), (1, 2, "list", "c)", "丙；", FOUND), (1, 3, "list", "d)", "丁；", FOUND), (1, 4, "list", "e)", "戊。", FOUND)]),
    # markers of two families: nothing is guessed
    ([("paragraph", "内容："), ("list", "— 乙；"), ("list", "a) 丙；"), ("paragraph", "丁。")],
     [(0, 0, "paragraph", None, "内容：", None), (1, 0, "list", "—", "乙；", None), (2, 0, "list", "a)", "丙；", None), (3, 0, "paragraph", None, "丁。", None)]),
    # a 。 amid the group, and the odd dash follows the others
    ([("paragraph", "内容："), ("list", "— 乙；\n- 丙。"), ("paragraph", "甲{k}；"), ("list", "— 丁。"), ("paragraph", "戊。")],
     [(0, 0, "paragraph", None, "内容：", None), (1, 0, "list", "—", "乙；", FOUND), (1, 1, "list", "—", "丙。", FOUND), (1, 2, "list", "—", "甲{k}；", FOUND), (1, 3, "list", "—", "丁。", FOUND), (4, 0, "paragraph", None, "戊。", None)]),
    # no marker left, a clause in between, no 。 at the end
    ([("paragraph", "内容："), ("paragraph", "甲；"), ("paragraph", "乙。"), ("paragraph", "另有："), ("list", "— 丙；"), ("paragraph", "4.1 丁；"), ("paragraph", None)],
     [(0, 0, "paragraph", None, "内容：", None), (1, 0, "paragraph", None, "甲；", None), (2, 0, "paragraph", None, "乙。", None), (3, 0, "paragraph", None, "另有：", None), (4, 0, "list", "—", "丙；", None), (5, 0, "paragraph", None, "4.1 丁；", None), (6, 0, "paragraph", None, None, None)]),
    # the same group twice, numbers with wide brackets, a very long item
    ([("paragraph", "内容："), ("list", "2）甲；"), ("paragraph", LONG + "。"), ("paragraph", "内容："), ("list", "2）甲；"), ("paragraph", LONG + "。")],
     [(p + 3 * g, i, k, m, t, f) for g in (0, 1) for p, i, k, m, t, f in ((0, 0, "paragraph", None, "内容：", None), (1, 0, "list", "1）", "甲；", FOUND), (1, 1, "list", "2）", LONG + "。", FOUND))]),
], patterns.colon_lists)

# ---- ellipses that only the text layer has

SIDES = "side string, page int, x0 double, y0 double, text string"


def line(text: str | None) -> tuple:
    return "line", None, None, None, text


def layer(y0: float, text: str | None, page: int = 1, x0: float = 10.0) -> tuple:
    return "layer", page, x0, float(y0), text


def _restored(rows: DataFrame) -> DataFrame:
    """Lines and text layer of each document apart, the latter in its order."""
    own = rows.filter("side = 'line'").select("doc_id", "pos", F.col("text").alias("line"))
    seen = rows.filter("side = 'layer'").select("doc_id", "page", F.col("pos").alias("line_no"), "x0", "y0", "text")
    return alignment.restored_ellipses(own, seen)


cases("restored_ellipses", SIDES, "pos int, line string, restored boolean", [
    # before the next numbered line, not where one is near, and at the end
    ([line("# 5 a{k}"), line("5.1 x"), line("t"), line("5.2 y"), line("……"), line("5.3 z"), line("6 end"), layer(10, "5.1 x"), layer(20, "……"), layer(30, "５．２ y"), layer(40, "……"), layer(50, "5.3 z"), layer(60, "6 end"), layer(70, "…")],
     [(0, "# 5 a{k}", False), (1, "5.1 x", False), (2, "t", False), (3, "……", True), (4, "5.2 y", False), (5, "……", False), (6, "5.3 z", False), (7, "6 end", False), (8, "……", True)]),
    # a number that comes twice: the later line; then only forward
    ([line("1 a"), line("2 b{k}"), line("1 a"), line("3 c"), layer(10, "…"), layer(20, "1 a"), layer(30, "…"), layer(40, "2 b"), layer(50, "…"), layer(60, "3 c"), layer(70, "z")],
     [(0, "1 a", False), (1, "2 b{k}", False), (2, "……", True), (3, "1 a", False), (4, "……", True), (5, "3 c", False)]),
    # a cell of a table; the next number stands on another page
    ([line("1 a{k}"), line("2 b"), layer(10, "…"), layer(12, "u", x0=90.0), layer(14, "v", x0=190.0), layer(60, "1 a"), layer(200, "…"), layer(10, "2 b", page=2)],
     [(0, "1 a{k}", False), (1, "2 b", False)]),
    # nothing in the layer, null lines
    ([line(None), line("{k}"), layer(10, None)], [(0, None, False), (1, "{k}", False)]),
    # before the mark that ends the pages
    ([line("1 a"), line("<!-- /ssir:mineru-pages -->"), layer(10, "1 a"), layer(20, "⋯⋯")],
     [(0, "1 a", False), (1, "……", True), (2, "<!-- /ssir:mineru-pages -->", False)]),
], _restored)

# ---- paragraphs

cases("assembled_paragraphs", "text string", "start_line int, end_line int, part int, kind string, level int, text string", [
    ([("甲{k}，  \n\n乙丙，\n丁。",)], [(0, 3, 0, "paragraph", None, "甲{k}，乙丙，\n丁。")]),
    ([("甲，\n\n示例：乙\n\n甲，\n\nNo {k}",)], [(0, 0, 0, "paragraph", None, "甲，"), (2, 2, 0, "paragraph", None, "示例：乙"), (4, 4, 0, "paragraph", None, "甲，"), (6, 6, 0, "paragraph", None, "No {k}")]),
    ([("注1：x。注2：{k}。\n\n概要。6.3.5.2为了；7.1另。8 x",)], [(0, 0, 0, "note", None, "注1：x。"), (0, 0, 1, "note", None, "注2：{k}。"), (2, 2, 0, "paragraph", None, "概要。"), (2, 2, 1, "paragraph", None, "6.3.5.2为了；"), (2, 2, 2, "paragraph", None, "7.1另。8 x")]),
    ([("# 1 h\n一；\n二$；\n三 $。$\n注：四。\n\n示例 2：\n",)], [(1, 4, 0, "paragraph", None, "一；"), (1, 4, 1, "paragraph", None, "二$；"), (1, 4, 2, "paragraph", None, "三 $。"), (1, 4, 3, "note", None, "注：四。"), (6, 6, 0, "heading", 2, "示例 2：")]),
    ([(None,)], []),
    ([("甲、\n<!-- ssir:mineru-pages 3-4 -->\n乙\n\n" + LONG,)], [(0, 2, 0, "paragraph", None, "甲、\n乙"), (4, 4, 0, "paragraph", None, LONG)]),
], lambda d: prose.assembled(markdown.classified(d)))

# ---- places of cited strings

ASKED = "side string, mention int, owner string, a int, b int, text string"


def whole(text: str | None) -> tuple:
    return "text", None, None, None, None, text


def part(owner: str, start: int, end: int) -> tuple:
    return "part", None, owner, start, end, None


def cited(mention: int, owner: str | None, needle: str | None) -> tuple:
    return "cited", mention, owner, None, None, needle


def _located(rows: DataFrame) -> DataFrame:
    """Mentions, fragments and texts of each document apart."""
    asked = rows.filter("side = 'cited'").select("doc_id", "mention", "owner", F.col("text").alias("needle"))
    own = rows.filter("side = 'part'").select("doc_id", "owner", F.col("a").alias("start_char"), F.col("b").alias("end_char"))
    return spans.located(asked, own, rows.filter("side = 'text'").select("doc_id", "text"))


cases("located_spans", ASKED, "mention long, start_char long, end_char long, status string", [
    # each next one from the last hit on; then the first again; other white space where there is none of the exact form
    ([whole("GB 1, GB 1, GB1.{k}"), part("p", 0, 16), cited(1, "p", "GB 1"), cited(2, "p", "GB 1"), cited(3, "p", "GB 1"), cited(4, "p", "GB 1."), cited(5, "p", "1, G B")],
     [(1, 0, 4, "resolved"), (2, 6, 10, "resolved"), (3, 0, 4, "resolved"), (4, 12, 16, "resolved"), (5, 3, 8, "resolved")]),
    # outside the fragment; nowhere; unknown owners; null and empty strings
    ([whole("甲𠀀乙 GB\n 2"), part("p", 0, 3), cited(1, "p", "GB 2"), cited(2, "p", "none{k}"), cited(3, "q", "none"), cited(4, None, "乙"), cited(5, "p", None), cited(6, "p", "")],
     [(1, 4, 9, "partiallyResolved"), (2, 0, 3, "partiallyResolved"), (3, None, None, "partiallyResolved"), (4, 2, 3, "partiallyResolved"), (5, 0, 3, "partiallyResolved"), (6, 0, 3, "partiallyResolved")]),
    # no text at all; characters that mean something in a pattern
    ([whole(None), part("p", 0, 0), cited(1, "p", "x{k}")], [(1, 0, 0, "partiallyResolved")]),
    ([whole("a.b(c)+ " + LONG + "a+b"), part("p", 0, 3011), cited(2, "p", "(c)+"), cited(1, "p", "a+b")], [(1, 3008, 3011, "resolved"), (2, 3, 7, "resolved")]),
], _located)

# ---- documents against a schema

SCHEMA = {
    "type": "object",
    "required": ["id", "root"],
    "additionalProperties": False,
    "properties": {"id": {"type": "string", "pattern": "^D", "minLength": 2}, "n": {"type": "integer", "minimum": 1}, "root": {"$ref": "#/definitions/node"}},
    "definitions": {"node": {"type": "object", "required": ["kind"], "properties": {"kind": {"enum": ["a", "b", 1]}, "kids": {"type": "array", "minItems": 1, "items": {"$ref": "#/definitions/node"}}}}},
}


def nested(inner: str, depth: int) -> str:
    for _ in range(depth):
        inner = '{"kind":"a","kids":[' + inner + "]}"
    return inner


cases("schema_faults", "json string", "path string, code string, detail string", [
    ([('{"id":"D{k}","n":2.0,"root":{"kind":1,"more":[{}]}}',)], []),
    ([('{"id":7,"n":0,"x":1,"root":{"kind":"c","kids":[{"kids":3},{"kind":"b","kids":[]}]}}',)],
     [("", "extra", "x"), ("id", "type", "string, not integer"), ("n", "small", "0"), ("root/kind", "choice", '"c"'), ("root/kids/0", "missing", "kind"), ("root/kids/0/kids", "type", "array, not integer"), ("root/kids/1/kids", "few", "0")]),
    ([("no json {k}",)], [("", "json", None)]),
    ([(None,)], [("", "json", None)]),
    ([('[1]',)], [("", "type", "object, not array")]),
    ([('{"id":"D","n":1.5,"root":' + nested('{"kind":"z"}', 11) + "}",)], [("id", "short", "D"), ("n", "type", "integer, not number"), ("root/" + "kids/0/" * 11 + "kind", "choice", '"z"')]),
    ([('{"id":"E{k}","root":null}',)], [("id", "pattern", "E{k}"), ("root", "type", "object, not null")]),
], lambda d: validation.schema_faults(d, SCHEMA))

# ---- footnotes of the text layer

SPANS = "side string, page int, x0 double, y0 double, x1 double, size double, text string"


def body(text: str | None) -> tuple:
    return "doc", None, None, None, None, None, text


def height(points: float, page: int = 1) -> tuple:
    return "page", page, None, float(points), None, None, None


def span(x0: float, y0: float, x1: float, size: float, text: str, page: int = 1) -> tuple:
    return "span", page, float(x0), float(y0), float(x1), float(size), text


def _footnotes(rows: DataFrame) -> DataFrame:
    """Texts, spans and pages of each document apart; what comes out goes in again and stays."""
    own = rows.filter("side = 'span'").select("doc_id", "page", "x0", "y0", "x1", "size", "text")
    pages = rows.filter("side = 'page'").select("doc_id", "page", F.col("y0").alias("height"))
    once = footnotes.recovered(rows.filter("side = 'doc'").select("doc_id", "text"), own, pages)
    again = footnotes.recovered(once, own, pages).select("doc_id", F.col("text").alias("again"), F.col("n_recovered").alias("n_again"))
    return once.join(again, "doc_id")


PAGE = [height(800), span(10, 100, 200, 10, "按照下列规定的标准"), span(200, 98, 205, 6, "2"), span(205, 98.5, 208, 6, ")"), span(210, 100, 400, 10, "执行。"), *(span(10, 200 + 20 * i, 400, 10, "正文") for i in range(6))]

cases("recovered_footnotes", SPANS, "text string, n_recovered int, again string, n_again int", [
    # the mark's digit stuck to the text; its definition goes on in a second line
    ([body("按照下列规定的标准2执行。\n\n下一段{k}"), *PAGE, span(10, 700, 50, 8, "2) 现行"), span(50, 701, 90, 8, "版本"), span(10, 712, 90, 8, "有效。"), span(10, 760, 20, 8, "12")],
     [("按照下列规定的标准[foot:1]执行。\n\n\n<!--ssir:foot:1-->现行版本有效。<!--ssir:/foot-->\n\n下一段{k}", 1, "按照下列规定的标准[foot:1]执行。\n\n\n<!--ssir:foot:1-->现行版本有效。<!--ssir:/foot-->\n\n下一段{k}", 0)]),
    # the definition is a line of the text; only the last six characters before the mark are the same
    ([body("另有下列规定的标准2执行。\n  2）旧{k}"), *PAGE, span(10, 700, 50, 8, "2)旧{k}")],
     [("另有下列规定的标准[foot:1]执行。\n  <!--ssir:foot:1-->旧{k}<!--ssir:/foot-->", 1, "另有下列规定的标准[foot:1]执行。\n  <!--ssir:foot:1-->旧{k}<!--ssir:/foot-->", 0)]),
    # no definition: nothing is written; no marks; no text
    ([body("按照下列规定的标准2执行。"), *PAGE], [("按照下列规定的标准2执行。", 0, "按照下列规定的标准2执行。", 0)]),
    ([body("2 {k}"), height(800), span(10, 700, 50, 8, "2) x")], [("2 {k}", 0, "2 {k}", 0)]),
    ([body(None), *PAGE, span(10, 700, 50, 8, "2) x")], [(None, 0, None, 0)]),
], _footnotes)

# ---- annex headings

cases("rebuilt_annex_headings", "line string", "pos int, line string, issue string", [
    # three headings; two; a status without a heading; none of them a heading
    ([("# 附录B",), ("",), ("# (规范性附录)",), ("# 试验{k}",), ("# 附 录 A",), ("## （资料性附录） 质量",), ("x",)], [(0, "## 附录 B（规范性） 试验{k}", "GEN-030"), (4, "## 附录 A（资料性） 质量", "GEN-030"), (6, "x", None)]),
    ([("## 附录C",), ("(规范性)",), ("",), ("## 标题",), ("附录D",), ("(资料性)",), ("外形{k}",), ("",), ("正文",)], [(0, "## 附录 C（规范性） 标题", "GEN-030"), (4, "## 附录 D（资料性） 外形{k}", "GEN-030"), (7, "", None), (8, "正文", None)]),
    ([("# 附录E",), ("(推荐性)",), ("标题",), ("# 附录F",), ("## 名称",)], [(0, "## 附录 E（推荐性） 标题", "GEN-030"), (3, "## 附录 F 名称", "GEN-030")]),
    # a clause follows, another annex follows, nothing follows, a mention in a sentence
    ([("# 附录G",), ("## G.1 总则{k}",), ("# 附录H",), ("# 附录J",), ("见附录A",), (None,), ("附录K",), ("(规范性)",), ("末行",)],
     [(0, "# 附录G", None), (1, "## G.1 总则{k}", None), (2, "# 附录H", None), (3, "# 附录J", None), (4, "见附录A", None), (5, None, None), (6, "附录K", None), (7, "(规范性)", None), (8, "末行", None)]),
], annexes.rebuilt_annex_headings)

# ---- several operators, one after the other


def _chained(rows: DataFrame) -> DataFrame:
    """Split annex headings rebuilt, blocks parsed, numbers restored, levels raised, then the tree."""
    cut = lines.lines(rows.select("doc_id", "text"))
    whole = annexes.rebuilt_annex_headings(cut)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), "\n")
    blocks = markdown.blocks(whole.groupBy("doc_id").agg(text.alias("text")))
    sections = markdown.sections(repair.raised_levels(repair.restored_numbers(blocks)))
    heads = sections.filter("kind = 'heading'")
    return tree.paths(heads.select("doc_id", "pos", "parent_pos", "node_type", "number", "level"), "pos", "parent_pos", ["doc_id"])


cases("chained_structure", "text string", "pos int, parent_pos int, node_type string, number string, level int, depth int", [
    ([("# 标准{k}\n## 1 范围\n正文\n## 11 总则\n## 1.11 细则\n# 附录A\n\n# (规范性)\n# 试验\n## A.1 方法",)],
     [(2, None, "section", "1", 2, 1), (4, 2, "clause", "1.1", 3, 2), (5, 4, "subClause", "1.1.1", 4, 3), (6, None, "annex", "A", 2, 1), (7, 6, "annexSection", "A.1", 2, 2)]),
    ([("no heading {k}",)], []),
    ([(None,)], []),
], _chained)


def _cited_places(rows: DataFrame) -> DataFrame:
    """Paragraphs assembled, laid out in a ledger, and the places of the strings that are asked for in them."""
    parts = prose.assembled(markdown.classified(rows.filter("side = 'text'").select("doc_id", "text")))
    ordered = parts.withColumn("pos", F.struct("start_line", "part"))
    held = lines.ledger(ordered, text="text")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"]), "\n")
    texts = ordered.groupBy("doc_id").agg(whole.alias("text"))
    owner = F.concat_ws(":", F.col("start_line").cast("string"), F.col("part").cast("string"))
    asked = rows.filter("side = 'cited'").select("doc_id", F.col("pos").alias("mention"), "owner", F.col("text").alias("needle"))
    return spans.located(asked, held.select("doc_id", owner.alias("owner"), "start_char", "end_char"), texts)


cases("cited_places", "side string, owner string, text string", "mention long, start_char long, end_char long, status string", [
    ([("text", None, "见 GB/T 1，\n\n和 GB/T 1。注1：GB/T 1"), ("cited", "0:0", "GB/T 1"), ("cited", "0:0", "GB/T1"), ("cited", "0:0", "GB/T 1"), ("cited", "0:1", "GB/T 1"), ("cited", "9:9", "注1")],
     [(1, 2, 8, "resolved"), (2, 0, 18, "partiallyResolved"), (3, 11, 17, "resolved"), (4, 22, 28, "resolved"), (5, 19, 21, "partiallyResolved")]),
], _cited_places)

# ---- bodies of declarations

cases("declared_items", "line string", "name string, start_line int, end_line int, item int, label string, text string", [
    # items with blank lines between, up to the first line of another form
    ([("<!-- ssir:figure-legend -->",), ("",), ("1——轴{k}；",), ("",), ("b — 壳。",), ("正文",), ("2——不属于",)], [("figure-legend", 0, 4, 0, "1", "轴{k}"), ("figure-legend", 0, 4, 1, "b", "壳")]),
    # closed: all lines stay, also those of another form; then one without items
    ([("<!-- ssir:figure-sub -->",), ("a) 正面{k}",), ("其他",), ("| x |",), ("<!-- ssir:/figure-sub -->",), ("<!-- ssir:figure-sub -->",), ("# 1",)],
     [("figure-sub", 0, 4, 0, "a", "正面{k}"), ("figure-sub", 0, 4, 1, None, "其他"), ("figure-sub", 0, 4, 2, None, "| x |"), ("figure-sub", 5, 5, None, None, None)]),
    # a heading before the closing directive: the items alone; a directive ends them too
    ([("<!-- ssir:figure-legend -->",), ("1-a",), ("# h",), ("<!-- ssir:/figure-legend -->",), ("<!-- ssir:figure-legend -->",), ("2-b",), ("<!-- ssir:table -->",), ("3-c",), (None,)],
     [("figure-legend", 0, 1, 0, "1", "a"), ("figure-legend", 4, 5, 0, "2", "b")]),
    ([(None,), ("x{k}",)], []),
], declarations.declared)
