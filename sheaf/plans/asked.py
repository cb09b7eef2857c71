"""Queries that call operators on rows they can fail on: audits, references, structure, content and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators import catalog, content, joins, lines, references, repair, rulepacks, rules, structure, tree
from sheaf.plans.shapes import BLOCK, FINDING, block, cases, heading
from sheaf.sources import html, layout

# ---- audits by rule packs: all operators, in two layers

PACKS = [
    """
id: base
version: "1"
execution-policy: {default-severity: warning}
rules:
  - {id: R01, check: {operator: non_empty}, target: {path: $.metadata.common.title}, severity: must}
  - {id: R02, check: {operator: equals, expected: standard}, target: {path: $.documentType}}
  - {id: R03, check: {operator: contains_node_title, expected: 范围}, requirement: {applicability: document.documentType == standard}}
  - {id: R04, check: {operator: first_numbered_node_equals, expected: "1"}}
  - {id: R05, check: {operator: sibling_numbers_contiguous}, requirement: {applicability: has_numbered_sections}}
  - {id: R06, check: {operator: clause_parent_exists}, requirement: {applicability: has_numbered_clauses}}
  - {id: R07, check: {operator: annex_kind_declared}, requirement: {applicability: has_annexes}}
  - {id: R08, check: {operator: internal_clause_references_resolve}, requirement: {applicability: has_internal_references}}
  - {id: R09, check: {operator: table_references_resolve}, requirement: {applicability: has_table_references}}
  - {id: R10, check: {operator: figure_references_resolve}, requirement: {applicability: has_figure_references}}
  - {id: R11, check: {operator: each_has_source_anchor}}
  - {id: R12, check: {operator: test_method_numbering_mirrors_requirements, expected: ["5", "6"]}}
  - {id: R13, check: {operator: numeric_requirements_carry_units}}
  - {id: R14, check: {operator: quantitative_requirements_have_test_methods}}
  - {id: R15, check: {operator: contains_node_title_any, expected: [试验, 检验]}}
  - {id: R16, check: {operator: unheard_of}}
  - {check: {operator: equals}}
""",
    """
id: profile
rules:
  - {id: R16, check: {operator: classification_marking_rules_present, expected: [标记]}, severity: must}
  - {id: R17, check: {operator: unheard_of}}
  - {id: R18, check: {operator: equals, expected: x}, target: {path: $.a}, requirement: {applicability: has_wings}}
""",
    "- no: pack",
]
AUDITED = "side string, p int, up int, kind string, number string, title string, a int"


def _tables(rows: DataFrame) -> dict[str, DataFrame]:
    def side(name: str) -> DataFrame:
        return rows.filter(F.col("side") == name)

    meta = F.map_from_arrays(F.array(F.lit("title"), F.lit("document-type")), F.array("title", "kind"))
    return {
        "documents": side("doc").select("doc_id", meta.alias("meta")),
        "nodes": side("node").select("doc_id", F.col("p").alias("pos"), F.col("up").alias("parent_pos"), F.col("kind").alias("node_type"), "number", "title", F.col("a").alias("start_line"), F.col("a").alias("end_line")),
        "mentions": side("mention").select("doc_id", F.col("kind").alias("target_type"), "number"),
        "tables": side("table").select("doc_id", "number"),
        "figures": side("figure").select("doc_id", "number"),
        "blocks": side("block").select("doc_id", "pos", "kind", F.col("title").alias("text")),
    }


def _audit(rows: DataFrame) -> DataFrame:
    """All operators of declared checks, from two packs of which the second overrides the first."""
    packs = rulepacks.parsed(rows.sparkSession.createDataFrame([(p,) for p in PACKS], "text string"))
    return rulepacks.audit(_tables(rows), rulepacks.layered(packs, ["base", "profile"])).withColumnRenamed("check_id", "rule_id")


def doc(title: str | None, kind: str | None) -> tuple:
    return "doc", None, None, kind, None, title, None


def node(p: int, up: int | None, kind: str, number: str | None, title: str | None, a: int | None = 1) -> tuple:
    return "node", p, up, kind, number, title, a


def states(text: str) -> list[tuple]:
    names = {"p": "pass", "f": "fail", "w": "warning", "n": "not-applicable", "u": "unresolved"}
    return [(f"R{i + 1:02}", names[c]) for i, c in enumerate(text)]


cases("audit_packs", AUDITED, "rule_id string, state string", [
    ([doc("T{k}", "standard"), node(1, None, "section", "1", "范围"), node(2, None, "section", "5", "要求"), node(3, 2, "clause", "5.1", "a"), node(4, None, "section", "6", "试验"), node(5, 4, "clause", "6.1", "b"), node(6, None, "annex", "A", "（规范性）标记"), ("mention", None, None, "internalClause", "5.1", None, None), ("mention", None, None, "internalTable", "1", None, None), ("table", None, None, None, "1", None, None), ("block", None, None, "paragraph", None, "不大于 5 mm", None)],
     states("pppp" + "wppp" + "pnpp" + "pppp" + "uu")),
    ([doc("", "guide"), node(1, None, "section", "2", "a"), node(2, None, "section", "2", "b", None), node(3, 1, "clause", "4.1.1", "c"), node(4, 1, "clause", "5.1", "d"), node(5, None, "annex", "A", None), ("mention", None, None, "internalClause", "9.{k}", None, None), ("mention", None, None, "internalTable", "7", None, None), ("mention", None, None, "internalFigure", "7-1", None, None), ("figure", None, None, None, "7.2", None, None), ("block", None, None, "unknown", None, "≥ 3", None)],
     states("fwnw" + "wwww" + "wwww" + "wwwf" + "uu")),
    ([doc(None, None)], states("fwnw" + "nnnn" + "nnpp" + "ppwf" + "uu")),
], _audit)

# ---- references

CITED = "match_no int, standard_id string, version string, kind string, nature string, in_list boolean, source_id string"


def cite(standard: str, version: str | None = None, nature: str = "normative", listed: bool = False, kind: str = "dated", n: int = 0) -> tuple:
    return n, standard, version, kind, nature, listed, None


ENTRIES = [cite("GB/T 1", listed=True), cite("GB/T 2.{k}", listed=True), cite("GB/T 1", "2020", listed=True), cite("GB 3", "2009", "informative"), cite("GB/T 2.{k}", "2011"), cite("GB 3", "2010", kind="undated"), cite("GB 3", None)]

cases("citation_summary", CITED, "standard_id string, n_citations long, first_version string, first_kind string, nature string, first_pos int", [
    (ENTRIES, [("GB/T 1", 2, "2020", "dated", "normative", 0), ("GB/T 2.{k}", 2, "2011", "dated", "normative", 1), ("GB 3", 3, "2009", "dated", "normative", 3)]),
    ([cite("X", None, "informative")], [("X", 1, None, "dated", "informative", 0)]),
], references.summary)

cases("reference_entries", CITED, "standard_id string, pos int, key string", [
    (ENTRIES, [("GB/T 1", 0, "GBT1"), ("GB/T 2.{k}", 1, "GBT2.{k}")]),
    ([cite("X")], []),
], references.list_entries)

cases("reverse_lookup", CITED, "standard_id string, pos int", [
    (ENTRIES, [("GB 3", 3), ("GB 3", 5), ("GB 3", 6)]),
    ([cite("gb_3"), cite("GB 31")], [("gb_3", 0)]),
], lambda d: references.citing(d, "G B/3"))

cases("graph_reference_list", CITED, "standard_id string, pos int", [
    (ENTRIES, [("GB/T 1", 0), ("GB/T 2.{k}", 1)]),
], references.graph_references)

cases("listed_uncited_entries", CITED, "standard_id string, pos int, near_misses string", [
    ([cite("GB/T 1", listed=True), cite("GB 2", listed=True), cite("GB 9.{k}", listed=True), cite("GB/T 2", "2010"), cite("GB/T 1", nature="informative")], [("GB 2", 1, "GB/T 2"), ("GB 9.{k}", 2, "")]),
    ([cite("GB/T 1", listed=True), cite("GB/T 1—2011")], []),
    ([cite("X")], []),
], lambda d: references.listed_but_uncited(d).withColumn("near_misses", F.array_join("near_misses", "|")))

cases("cited_unlisted_entries", CITED, "standard_id string, pos int", [
    # a series covers its part, a part its series; informative citations need no entry
    ([cite("GB/T 1", listed=True), cite("GB/T 2.3", listed=True), cite("GB/T 1.{k}"), cite("GB/T 2"), cite("GB/T 12"), cite("GB/T 12"), cite("ISO 9", nature="informative")], [("GB/T 12", 4)]),
    ([cite("GB 1.{k}")], [("GB 1.{k}", 0)]),
], references.cited_but_unlisted)

cases("resolved_mentions", "side string, target_type string, number string, match_no int, source_id string, target_id string", "pos int, number string, target_id string, status string", [
    ([("mention", "internalTable", "3", 0, "n", None), ("mention", "internalTable", "3", 1, "n", None), ("mention", "internalTable", "B-1", 0, "n", None), ("mention", "internalFigure", "3", 0, "n", None), ("target", "internalTable", "3", None, None, "T3-{k}"), ("target", "internalTable", "B.1", None, None, "TB")],
     [(0, "3", "T3-{k}", "resolved"), (2, "B-1", "TB", "resolved"), (3, "3", None, "unresolved")]),
    ([("target", "internalTable", "1", None, None, "T")], []),
], lambda d: references.resolved(d.filter("side = 'mention'").drop("side", "target_id"), d.filter("side = 'target'").select("doc_id", "target_type", "number", "target_id")))

cases("all_verdicts", "side string, kind string, node_type string, number string, title string", "subject string, rule_id string, status string", [
    ([("node", "heading", "annex", "A", "x"), ("node", "heading", "annex", "C", "y"), ("block", "paragraph", None, None, "不大于 5")], [("B", "GBT-C15", "fail"), ("limits", "GBT-P10-R02", "warning")]),
    ([("node", "heading", "annex", "A", "{k}"), ("block", "paragraph", None, None, None)], []),
], lambda d: rules.verdicts(rules.annex_letters(d.filter("side = 'node'")), rules.limits_without_unit(d.filter("side = 'block'").select("doc_id", "pos", "kind", F.col("title").alias("text")))))

cases("unified_list_markers", "list int, item int, marker string, marker_kind string", "list int, item int, marker string, issue string", [
    ([(1, 0, "-", "symbol"), (1, 1, "—", "symbol"), (1, 2, "—", "symbol"), (1, 3, "a）", "letter"), (2, 0, "-", "symbol"), (2, 1, "—", "symbol"), (3, 0, "•", "symbol")],
     [(1, 0, "—", "CSM-OCR-001"), (1, 1, "—", None), (1, 2, "—", None), (1, 3, "a）", None), (2, 0, "-", None), (2, 1, "—", None), (3, 0, "•", None)]),
    ([(1, 0, None, None)], [(1, 0, None, None)]),
], lambda d: repair.unified_markers(d.drop("pos").withColumnRenamed("list", "pos")).withColumnRenamed("pos", "list"))

# ---- structure

NAME = "额定值  rated value"

cases("merged_term_entries", BLOCK, "pos int, kind string, title string, number string, issue string", [
    ([heading(1, "3", "术语和定义"), block("paragraph", "3.{k}"), block("paragraph", NAME), block("paragraph", "定义。")],
     [(0, "heading", "术语和定义", "3", None), (1, "heading", NAME, "3.{k}", "CSM-OCR-007"), (3, "paragraph", None, None, None)]),
    ([heading(1, "4", "要求"), block("paragraph", "4.1"), block("paragraph", NAME)],
     [(0, "heading", "要求", "4", None), (1, "paragraph", None, None, None), (2, "paragraph", None, None, None)]),
    ([heading(1, "3", "术语"), block("heading", "## 3.1", 2, "3.1", ""), block("paragraph", "不是名称")],
     [(0, "heading", "术语", "3", None), (1, "heading", "", "3.1", None), (2, "paragraph", None, None, None)]),
], structure.merged_terms)

cases("nested_example_levels", BLOCK, "pos int, kind string, level int, issue string", [
    ([heading(2, "4.1", "a"), heading(1, None, "示例 {k}："), heading(2, None, "甲"), block("paragraph", "x")],
     [(0, "heading", 2, None), (1, "heading", 3, "CSM-OCR-008"), (2, "paragraph", 2, "CSM-OCR-020"), (3, "paragraph", None, None)]),
    ([heading(6, "1", "a"), heading(2, None, "示例"), heading(2, "5", "b"), heading(2, None, "c")],
     [(0, "heading", 6, None), (1, "heading", 6, "CSM-OCR-008"), (2, "heading", 2, None), (3, "heading", 2, None)]),
    ([heading(2, None, "示例：")], [(0, "heading", 2, None)]),
], structure.nested_examples)

cases("annex_example_content", "kind string, node_type string, number string, title string", "pos int, example_content boolean", [
    ([("heading", "section", "1", "a"), ("heading", "annex", "A", "b"), ("paragraph", None, None, None), ("heading", "section", None, "c"), ("paragraph", None, None, None), ("heading", "clause", "A.1", "d")],
     [(0, False), (1, False), (2, False), (3, False), (4, False), (5, False)]),
    ([("heading", "annex", "B", "b"), ("heading", "clause", None, "样表{k}"), ("paragraph", None, None, None), ("heading", "clause", "B.2", "d"), ("paragraph", None, None, None), ("heading", None, None, "参考文献"), ("paragraph", None, None, None)],
     [(0, False), (1, True), (2, True), (3, False), (4, False), (5, False), (6, False)]),
], structure.annex_examples)

cases("images_inside_tables", "kind string, text string, caption string", "pos int, text string, issue string", [
    ([("table", "| a | b |\n| x |  |", "表 1 甲"), ("image", "![](p{k}.png)", None), ("table", "| c |", "表 1 甲（续）")],
     [(0, "| a | b |\n| x | ![](p{k}.png) |", "CSM-TABLE-002"), (2, "| c |", None)]),
    ([("table", "| a |", "表 1"), ("image", "![](p.png)", None), ("table", "| c |", "表 2（续）")], [(0, "| a |", None), (1, "![](p.png)", None), (2, "| c |", None)]),
    ([("table", "| a |", None), ("image", None, None)], [(0, "| a |", None), (1, None, None)]),
], structure.images_into_tables)

# ---- content

cases("footnote_owners", "side string, label string", "label string, owner_pos int, issue string", [
    ([("def", "1"), ("def", "2"), ("def", "3{k}"), ("cite", "1"), ("cite", "2"), ("cite", "2")], [("1", 3, None), ("2", None, "CSM-STRUCT-008"), ("3{k}", None, "CSM-STRUCT-009")]),
    ([("cite", "9")], []),
], lambda d: repair.bound_footnotes(d.filter("side = 'def'").select("doc_id", "label"), d.filter("side = 'cite'").select("doc_id", "label", "pos")))

cases("footnote_anchors", "side string, node int, up int, label string, note string", "node int, label string, note_id string", [
    # own node first, then the nearest ancestor, then the only one there is
    ([("def", 1, None, "a", "n1"), ("def", 3, None, "a", "n3{k}"), ("def", 9, None, "b", "n9"), ("def", 8, None, "c", "n7"), ("def", 9, None, "c", "n8"), ("cite", 3, None, "a", None), ("cite", 2, None, "a", None), ("cite", 2, None, "b", None), ("cite", 2, None, "c", None), ("up", 3, 2, None, None), ("up", 3, 1, None, None), ("up", 2, 1, None, None)],
     [(3, "a", "n3{k}"), (2, "a", "n1"), (2, "b", "n9"), (2, "c", None)]),
    ([("cite", 1, None, "z", None)], [(1, "z", None)]),
], lambda d: content.anchored(
    d.filter("side = 'cite'").select("doc_id", "node", "label"), d.filter("side = 'def'").select("doc_id", "node", "label", F.col("note").alias("note_id")),
    d.filter("side = 'up'").select("doc_id", "node", F.col("up").alias("ancestor"), (F.col("node") - F.col("up")).alias("distance"))))

cases("reference_chapter_findings", "side string, p int, up int, kind string, number string, text string", FINDING, [
    ([("node", 1, None, "section", "2", "引用文件"), ("block", None, 1, "list", None, "1) GB/T {k}")], [("引用文件", "GBT-C06", "must", "chapter 2 is not the list of references"), ("lead-in", "GBT-C06", "must", "the list has no lead-in"), ("1", "GBT-C06", "should", "entries are numbered")]),
    ([("node", 1, None, "section", "2", "规范性引用文件"), ("block", None, 1, "paragraph", None, "下列文件{k}"), ("block", None, 1, "list", None, "— GB/T 1")], []),
    ([("node", 1, None, "annex", "2", "x"), ("block", None, 1, "paragraph", None, None)], []),
], lambda d: content.reference_chapter(
    d.filter("side = 'node'").select("doc_id", F.col("p").alias("pos"), F.col("kind").alias("node_type"), "number", F.col("text").alias("title")),
    d.filter("side = 'block'").select("doc_id", "pos", F.col("up").alias("parent_pos"), "kind", "text")))

cases("quality_statuses", "side string, asset_ref string", "n_issues long, status string, figure_confidence double", [
    ([("doc", None), ("issue", None), ("issue", None), ("figure", "a{k}.png")], [(2, "partial", 1.0)]),
    ([("doc", None), ("figure", None), ("figure", "b.png")], [(0, "complete", 0.5)]),
    ([("doc", None)], [(0, "complete", 1.0)]),
], lambda d: content.quality_status(d.filter("side = 'doc'"), d.filter("side = 'issue'"), d.filter("side = 'figure'")))

cases("presentations", "kind string", "presentation string", [
    ([("image",), ("heading",), ("odd{k}",), (None,)], [("figure",), ("heading",), ("other",), ("other",)]),
    ([("note",), ("note",)], [("note",), ("note",)]),
], lambda d: d.withColumn("presentation", content.presentation_of(F.col("kind"))))

cases("list_introductions", "parent_pos int, kind string", "pos int, intro_pos int", [
    ([(1, "paragraph"), (1, "list"), (2, "list"), (1, "list")], [(1, 0), (2, None), (3, 1)]),
    ([(None, "paragraph")], []),
], content.list_intros)

cases("term_entries", BLOCK, "number string, term string, english_term string, definition string", [
    ([heading(1, "3", "术语和定义"), heading(2, "3.10", "额定值 rated value"), block("paragraph", "[来源]"), block("paragraph", "甲{k}"), block("paragraph", "乙"), heading(2, "3.9", ""), block("paragraph", "电流"), block("paragraph", "丙")],
     [("3.10", "额定值", "rated value", "甲{k}"), ("3.9", "电流", None, "丙")]),
    ([heading(1, "4", "要求"), heading(2, "4.1", "a"), block("paragraph", "b")], []),
], lambda d: catalog.terms(d, d))

# ---- lines and trees

cases("boxed_rows", "text string", "pos int, inside boolean", [
    ([("a",), ("<box>",), ("b",), ("<box>",), ("c{k}",), ("</box>",), ("d",), ("<box>",), ("e",)], [(0, False), (1, False), (2, True), (3, False), (4, True), (5, False), (6, False), (7, False), (8, True)]),
    ([("</box>",), ("a",)], [(0, False), (1, False)]),
], lambda d: lines.spans_between(d, F.col("text") == "<box>", F.col("text") == "</box>"))

cases("column_groups", "text string", "pos int, group_no long, column_no long", [
    ([("[",), ("|",), ("a{k}",), ("|",), ("b",), ("]",), ("c",), ("[",), ("|",), ("d",)], [(0, None, None), (1, 1, 1), (2, 1, 1), (3, 1, 2), (4, 1, 2), (5, None, None), (6, None, None), (7, None, None), (8, 2, 1), (9, 2, 1)]),
    ([("|",)], [(0, None, None)]),
], lambda d: lines.groups_within(d, F.col("text") == "[", F.col("text") == "|", F.col("text") == "]"))

cases("directive_targets", "kind string, text string", "pos int, target string, owner string", [
    ([("d", "1"), ("x", "a{k}"), ("d", "2"), ("d", "3"), ("x", "b")], [(0, "a{k}", None), (1, "b", None), (2, "b", "a{k}"), (3, "b", "a{k}"), (4, None, "a{k}")]),
    ([("d", None)], [(0, None, None)]),
], lambda d: lines.last_matching(lines.next_matching(d, F.col("text"), F.col("kind") == "x"), F.col("text"), F.col("kind") == "x"))

cases("fenced_lines", "text string", "pos int, fenced boolean, unclosed boolean", [
    ([("```",), ("a{k}",), ("```",), ("b",)], [(0, False, False), (1, True, False), (2, False, False), (3, False, False)]),
    ([("a",), ("```",), ("b",)], [(0, False, True), (1, False, True), (2, True, True)]),
], lambda d: lines.fence_parity(d, F.col("text").startswith("```")))

cases("promoted_numbers", "side string, number string", "number string", [
    ([("seed", "4.1"), ("new", "4.2"), ("new", "4.2.1"), ("new", "5.1"), ("new", "4.1.3"), ("new", "7")], [("4.2",), ("4.2.1",), ("4.1.3",)]),
    ([("new", "1.1")], []),
    ([("seed", "{k}"), ("new", "{k}.1"), ("new", "{k}.1"), ("new", "{k}.1.1.1")], [("{k}.1",)]),
], lambda d: tree.promoted(d.filter("side = 'seed'"), d.filter("side = 'new'")))

cases("nearest_lines", "side string, p int, line string", "left_pos int, right_pos int, similarity double", [
    ([("a", 0, "same"), ("a", 1, "abcd"), ("a", 2, "zz"), ("b", 3, "same"), ("b", 5, "same"), ("b", 2, "abcx"), ("b", 40, "zz{k}")], [(0, 3, 1.0), (1, 2, 0.75), (2, 2, 0.0)]),
    ([("a", 0, "x")], []),
], lambda d: joins.nearest_line(d.filter("side = 'a'").drop("pos"), d.filter("side = 'b'").drop("pos"), "doc_id", "p", "line"))

# ---- sources

cases("example_frame_styles", "style string", "example_style string", [
    ([("stroke",), ("fill",)], [("frame",)]),
    ([("fill",), (None,), ("stroke",), ("fill",)], [("fill",)]),
    ([(None,)], [("frame",)]),
], layout.example_styles)

cases("header_row_counts", "t int, row int, rowspan int", "t int, header_rows int", [
    ([(1, 0, 2), (1, 0, 1), (1, 1, 5), (2, 0, 1)], [(1, 2), (2, 1)]),
    ([(1, 1, 3)], []),
], lambda d: html.header_rows(d, ["doc_id", "t"]))

cases("restored_note_markers", "row int, col int, cell string", "row int, col int, cell string", [
    ([(0, 0, "额定电压"), (0, 1, "电压"), (1, 0, "a 额定电压按{k}"), (2, 0, "b 电流")], [(0, 0, "额定电压a"), (0, 1, "电压"), (1, 0, "a 额定电压按{k}"), (2, 0, "b 电流")]),
    ([(0, 0, None), (1, 0, "a 值")], [(0, 0, None), (1, 0, "a 值")]),
], lambda d: html.restored_markers(d, ["doc_id"]))

cases("glued_parts", "a string, b string, c string", "text string", [
    ([("GB", "1{k}", "条")], [("GB 1{k}条",)]),
    ([("甲", "", "乙")], [("甲乙",)]),
    ([("a", "", "b")], [("a b",)]),
], lambda d: d.withColumn("text", layout.glued(F.array("a", "b", "c"))))

# ---- tables

IMAGE = "![](p.png)"

cases("cell_image_layout", "p int, number string, row int, col int, cell string", "p int, row int, col int, cell string, issue string", [
    # the text of column 1 goes to the image before it; the continuation's cell turns round
    ([(1, "1", 0, 0, "a"), (1, "1", 0, 1, "b"), (1, "1", 1, 0, IMAGE), (1, "1", 1, 1, "说{k} " + IMAGE), (1, "1", 2, 0, IMAGE), (1, "1", 2, 1, IMAGE), (2, "1", 0, 0, "x " + IMAGE), (2, "1", 1, 0, "文 " + IMAGE + " 字")],
     [(1, 0, 0, "a", None), (1, 0, 1, "b", None), (1, 1, 0, IMAGE + " 说{k}", "CSM-TABLE-003"), (1, 1, 1, IMAGE, "CSM-TABLE-003"), (1, 2, 0, IMAGE, None), (1, 2, 1, IMAGE, None), (2, 0, 0, "x " + IMAGE, None), (2, 1, 0, IMAGE + " 文 字", "CSM-TABLE-003")]),
    # two texts in the column; a cell before that holds text; one data row
    ([(1, None, 0, 0, "h"), (1, None, 1, 0, IMAGE), (1, None, 1, 1, "甲" + IMAGE), (1, None, 2, 0, IMAGE), (1, None, 2, 1, "乙{k}" + IMAGE), (2, "2", 0, 0, "h"), (2, "2", 1, 0, IMAGE), (2, "2", 1, 1, "丙" + IMAGE)],
     [(1, 0, 0, "h", None), (1, 1, 0, IMAGE, None), (1, 1, 1, "甲" + IMAGE, None), (1, 2, 0, IMAGE, None), (1, 2, 1, "乙{k}" + IMAGE, None), (2, 0, 0, "h", None), (2, 1, 0, IMAGE, None), (2, 1, 1, "丙" + IMAGE, None)]),
    ([(1, "1", 1, 0, None), (1, "1", 2, 0, "")], [(1, 1, 0, None, None), (1, 2, 0, "", None)]),
], lambda d: structure.cell_images(d.select("doc_id", F.col("p").alias("pos"), "number", F.lit(1).alias("header_rows"), "row", "col", "cell")).withColumnRenamed("pos", "p"))


def _merges(rows: DataFrame) -> DataFrame:
    """Cells and merge directives of each document apart."""
    own = rows.filter("side = 'cell'").select("doc_id", F.lit(1).alias("table_id"), F.lit(1).alias("header_rows"), "row", "col", "text")
    asked = rows.filter("side = 'merge'").select("doc_id", F.lit(1).alias("table_id"), F.col("pos").alias("place"), "row", "col", "rowspan", "colspan")
    return structure.realigned_merges(own, asked)


def cell(row: int, col: int, text: str | None) -> tuple:
    return "cell", row, col, None, None, text


def merge(row: int, col: int, rowspan: int = 1, colspan: int = 1) -> tuple:
    return "merge", row, col, rowspan, colspan, None


cases("realigned_table_merges", "side string, row int, col int, rowspan int, colspan int, text string", "row int, col int, rowspan int, colspan int, action string", [
    # the label stands above the anchor, the band ends before the next label
    ([cell(0, 0, "h"), cell(1, 0, "甲{k}"), cell(2, 0, ""), cell(3, 0, None), cell(4, 0, "乙"), cell(5, 0, " "), merge(2, 0, 3), merge(3, 0, 2), merge(4, 0, 2), merge(5, 0, 2), merge(9, 0, 2), merge(2, 0, 1, 2)],
     [(1, 0, 3, 1, "realigned"), (3, 0, 2, 1, "overlap"), (4, 0, 2, 1, None), (5, 0, 2, 1, None), (9, 0, 2, 1, "out-of-range"), (2, 0, 1, 2, "empty-anchor")]),
    # only the header has text above; no text in the band
    ([cell(0, 0, "h{k}"), cell(1, 0, ""), cell(2, 0, "甲"), cell(3, 0, ""), cell(4, 0, ""), merge(1, 0, 2), merge(3, 0, 2)],
     [(1, 0, 2, 1, None), (3, 0, 2, 1, None)]),
], _merges)

# ---- numbers and the catalogue

cases("restored_partial_numbers", BLOCK, "pos int, number string, issue string", [
    ([heading(2, "7", "a"), heading(2, "71", "b{k}"), heading(2, "7.11", "c"), heading(2, "7111", "d"), heading(2, "7112", "e"), heading(2, "72", "f")],
     [(0, "7", None), (1, "7.1", "CSM-OCR-002"), (2, "7.1.1", "CSM-OCR-002"), (3, "7.1.1.1", "CSM-OCR-002"), (4, "7.1.1.2", "CSM-OCR-002"), (5, "7.2", "CSM-OCR-002")]),
    ([heading(2, "9", "a"), heading(2, "10", "b"), heading(2, "101", "c"), heading(2, "10.10", "d"), heading(2, None, "e")],
     [(0, "9", None), (1, "10", None), (2, "10.1", "CSM-OCR-002"), (3, "10.10", None), (4, None, None)]),
], repair.restored_numbers)

cases("catalogue_counts", "kind string, node_type string", "n_section long, n_clause long, n_annex long, n_paragraph long, n_table long, n_note long", [
    ([("heading", "section"), ("heading", "clause"), ("heading", "clause"), ("table", None), ("paragraph", None), ("odd{k}", "odd")], [(1, 2, 0, 1, 1, 0)]),
    ([(None, None)], [(0, 0, 0, 0, 0, 0)]),
], lambda d: catalog.detail(d, d))
