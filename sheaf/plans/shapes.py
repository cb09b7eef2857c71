"""Queries that run repairs, parsers and rules on documents of several shapes.

Every customer is a document; its key says which of a few shapes it has: clean,
broken in one way or another, or with nothing to do. A shape is a list of rows,
and so is what must come out; ``{k}`` stands for the key. The SQL lays out what
must come out, the query what goes in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import naming, text
from sheaf.operators import content, lines, repair, rules
from sheaf.plans.catalogue import query
from sheaf.sources.tables import table

SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "long": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}
BLOCK = "kind string, level int, number string, title string, text string"
NODE = "parent_pos int, node_type string, number string, title string"
FINDING = "subject string, rule_id string, priority string, message string"


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def laid_out(schema: str, shapes: list[list[tuple]]) -> str:
    """The rows of every document's shape, in SQL."""
    columns = [c.split() for c in schema.split(", ")]
    rows = ", ".join(f"({i}, {', '.join(map(literal, row))})" for i, shape in enumerate(shapes) for row in shape)
    picked = ", ".join(f"replace(CAST({n} AS VARCHAR), '{{k}}', CAST(c_custkey AS VARCHAR)) AS {n}" if t == "string" else f"CAST({n} AS {SQL_TYPES[t]}) AS {n}" for n, t in columns)
    return f"SELECT c_custkey AS doc_id, {picked} FROM customer JOIN (VALUES {rows}) AS e(shape, {', '.join(n for n, _ in columns)}) ON c_custkey % {len(shapes)} = e.shape"


#: Documents that one task lays out. A customer is a few bytes, a document much more, so that the files' parts would be too much for a task.
DOCUMENTS_A_TASK = 5_000


def shaped(spark: SparkSession, sf_dir: str, schema: str, shapes: list[list[tuple]]) -> DataFrame:
    """doc_id, pos and the rows of every document's shape."""
    own = spark.createDataFrame([(i, pos, *row) for i, shape in enumerate(shapes) for pos, row in enumerate(shape)], f"shape int, pos int, {schema}")
    customers = table(spark, sf_dir, "customer")
    docs = customers.select(F.col("c_custkey").alias("doc_id"), (F.col("c_custkey") % len(shapes)).cast("int").alias("shape")).repartition(-(-customers.count() // DOCUMENTS_A_TASK) or 1, "doc_id")
    joined = docs.join(F.broadcast(own), "shape").drop("shape")  # a few rows
    return joined.withColumns({n: F.replace(n, F.lit("{k}"), F.col("doc_id").cast("string")) for n, t in (c.split() for c in schema.split(", ")) if t == "string"})


def cases(name: str, given: str, wanted: str, shapes: list[tuple[list[tuple], list[tuple]]], run: Callable[[DataFrame], DataFrame]) -> None:
    """Registers a query: run over the given rows of each shape makes the wanted ones."""

    def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(shaped(spark, sf_dir, given, [g for g, _ in shapes])).select("doc_id", *(c.split()[0] for c in wanted.split(", ")))

    asked.__name__, asked.__doc__ = name, run.__doc__
    query(laid_out(wanted, [w for _, w in shapes]))(asked)


def block(kind: str, text: str | None = None, level: int | None = None, number: str | None = None, title: str | None = None) -> tuple:
    return kind, level, number, title, text


def heading(level: int, number: str | None, title: str) -> tuple:
    return block("heading", f"{'#' * level} {title}", level, number, title)


# ---- texts

cases("latex_texts", "text string", "text string", [
    ([("\\frac{a+b}{c{k}}",)], [("(a+b)/c{k}",)]),
    ([("\\alpha \\pi \\rho \\sigma \\tau \\phi \\omega {k}",)], [("α π ρ σ τ φ ω {k}",)]),
    ([("\\Pi\\Sigma\\Phi\\Omega",)], [("ΠΣΦΩ",)]),
    ([("x^{2}_{1} \\times {k}",)], [("x²₁ × {k}",)]),
    ([("",)], [("",)]),
], lambda d: d.withColumn("text", text.latex_text("text")))

cases("body_punctuations", "text string", "text string", [
    ([("见表,{k}处",)], [("见表，{k}处",)]),
    ([("值:{k};甲, 乙",)], [("值：{k}；甲， 乙",)]),
    ([("f(x中y)和(a, b)",)], [("f（x中y）和（a, b）",)]),
    ([("(见8.4);<!-- 甲,乙 -->完.",)], [("（见8.4）；<!-- 甲,乙 -->完。",)]),
    ([("plain, text ({k}).",)], [("plain, text ({k}).",)]),
    ([("（半开)$a, 甲$",)], [("（半开）$a, 甲$",)]),
], lambda d: d.withColumn("text", repair.body_punctuation("text")))

cases("guide_phrases", "text string", "text string, issue string", [
    ([("卜列文件对于本文件{k}",)], [("下列文件对于本文件{k}", "CSM-OCR-011")]),
    ([("下列文件对于本文件",)], [("下列文件对于本文件", None)]),
    ([("见卜列文件对于本文件",)], [("见卜列文件对于本文件", None)]),
], repair.guide_phrase)

cases("bracketed_list_entries", "text string", "text string, issue string", [
    ([("[1 GB/T {k}",)], [("[1] GB/T {k}", "CSM-OCR-013")]),
    ([("2] GB/T {k}",)], [("[2] GB/T {k}", "CSM-OCR-013")]),
    ([("［3］GB {k}",)], [("[3] GB {k}", "CSM-OCR-013")]),
    ([("[4] other {k}",)], [("[4] other {k}", None)]),
], repair.bracketed_entries)

cases("symbol_ids", "text string", "id string", [
    ([("\\overline{\\eta}",)], [("VAR_ETA_OVERLINE",)]),
    ([("x_n^e",)], [("VAR_X_SUB_N_SUP_E",)]),
    ([("S_{ME,i}",)], [("VAR_S_SUB_ME_I",)]),
    ([("$P_{{k}}$",)], [("VAR_P_SUB_{k}",)]),
    ([("\\varphi^2",)], [("VAR_PHI_SUP_2",)]),
    ([("$$",)], [(None,)]),
], lambda d: d.withColumn("id", naming.variable_id("text")))

cases("path_ids", "text string, number string", "annex string, owned string, local string, concept string, artifact string", [
    ([("附录B", "B.2.{k}")], [("Annex_B.2.{k}", "S#8.Note_B.2.{k}", "S#8/Paragraph-007", "CONCEPT_B", "附录B")]),
    ([("c", "2.1")], [("Annex_C.2.1", "S#8.Note_2.1", "S#8/Paragraph-007", "CONCEPT_C", "c")]),
    ([("9 z.raw.md", "")], [(None, None, "S#8/Paragraph-007", "CONCEPT_9_Z_RAW_MD", "9 z")]),
], lambda d: d.select("doc_id", naming.annex_path(F.col("text"), F.col("number")).alias("annex"), naming.owned_id(F.lit("S#8"), F.lit("note"), F.col("number")).alias("owned"), naming.local_id(F.lit("S#8"), F.lit("paragraph"), F.lit(7)).alias("local"), naming.concept_id(F.col("text")).alias("concept"), naming.artifact_id(F.col("text")).alias("artifact")))

# ---- repairs of blocks

cases("raised_heading_levels", BLOCK, "level int, issue string", [
    ([heading(1, "4.2.1", "a{k}")], [(4, "CSM-OCR-006")]),
    ([heading(2, "4", "a")], [(2, None)]),
    ([heading(2, None, "前言"), block("paragraph", "x")], [(2, None), (None, None)]),
    ([heading(5, "4.1", "a"), heading(1, "1.2.3.4.5.6", "b")], [(5, None), (6, "CSM-OCR-006")]),
], repair.raised_levels)

cases("demoted_sentence_headings", BLOCK, "kind string, title string, issue string", [
    ([heading(2, "4.1", "应符合要求{k}。")], [("paragraph", "应符合要求{k}。", "CSM-OCR-009")]),
    ([heading(2, "4.1", "要求")], [("heading", "要求", None)]),
    ([heading(2, None, "为什么？")], [("heading", "为什么？", None)]),
], repair.demoted_sentences)

cases("merged_part_titles", BLOCK, "title string, issue string", [
    ([heading(1, None, "电机{k}"), heading(1, None, "第1部分:通则")], [("电机{k} 第1部分:通则", "CSM-STRUCT-001")]),
    ([heading(1, None, "电机"), heading(1, None, "范围")], [("电机", None), ("范围", None)]),
    ([heading(1, None, "长" * 58), heading(1, None, "第2部分：通则")], [("长" * 58, None), ("第2部分：通则", None)]),
    ([heading(1, None, "泵"), heading(2, None, "第二部分：通则")], [("泵", None), ("第二部分：通则", None)]),
], repair.merged_titles)

cases("lost_list_markers", BLOCK, "pos int, kind string, text string, issue string", [
    ([block("list", "— 甲；"), block("paragraph", "乙{k}；"), block("list", "— 丙。")], [(0, "list", "— 甲；", None), (1, "list", "— 乙{k}；", "CSM-OCR-005"), (2, "list", "— 丙。", None)]),
    ([block("list", "— 甲；"), block("paragraph", "乙"), block("list", "— 丙。")], [(0, "list", "— 甲；", None), (1, "paragraph", "乙", None), (2, "list", "— 丙。", None)]),
    ([block("paragraph", "甲；"), block("list", "— 丙。")], [(0, "paragraph", "甲；", None), (1, "list", "— 丙。", None)]),
    ([block("list", "a) 甲；"), block("paragraph", "乙；"), block("list", "b) 丙。")], [(0, "list", "a) 甲；", None), (1, "paragraph", "乙；", None), (2, "list", "b) 丙。", None)]),
], repair.lost_markers)

cases("formula_number_order", BLOCK, "pos int, number string, expected string, issue string", [
    ([block("formula", "$$ x \\tag{1} $$"), block("formula", "$$ y{k} $$\n式（2）")], [(0, "1", "1", None), (1, "2", "2", None)]),
    ([block("formula", "$$ x \\tag{2} $$"), block("formula", "$$ y $$")], [(0, "2", "1", "CSM-OCR-017"), (1, None, "2", None)]),
    ([block("formula", "$$ x \\tag{1} $$"), heading(2, "A", "附"), block("formula", "$$ z \\tag{(A.1)} $$")], [(0, "1", "1", None), (2, "A.1", "A.1", None)]),
], repair.formula_numbers)

cases("term_name_spacing", BLOCK, "pos int, text string, issue string", [
    ([heading(2, "3", "术语和定义"), block("paragraph", "叶轮 impeller")], [(0, "## 术语和定义", None), (1, "叶轮　impeller", "CSM-OCR-004")]),
    ([heading(2, "4", "要求"), block("paragraph", "叶轮 impeller")], [(0, "## 要求", None), (1, "叶轮 impeller", None)]),
    ([heading(2, "3", "术语"), block("paragraph", "叶轮{k} impeller")], [(0, "## 术语", None), (1, "叶轮{k} impeller", None)]),
], repair.term_spacing)

cases("restored_clause_numbers", BLOCK, "pos int, number string, issue string", [
    ([heading(2, "4", "a"), heading(3, "4.1", "b"), heading(3, "42", "c{k}")], [(0, "4", None), (1, "4.1", None), (2, "4.2", "CSM-OCR-002")]),
    ([heading(2, "4", "a"), heading(3, "4.2", "b"), heading(4, "421", "c"), heading(4, "422", "d")], [(0, "4", None), (1, "4.2", None), (2, "4.2.1", "CSM-OCR-002"), (3, "4.2.2", "CSM-OCR-002")]),
    ([heading(2, "9", "a"), heading(2, "10", "b")], [(0, "9", None), (1, "10", None)]),
    ([heading(2, "4", "a"), heading(2, "77", "b")], [(0, "4", None), (1, "77", None)]),
], repair.restored_numbers)

cases("index_letters", BLOCK, "pos int, kind string, issue string", [
    ([heading(1, None, "索引"), heading(2, None, "A"), block("paragraph", "阿{k}"), heading(2, "B", "")], [(0, "heading", None), (1, "paragraph", "CSM-OCR-019"), (2, "paragraph", None), (3, "paragraph", "CSM-OCR-019")]),
    ([heading(1, "1", "范围"), heading(2, None, "A")], [(0, "heading", None), (1, "heading", None)]),
], content.demoted_index_letters)

# ---- content

cases("formula_variable_lines", BLOCK, "pos int, symbol string, definition string, text string", [
    ([block("paragraph", "式中："), block("paragraph", "P — 功率{k}"), block("paragraph", "n —— 转速。"), block("paragraph", "其他")], [(1, "P", "功率{k}", "P——功率{k}；"), (2, "n", "转速", "n——转速。")]),
    ([block("paragraph", "式中："), block("paragraph", "P — 功率")], []),
    ([block("paragraph", "P — 功率"), block("paragraph", "n — 转速")], []),
], content.formula_variables)

cases("absorbed_table_notes", BLOCK, "pos int, kind string, text string", [
    ([block("table", "| 甲 |\n| 注：一 |"), block("paragraph", "注2：二{k}"), block("paragraph", "a) 三"), block("paragraph", "正文")], [(0, "table", "| 甲 |\n| 注：一<br>注2：二{k}<br>a) 三 |"), (3, "paragraph", "正文")]),
    ([block("table", "| 甲 |"), block("paragraph", "注：二")], [(0, "table", "| 甲 |"), (1, "paragraph", "注：二")]),
], content.absorbed_notes)

cases("footnote_definitions", "text string", "position int, label string, definition string", [
    ([("<!-- ssir:foot:a --> 甲{k} <!-- ssir:/foot --> x <!-- ssir:foot:b-1 -->乙<!-- ssir:/ foot -->",)], [(0, "a", "甲{k}"), (1, "b-1", "乙")]),
    ([("<!-- ssir:foot:a --> open",)], []),
    ([("none",)], []),
], content.footnotes)

cases("footnote_marks", "text string", "pos int, label string", [
    ([("甲[foot:a、b]乙[foot:a]",), ("[foot:c]",)], [(0, "a"), (0, "b"), (1, "c")]),
    ([("[foot:]{k}",)], []),
], content.footnote_citations)

cases("list_runs", BLOCK, "first_pos int, n_items long, intro_pos int, terminator string", [
    ([block("paragraph", "如下："), block("list", "甲{k}；"), block("list", "乙；"), block("paragraph", "x"), block("list", "丙。")], [(1, 2, 0, "；"), (4, 1, None, "。")]),
    ([block("list", "甲；"), block("list", "乙。")], [(0, 2, None, None)]),
    ([block("paragraph", "x：")], []),
], lines.list_groups)

cases("chapter_tags", "number string, title string", "presentation string, tags string", [
    ([("1", "总则")], [("list", "scope")]),
    ([("2", "规范性引用文件")], [("list", "normativeReference")]),
    ([("6", "试验与检验{k}")], [("list", "testMethod,inspectionRule")]),
    ([("7", "包装")], [("list", "")]),
], lambda d: d.select("doc_id", content.presentation_of(F.lit("list")).alias("presentation"), F.array_join(content.semantic_types(F.col("number"), F.col("title")), ",").alias("tags")))

# ---- rules

cases("cover_findings", "field string, value string", FINDING, [
    ([(f, "x{k}") for f in rules.REQUIRED_META], []),
    ([(f, " " if f == "ics" else "x") for f in rules.REQUIRED_META], [("ics", "GBT-C01", "must", "required field is missing")]),
    ([(f, "x") for f in rules.REQUIRED_META[2:]], [(f, "GBT-C01", "must", "required field is missing") for f in rules.REQUIRED_META[:2]]),
], lambda d: rules.cover_fields(d.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("meta"))))

cases("element_order_findings", NODE, FINDING, [
    ([(None, "documentBlock", None, "前 言"), (None, "section", "1", "范围"), (None, "section", "2", "要求{k}")], []),
    ([(None, "section", "2", "范围")], [("foreword", "GBT-E03", "must", "no foreword"), ("2", "GBT-C05", "must", "first chapter is not 1")]),
    ([(None, "documentBlock", None, "前言"), (None, "section", "1", "适用范围的说明")], [("scope", "GBT-E05", "must", "no scope")]),
], rules.element_order)

cases("annex_letter_findings", NODE, FINDING, [
    ([(None, "annex", "A", "a"), (None, "annex", "B", "b{k}")], []),
    ([(None, "annex", "A", "a"), (None, "annex", "D", "d")], [("B", "GBT-C15", "must", "annex letter is skipped"), ("C", "GBT-C15", "must", "annex letter is skipped")]),
    ([(None, "section", "1", "x")], []),
], rules.annex_letters)

cases("number_findings", NODE, FINDING, [
    ([(None, "section", "1", "a"), (None, "section", "2", "b{k}"), (1, "clause", "2.1", "c"), (1, "clause", "2.2", "d")], []),
    ([(None, "section", "1", "a"), (None, "section", "4", "b")], [(n, "GBT-H03", "must", "number is skipped") for n in ("2", "3")]),
    ([(None, "section", "1", "a"), (None, "section", "1", "b")], [("1", "GBT-H03", "must", "number is repeated")]),
    ([(None, "section", "1", "a"), (0, "clause", "2.1", "b")], [("2.1", "GBT-H03", "must", "number does not continue its parent's")]),
], rules.numbering)

cases("list_marker_findings", "list_pos int, marker string, marker_kind string", FINDING, [
    ([(3, "a)", "letter"), (3, "b)", "letter")], []),
    ([(3, "a)", "letter"), (3, "d)", "letter")], [("3:2", "GBT-C14", "should", "list marker is skipped"), ("3:3", "GBT-C14", "should", "list marker is skipped")]),
    ([(5, "1)", "digit"), (5, "3)", "digit")], [("5:2", "GBT-C14", "should", "list marker is skipped")]),
    ([(5, "1)", "digit"), (5, "—", "symbol"), (5, "3)", "digit")], []),
], lambda d: rules.list_numbering(d.withColumn("pos", F.col("list_pos"))))

cases("glyph_findings", NODE, FINDING, [
    ([(None, "section", "l.2", "a"), (None, "section", "1O", "b{k}")], [("l.2, 1O", "GBT-C16", "should", "2 numbers mix digits and letters")]),
    ([(None, "section", "1.2", "a"), (None, "annex", "A", "O")], []),
], rules.confusable_numbers)

cases("sibling_title_findings", NODE, FINDING, [
    ([(None, "section", "1", "a"), (0, "clause", "1.1", "b{k}"), (0, "clause", "1.2", "")], [("0", "GBT-H04", "should", "titled and untitled siblings are mixed")]),
    ([(None, "section", "1", "a"), (0, "clause", "1.1", ""), (0, "clause", "1.2", "")], []),
], rules.sibling_titles)

cases("hanging_findings", "parent_pos int, node_type string, kind string", FINDING, [
    ([(None, "section", "heading"), (0, None, "paragraph"), (0, None, "paragraph"), (0, "clause", "heading")], [("0", "GBT-H05", "should", "2 hanging paragraphs")]),
    ([(None, "section", "heading"), (0, None, "paragraph")], []),
    ([(None, "section", "heading"), (0, "clause", "heading"), (1, None, "paragraph")], []),
], rules.hanging_paragraphs)

cases("note_lead_findings", BLOCK, FINDING, [
    ([block("note", "> 注：甲{k}"), block("example", "示例1：乙")], []),
    ([block("note", "> 甲{k}"), block("example", "乙"), block("paragraph", "丙")], [("0", "GBT-X03", "should", "note has no lead-in"), ("1", "GBT-X05", "should", "example has no lead-in")]),
], rules.note_leads)

cases("sequence_findings", "number string", FINDING, [
    ([("1",), ("2",), ("3",)], []),
    ([("1",), ("3",), ("4",)], [("3", "GBT-P03", "must", "expected 2")]),
    ([("{k}x",)], [("{k}x", "GBT-P03", "must", "expected 1")]),
], lambda d: rules.sequence_breaks(d, "number", "GBT-P03"))

cases("missing_number_findings", BLOCK, FINDING, [
    ([block("table", "t", number="{k}"), block("image", "i"), block("paragraph", "x")], [("1", "GBT-F01", "must", "image has no number")]),
    ([block("table", "t", number="")], [("0", "GBT-T01", "must", "table has no number")]),
], lambda d: rules.missing_numbers(d, {"table": "GBT-T01", "image": "GBT-F01"}))

cases("unit_limit_findings", BLOCK, FINDING, [
    ([block("paragraph", "不大于 5 mm，不小于 {k}。"), block("paragraph", "≥ 3")], [("limits", "GBT-P10-R02", "should", "2 limits without a unit")]),
    ([block("paragraph", "不超过 10 %，≤ 4 kW")], []),
], rules.limits_without_unit)
