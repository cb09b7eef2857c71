"""References, repairs and catalogue views on our own text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sheaf.operators import catalog, markdown, references, repair

TEXT = """# 小型风机
## 前言
本文件由风机小组提出。
本文件起草单位：甲厂、乙所。
## 1 范围
GB/T12345 适用。
## 3 术语和定义
### 3.1 叶轮 impeller
转动的部分。
### 3.2

轮毂 hub

[来源：某处]

连接的部分。
### 3.10 机壳 casing
外壳。
## 参考文献
"""


@pytest.fixture(scope="module")
def blocks(spark):
    return markdown.blocks(spark.createDataFrame([("d", TEXT)], "doc_id string, text string")).cache()


def test_catalogue(blocks):
    nodes = markdown.sections(blocks)
    got = [(r.number, r.term, r.english_term, r.definition) for r in catalog.terms(nodes, blocks).collect()]
    assert got == [("3.1", "叶轮", "impeller", "转动的部分。"), ("3.2", "轮毂", "hub", "连接的部分。"), ("3.10", "机壳", "casing", "外壳。")]
    who = catalog.organisations(blocks).first()
    assert who.proposing == "风机小组" and who.units == ["甲厂", "乙所"] and who.secretariat is None
    assert {r.code: r.part for r in catalog.elements(nodes).collect()} == {"foreword": "front", "scope": "body", "terms": "body", "bibliography": "back"}
    assert {r.element for r in catalog.element_coverage(nodes).filter("present").collect()} == {"foreword", "scope", "terms", "bibliography"}
    assert catalog.detail(nodes, blocks).first().n_clause == 3
    assert [r.title for r in catalog.contents(nodes, 1).collect()] == ["前言", "范围", "术语和定义", "参考文献"]


def test_store(spark):
    rows = spark.createDataFrame([("d", "a", None, 1, "1"), ("d", "b", "a", 2, "1.1"), ("d", "c", "a", None, "1.2"), ("e", "x", "a", 1, "1")], "doc_id string, id string, parent_id string, sort_order int, number string")
    assert [(r.id, r.child_count) for r in catalog.children(rows, "d", None).collect()] == [("a", 2)]
    assert [r.id for r in catalog.children(rows, "d", "a").collect()] == ["c", "b"]
    assert [r.id for r in catalog.structure(rows, "d").collect()] == ["c", "a", "b"] and catalog.row(rows, "d", "b").count() == 1
    lines = spark.createDataFrame([("d", i, str(i)) for i in range(500)], "doc_id string, pos int, line string")
    assert [r.pos for r in catalog.source_lines(lines, "d", 0, 1000).collect()] == list(range(200))


def test_references(spark):
    rows = [
        (1, 0, "GB_T_755", None, "normative", True, "GB/T 755"),
        (2, 0, "GB_14023", None, "normative", True, "GB 14023"),
        (3, 0, "GB_T_2423", None, "normative", True, "GB/T 2423"),
        (10, 0, "GB_T_755", "2019", "informative", False, "GB/T 755—2019"),
        (11, 0, "GB_T_14023", None, "normative", False, "GB/T 14023"),
        (12, 0, "GB_T_2423.3", None, "normative", False, "GB/T 2423.3"),
        (13, 0, "ISO_9001", "2015", "normative", False, "ISO 9001:2015"),
        (14, 0, "ISO_9001", "2008", "informative", False, "ISO 9001:2008"),
    ]
    c = spark.createDataFrame([("d", *r, "undated") for r in rows], "doc_id string, pos int, match_no int, standard_id string, version string, nature string, in_list boolean, raw string, kind string")
    assert {r.standard_id: r.near_misses for r in references.listed_but_uncited(c).collect()} == {"GB_14023": ["GB_T_14023"], "GB_T_2423": []}
    assert {r.standard_id for r in references.cited_but_unlisted(c).collect()} == {"GB_T_14023", "ISO_9001"}
    s = {r.standard_id: r for r in references.summary(c).collect()}
    assert s["ISO_9001"].first_version == "2015" and s["ISO_9001"].versions == ["2008", "2015"] and s["GB_T_755"].n_citations == 2
    assert references.citing(c, "iso 9001").count() == 2
    assert [r.standard_id for r in references.graph_references(c).collect()] == ["GB_14023", "GB_T_2423", "GB_T_755"]
    m = spark.createDataFrame([("d", 1, 0, "internalTable", "3", "n1"), ("d", 2, 0, "internalTable", "3", "n1"), ("d", 3, 0, "internalTable", "B-1", "n1"), ("d", 4, 0, "internalTable", "9", "n1")], "doc_id string, pos int, match_no int, target_type string, number string, source_id string")
    reg = spark.createDataFrame([("d", "internalTable", "3", "T3"), ("d", "internalTable", "B.1", "TB1")], "doc_id string, target_type string, number string, target_id string")
    assert {r.number: r.target_id for r in references.resolved(m, reg).collect()} == {"3": "T3", "B-1": "TB1", "9": None}


def rows(spark, *given):
    return spark.createDataFrame([("d", i, *r) for i, r in enumerate(given)], "doc_id string, pos int, kind string, level int, number string, title string, text string")


def test_repairs(spark):
    given = rows(
        spark,
        ("heading", 1, None, "风机", "# 风机"),
        ("heading", 1, None, "第2部分：试验", "# 第2部分：试验"),
        ("heading", 2, "4.2", "这是一句话。", "## 4.2 这是一句话。"),
        ("heading", 2, "4.3", "噪声", "## 4.3 噪声"),
        ("list", None, None, None, "—甲；"),
        ("paragraph", None, None, None, "短项目；"),
        ("list", None, None, None, "—乙。"),
        ("paragraph", None, None, None, "卜列文件对于本文件的应用，见 GB/T20001。"),
        ("paragraph", None, None, None, "1] GB/T 755 电机\n12］ 其他"),
    )
    assert [(r.title, r.issue) for r in repair.merged_titles(given).filter("pos < 2").collect()] == [("风机 第2部分：试验", "CSM-STRUCT-001")]
    assert {r.pos: (r.level, r.issue) for r in repair.raised_levels(given).filter("kind = 'heading'").collect()}[3] == (3, "CSM-OCR-006")
    assert {r.pos: r.kind for r in repair.demoted_sentences(given).collect()}[2] == "paragraph"
    fixed = {r.pos: r for r in repair.lost_markers(given).collect()}
    assert fixed[5].kind == "list" and fixed[5].text == "— 短项目；" and fixed[7].kind == "paragraph"
    both = {r.pos: r for r in repair.guide_phrase(repair.spaced_numbers(given)).collect()}
    assert both[7].text == "下列文件对于本文件的应用，见 GB/T 20001。" and both[7].issue == "CSM-OCR-003,CSM-OCR-011"
    assert {r.pos: r.text for r in repair.bracketed_entries(given).collect()}[8].startswith("[1] GB/T 755")
    again = repair.spaced_numbers(repair.spaced_numbers(given).drop("issue"))
    assert again.filter("issue IS NOT NULL").count() == 0


def test_numbers_walked_in_order(spark):
    given = rows(spark, *(("heading", 2, n, "t", "x") for n in ("4", "4.1", "4.2", "421", "4.2.2", "43", "5", "12")))
    got = [r.number for r in repair.restored_numbers(given).orderBy("pos").collect()]
    assert got == ["4", "4.1", "4.2", "4.2.1", "4.2.2", "4.3", "5", "12"]


def test_markers_formulas_terms_and_footnotes(spark):
    items = spark.createDataFrame([("d", 1, 0, "-", "symbol"), ("d", 1, 1, "—", "symbol"), ("d", 1, 2, "—", "symbol"), ("d", 2, 0, "-", "symbol"), ("d", 2, 1, "—", "symbol")], "doc_id string, pos int, item int, marker string, marker_kind string")
    assert {(r.pos, r.item): r.marker for r in repair.unified_markers(items).collect()} == {(1, 0): "—", (1, 1): "—", (1, 2): "—", (2, 0): "-", (2, 1): "—"}
    given = rows(spark, ("formula", None, None, None, "$$ x \\tag{1} $$"), ("formula", None, None, None, "$$ y $$\n式（3）"), ("heading", 2, "A", "附", "x"), ("formula", None, None, None, "$$ z \\tag{(A.1)} $$"))
    assert [(r.number, r.expected, r.issue) for r in repair.formula_numbers(given).orderBy("pos").collect()] == [("1", "1", None), ("3", "2", "CSM-OCR-017"), ("A.1", "A.1", None)]
    spaced = rows(spark, ("heading", 2, "3", "术语和定义", "x"), ("paragraph", None, None, None, "叶轮 impeller"), ("heading", 2, "4", "要求", "x"), ("paragraph", None, None, None, "叶轮 impeller"))
    assert [r.text for r in repair.term_spacing(spaced).filter("kind = 'paragraph'").orderBy("pos").collect()] == ["叶轮　impeller", "叶轮 impeller"]
    defs = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", "c")], "doc_id string, label string")
    cites = spark.createDataFrame([("d", "a", 5), ("d", "b", 6), ("d", "b", 7)], "doc_id string, label string, pos int")
    assert {r.label: (r.owner_pos, r.issue) for r in repair.bound_footnotes(defs, cites).collect()} == {"a": (5, None), "b": (None, "CSM-STRUCT-008"), "c": (None, "CSM-STRUCT-009")}


@pytest.mark.parametrize(
    ("text", "want"),
    [("温度,压力", "温度，压力"), ("见(表1)和(a)", "见（表1）和（a）"), ("a, b (c)", "a, b (c)"), ("见表,5处", "见表，5处"), ("值:5", "值：5"), ("甲, 乙", "甲， 乙"), ("f(x中y)", "f（x中y）"), ("a(中)b", "a(中)b"), ("`甲,乙`", "`甲，乙`"), ("(见8.4);乙", "（见8.4）；乙"), ("公式 $a, b$ 后,完.", "公式 $a, b$ 后，完。"), ("（半开)", "（半开）"), ("1:2 比例:三", "1:2 比例：三"), ("<!-- 甲, 乙 -->", "<!-- 甲, 乙 -->")],
)
def test_punctuation(text, want):
    assert repair.wide_punctuation(text) == want == repair.wide_punctuation(want)


def test_punctuation_column(spark):
    got = spark.createDataFrame([("温度,压力",), (None,)], "t string").select(repair.body_punctuation("t").alias("t")).collect()
    assert [r.t for r in got] == ["温度，压力", None]


def test_damage(spark):
    lines = [("d", 3 * i + k, t) for i in range(31) for k, t in enumerate(("4.", "这一行足够长所以上面的编号是孤立的。", ""))] + [("e", 0, "4.1 正常")]
    got = {r.doc_id: r.damaged for r in repair.damaged_text_layers(spark.createDataFrame(lines, "doc_id string, pos int, line string")).collect()}
    assert got == {"d": True, "e": False}
