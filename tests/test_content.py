"""Texts with a scan of their own, and content under nodes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sheaf.functions import text
from sheaf.operators import content


@pytest.mark.parametrize(
    ("latex", "want"),
    [("$\\frac{a+b}{c}$", "(a+b)/c"), ("x^{2}_{1}", "x²₁"), ("\\eta \\times \\Delta t", "η × Δ t"), ("\\sqrt{x}", "√(x)"), ("\\mathrm{kW}", "kW"), ("P_{max}", "P_(max)"), ("a \\leq b \\tag{1}", "a ≤ b"), ("\\frac{1}{\\frac{a}{b}}", "1/a/b")],
)
def test_latex(latex, want):
    assert text.readable_latex(latex) == want


def test_every_greek_letter():
    import unicodedata

    for name in text.GREEK:
        written = "lamda" if name == "lambda" else name
        assert text.readable_latex("\\" + name) == unicodedata.lookup(f"GREEK SMALL LETTER {written.upper()}")
        assert text.readable_latex("\\" + name.title()) == unicodedata.lookup(f"GREEK CAPITAL LETTER {written.upper()}")


@pytest.mark.parametrize(("given", "want"), [("*a* **b** ***c***", "<em>a</em> <strong>b</strong> <strong><em>c</em></strong>"), ("2 * 3 * 4", "2 * 3 * 4"), ("*open", "*open"), ("****", "****")])
def test_emphasis(given, want):
    assert text.emphasis_tags(given) == want


def test_split_words():
    known = frozenset({"general", "rules", "rotating", "electrical", "machines", "gene", "ral"})
    assert text.split_words("rotatingmachines", known) == "rotating machines"
    assert text.split_words("generalrules", known) == "general rules" and text.split_words("unknownword", known) == "unknownword"


def test_columns(spark):
    df = spark.createDataFrame([("x^2", "GB/T 1"), (None, "X 1")], "t string, standard_number string")
    assert [r.t for r in df.select(text.latex_text("t").alias("t")).collect()] == ["x²", None]
    assert [r.b for r in df.select(text.banner(F.col("standard_number")).alias("b")).collect()] == ["中华人民共和国国家标准", None]
    docs = spark.createDataFrame([("d", "GB/T 1"), ("e", "GB 1"), ("f", "Z")], "doc_id string, standard_number string")
    table = spark.createDataFrame([("GB", "g"), ("GB/T", "gt")], "prefix string, emblem string")
    assert {r.doc_id: r.emblem for r in text.emblems(docs, table).collect()} == {"d": "gt", "e": "g", "f": None}
    assert text.unglued(spark.createDataFrame([("rotatingmachines: part",)], "t string"), "t", ["rotating", "machines"]).first().t == "rotating machines: part"
    cover = "GB/T 100—2020\n\n# 小型风机\n\nSmall fans for general use\n\n2020-01-02 发布 2020-05-06 实施\n代替 GB/T 100—2010\n风机标准化技术委员会 发布\n## 1 范围\nGB 5—1999\n"
    got = spark.createDataFrame([(cover,)], "t string").select(text.cover_facts(F.col("t")).alias("c")).first().c
    assert got.number == "GB/T 100—2020" and got.title == "小型风机" and got.published == "2020-01-02" and got.effective == "2020-05-06" and got.replaces == "GB/T 100—2010" and got.issuer == "风机标准化技术委员会" and got.title_en == "Small fans for general use"


def blocks(spark, *given):
    return spark.createDataFrame([("d", i, *r) for i, r in enumerate(given)], "doc_id string, pos int, kind string, number string, title string, text string")


def test_footnotes(spark):
    docs = spark.createDataFrame([("d", "x <!-- ssir:foot:a -->甲<!-- ssir:/foot --> y <!-- ssir:foot:b --> 乙 <!-- ssir:/foot -->")], "doc_id string, text string")
    assert [(r.label, r.definition) for r in content.footnotes(docs).orderBy("position").collect()] == [("a", "甲"), ("b", "乙")]
    cites = content.footnote_citations(blocks(spark, ("paragraph", None, None, "x[foot:a、b] y[foot:a]")))
    assert {r.label for r in cites.collect()} == {"a", "b"}
    c = spark.createDataFrame([("d", "n3", "a"), ("d", "n3", "b"), ("d", "n9", "c"), ("d", "n9", "a")], "doc_id string, node string, label string")
    d = spark.createDataFrame([("d", "n1", "a", "far"), ("d", "n2", "a", "near"), ("d", "n3", "b", "own"), ("d", "n7", "c", "only")], "doc_id string, node string, label string, note_id string")
    up = spark.createDataFrame([("d", "n3", "n2", 1), ("d", "n3", "n1", 2)], "doc_id string, node string, ancestor string, distance int")
    got = {(r.node, r.label): r.note_id for r in content.anchored(c, d, up).collect()}
    assert got == {("n3", "a"): "near", ("n3", "b"): "own", ("n9", "c"): "only", ("n9", "a"): None}


def test_variables_and_notes(spark):
    given = blocks(spark, ("paragraph", None, None, "式中："), ("paragraph", None, None, "P--功率"), ("paragraph", None, None, "n——转速;"), ("paragraph", None, None, "后文"), ("paragraph", None, None, "Q--流量"))
    assert [r.text for r in content.formula_variables(given).orderBy("pos").collect()] == ["P——功率；", "n——转速。"]
    table = blocks(spark, ("table", None, None, "| a |\n| --- |\n| 注1：甲 |"), ("paragraph", None, None, "注2：乙"), ("paragraph", None, None, "a) 丙"), ("paragraph", None, None, "正文"), ("paragraph", None, None, "注3：丁"))
    got = {r.pos: r.text for r in content.absorbed_notes(table.withColumn("pos", F.col("pos") + 1)).collect()}
    assert got == {1: "| a |\n| --- |\n| 注1：甲<br>注2：乙<br>a) 丙 |", 4: "正文", 5: "注3：丁"}
    index = blocks(spark, ("heading", None, "A", "# A"), ("heading", None, "索引", "# 索引"), ("heading", None, "B", "# B"), ("paragraph", None, None, "x"))
    assert [r.kind for r in content.demoted_index_letters(index).orderBy("pos").collect()] == ["heading", "heading", "paragraph", "paragraph"]


def test_rules_on_references_and_names(spark):
    nodes = spark.createDataFrame([("d", 1, "2", "section", "引用标准"), ("e", 1, "2", "section", "规范性引用文件")], "doc_id string, pos int, number string, node_type string, title string")
    own = spark.createDataFrame([("d", 2, 1, "list", "1）GB 1"), ("e", 2, 1, "paragraph", "下列文件适用")], "doc_id string, pos int, parent_pos int, kind string, text string")
    assert {(r.doc_id, r.message) for r in content.reference_chapter(nodes, own).collect()} == {("d", "chapter 2 is not the list of references"), ("d", "the list has no lead-in"), ("d", "entries are numbered")}
    meta = spark.createDataFrame([("d", {"title": "风机"}), ("e", {"title": "风机规范"})], "doc_id string, meta map<string,string>")
    assert {(r.doc_id, r.rule_id) for r in content.standard_names(meta).collect()} == {("d", "GBT-N02")}


def test_layout_matches(spark):
    assets = spark.createDataFrame([("d", "p1", 200, 100), ("d", "p2", 410, 200), ("d", "p3", 100, 900)], "doc_id string, asset string, width int, height int")
    boxes = spark.createDataFrame([("d", 1, 100.0, 50.0), ("d", 2, 200.0, 100.0)], "doc_id string, box int, width double, height double")
    got = {r.asset: (r.box, round(r.width, 2)) for r in content.source_sizes(assets, boxes).collect()}
    assert got["p1"] == (1, 100.0) and got["p2"] == (2, 200.0) and got["p3"][0] is None
    around = spark.createDataFrame([("d", 1, i, *b) for i, b in enumerate([(0.0, 0.0, 90.0, 50.0), (100.0, 10.0, 190.0, 60.0), (0.0, 100.0, 190.0, 150.0)])], "doc_id string, page int, id int, x0 double, y0 double, x1 double, y1 double")
    assert {(r.id, r.column) for r in content.side_by_side(around).collect()} == {(0, 1), (1, 2)}
    q = content.quality_status(spark.createDataFrame([("d",), ("e",)], "doc_id string"), spark.createDataFrame([("d", "x")], "doc_id string, code string"), spark.createDataFrame([("e", None)], "doc_id string, asset_ref string"))
    assert {r.doc_id: (r.status, r.figure_confidence) for r in q.collect()} == {"d": ("partial", 1.0), "e": ("complete", 0.5)}
