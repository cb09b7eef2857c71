"""Column functions against tables of values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sheaf.functions import citations, naming, titles


def values(spark, column, *inputs):
    rows = spark.createDataFrame([(i, *x) if isinstance(x, tuple) else (i, x) for i, x in enumerate(inputs)], ["i", *"abc"[: len(inputs[0]) if isinstance(inputs[0], tuple) else 1]])
    return [r.v for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_names(spark):
    a, b = F.col("a"), F.col("b")
    assert values(spark, naming.file_stem(a), "GB/T 15034-2012", "GB 15034—2012", "DB11/T 1000-2020", "Q/XKBZ 002-2026", "T/CAS 501-2021", "none", "") == ["GB_T_15034-2012", "GB_15034-2012", "DB11_T_1000-2020", "Q_XKBZ_002-2026", "T_CAS_501-2021", "", ""]
    assert values(spark, naming.escaped_number(a), "GB/T 1.1—2020", "ISO 80000-1:2022", "GB/T 4208一2017", "IEC 60027") == ["GB_T_1.1-2020", "ISO_80000-1_2022", "GB_T_4208-2017", "IEC_60027"]
    assert values(spark, naming.number_in_text(a), "见 GB/T 15034—2012 的规定", "nothing here") == ["GB/T 15034-2012", ""]
    assert values(spark, naming.artifact_id(a), "x/GB_T_1.1-2020.canonical.md", "GB_T_2-2001.render-report.json", "plain.txt", "none") == ["GB_T_1.1-2020", "GB_T_2-2001", "plain", "none"]
    assert values(spark, naming.element_id(a, b), ("S", "#8.2"), ("S#", "8"), ("S", "8 2"), ("", "8")) == ["S#8.2", None, None, None]
    assert values(spark, naming.id_parts(a), "S#8.2", "bad") == [("S", "8.2"), (None, None)]
    assert values(spark, naming.element_path(a, b), ("table", "3)"), ("Figure", "A.1"), ("table", "。"), ("odd", "1")) == ["Table_3", "Figure_A.1", None, None]
    assert values(spark, naming.annex_path(a, b), ("附录A", "A.2.1"), ("b", "2.1"), ("C", "C"), ("1", "")) == ["Annex_A.2.1", "Annex_B.2.1", "Annex_C", None]
    assert values(spark, naming.clause_path(a, F.array(F.lit("a)"), F.lit("1）"))), "8.2.1", "") == ["8.2.1_a_1", None]
    assert values(spark, naming.owned_id(a, F.lit("note"), b), ("S#8", "a"), ("S#8", " ")) == ["S#8.Note_a", None]
    assert values(spark, naming.local_id(a, F.lit("paragraph"), F.lit(3)), "S#8") == ["S#8/Paragraph-003"]
    assert values(spark, naming.concept_id(a), "rotor speed", "转速") == ["CONCEPT_ROTOR_SPEED", None]
    assert values(spark, naming.variable_id(a), "\\overline{\\eta}", "x_n^e", "S_{ME,i}", "$$") == ["VAR_ETA_OVERLINE", "VAR_X_SUB_N_SUP_E", "VAR_S_SUB_ME_I", None]


@pytest.mark.parametrize(
    ("title", "kind", "fits"),
    [("电机试验方法", "方法标准", True), ("电机试验方法应用导则", "指南标准", True), ("电机术语", "术语标准", True), ("型号编制", "分类标准", True), ("泵安全要求", "安全标准", True), ("泵通用技术条件", "产品标准", True), ("泵", "其他标准", True)],
)
def test_kinds(spark, title, kind, fits):
    assert values(spark, titles.kind_of(F.col("a"))["kind"], title) == [kind]
    assert values(spark, titles.fits_kind(F.col("a"), F.lit(kind)), title) == [fits]


def test_subjects(spark):
    lexicon = spark.createDataFrame([("电机",), ("旋转电机",), ("泵",)], ["word"])
    named = spark.createDataFrame([(1, "船用旋转电机规范"), (2, "泵通则"), (3, "其他")], ["id", "title"])
    got = {r.id: (r.subject, r.remainder) for r in titles.subjects(named, lexicon, "id").collect()}
    assert got == {1: ("旋转电机", "船用规范"), 2: ("泵", "通则"), 3: (None, None)}
    assert values(spark, titles.place_of_use(F.col("a")), "船用旋转电机", "通用规范", "纺织专用电机") == ["船用", None, "纺织用"]


def carriers(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, text string, presentation string, clause_number string, clause_title string, example boolean, guide boolean")


def test_external_citations(spark):
    rows = carriers(
        spark,
        ("应符合 GB/T 755—2019 的规定。参见 GB/T 1.1—2020,5.2。", "paragraph", "5", "要求", False, False),
        ("GB/T 2900.25 电工术语（所有部分）", "paragraph", "2", "规范性引用文件", False, False),
        ("按 GB/T 1032—2012 中 5.2 规定进行", "paragraph", "6", "试验", False, False),
        ("详见ISO 9001", "note", "6", "试验", False, False),
        ("（见 GB/T 7714、ISO 690）应注意", "paragraph", "6", "试验", False, False),
        ("宜采用 GB 100—2001,1987", "paragraph", "6", "试验", False, True),
        ("采用 GB 100 表 3", "paragraph", "6", "试验", False, False),
    )
    got = [(r.id, r.standard_id, r.version, r.cited_part, r.kind, r.nature) for r in citations.external(rows, ["id"]).orderBy("id", "match_no").collect()]
    assert got[0] == (0, "GB_T_755", "2019", None, "dated", "normative")
    assert got[1] == (0, "GB_T_1.1", "2020", "5.2", "dated", "informative")
    assert got[2][1:] == ("GB_T_2900.25", None, None, "allParts", "normative") or got[2][5] == "normative"
    assert got[3] == (2, "GB_T_1032", "2012", "5.2", "dated", "normative")
    assert [g[5] for g in got if g[0] in (3, 4)] == ["informative"] * 3
    assert [g[2:] for g in got if g[0] == 5] == [("2001", None, "dated", "normative")]
    assert [g[3] for g in got if g[0] == 6] == ["表3"]


def test_internal_mentions(spark):
    rows = carriers(spark, ("见表 3 和图B1，按式（2），按5.2的规定，表面光滑", "paragraph", "5", "t", False, False))
    got = {(r.target_type, r.number) for r in citations.internal(rows, ["id"]).collect()}
    assert got == {("internalTable", "3"), ("internalFigure", "B1"), ("internalFormula", "2"), ("internalClause", "5.2")}


def test_same_file(spark):
    assert len(set(values(spark, citations.same_file_key(F.col("a")), "GB/T 2423.3—2006", "GBT2423.3-2006", "GB_T_2423.32006"))) == 1


def test_part_that_looks_like_a_year(spark):
    got = values(spark, citations.same_file_key(F.col("a")), "GB/T 2.12001", "GB/T 2.1—2001", "GB_T_2.12001", "GB 7552008")
    assert got == ["GBT2.12001", "GBT2.1", "GBT2.1", "GB755"]
