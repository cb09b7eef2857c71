"""Structure repairs on our own rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaf.operators import structure


def rows(spark, *given):
    return spark.createDataFrame([("d", i, *r) for i, r in enumerate(given)], "doc_id string, pos int, kind string, level int, number string, title string, text string, node_type string, caption string")


def h(level, number, title, node_type=None):
    return ("heading", level, number, title, f"{'#' * level} {number or ''} {title}", node_type, None)


def p(text, kind="paragraph", caption=None):
    return (kind, None, None, None, text, None, caption)


def test_terms(spark):
    given = rows(spark, h(2, "3", "术语和定义"), h(3, "3.1", ""), p("叶轮 impeller"), p("转动。"), p("3.2"), h(3, None, "轮毂 hub"), h(2, "4", "要求"), p("4.1"), p("外观 look"))
    got = [(r.kind, r.number, r.title) for r in structure.merged_terms(given).filter("issue IS NOT NULL").orderBy("pos").collect()]
    assert [g[:2] for g in got] == [("heading", "3.1"), ("heading", "3.2")] and got[0][2] == "叶轮 impeller"
    assert structure.merged_terms(given).count() == 7


def test_examples(spark):
    given = rows(spark, h(2, "4", "要求"), h(3, "4.1", "外观"), h(2, None, "示例1："), p("x"), h(2, None, "小标题"), h(2, "5", "试验"), h(2, None, "其他"))
    got = [(r.kind, r.level, r.issue) for r in structure.nested_examples(given).orderBy("pos").collect()]
    assert got[2] == ("heading", 4, "CSM-OCR-008") and got[4] == ("paragraph", 2, "CSM-OCR-020") and got[6] == ("heading", 2, None)


def test_annex_examples(spark):
    given = rows(spark, h(2, "4", "要求", "section"), h(2, None, "无号"), h(2, "A", "附录", "annex"), h(2, None, "封面"), p("x"), h(2, "A.1", "条", "annexSection"), h(2, None, "参考文献"))
    assert [r.pos for r in structure.annex_examples(given).filter("example_content").orderBy("pos").collect()] == [3, 4]


def test_images(spark):
    given = rows(spark, p("| a | b |\n| --- | --- |\n| 1 |  |", "table", "表1 尺寸"), p("![](i.png)", "image"), p("| a | b |", "table", "表1（续）"), p("![](k.png)", "image"))
    got = [(r.kind, r.text) for r in structure.images_into_tables(given).orderBy("pos").collect()]
    assert got[0] == ("table", "| a | b |\n| --- | --- |\n| 1 | ![](i.png) |") and [k for k, _ in got] == ["table", "table", "image"]
