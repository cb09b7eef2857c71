"""Plans that don't grow with the number of checks, parts or rows that a task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions import citations, titles
from sheaf.operators import markdown, repair, rules
from sheaf.plans import standards

SF = "/root/testdata/sf0.001"


def plan(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_checks_share_one_join(spark):
    docs = spark.createDataFrame([("d", {"title": "t"}), ("d", {"title": ""})], "doc_id string, meta map<string,string>")
    nodes = spark.createDataFrame([("d", 1, None, "section", "1", "范围"), ("d", 2, None, "section", "3", "x")], "doc_id string, pos int, parent_pos int, node_type string, number string, title string")
    checks = [{"id": "t", "operator": "non_empty", "target": "title"}, {"id": "n", "operator": "sibling_numbers_contiguous"}, *({"id": f"s{k}", "operator": "contains_node_title", "expected": "范围"} for k in range(5))]
    got = rules.audited({"documents": docs, "nodes": nodes}, checks)
    assert sorted((r.check_id, r.state) for r in got.collect()) == sorted([("t", "pass"), ("t", "fail")] + [("n", "fail")] * 2 + [(f"s{k}", "pass") for k in range(5)] * 2)
    assert plan(got).count("Join ") == 1


def test_sibling_numbers_in_one_pass(spark):
    rows = [("d", 1, None, "section", "4", "a"), ("d", 2, 1, "clause", "4.1", "b"), ("d", 3, 1, "clause", "4.1", "c"), ("d", 4, 1, "clause", "4.1", "d"), ("d", 5, 1, "clause", "4.5", "e"), ("d", 6, 1, "clause", "5.6", "f"), ("d", 7, None, "annex", "B", "g"), ("d", 8, 7, "clause", "4.01", "h")]
    found = rules.numbering(spark.createDataFrame(rows, "doc_id string, pos int, parent_pos int, node_type string, number string, title string"))
    said = [(r.subject, r.message) for r in found.collect()]
    foreign = "number does not continue its parent's"
    assert sorted(said) == sorted([("4.1", "number is repeated"), *((f"4.{k}", "number is skipped") for k in (2, 3, 4)), ("5.6", foreign), ("4.01", foreign)])
    assert plan(found).count("LogicalRDD") == 1


def test_documents_are_dealt_by_orders(spark, monkeypatch):
    monkeypatch.setattr(standards, "ORDERS_A_TASK", 100)
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert standards._documents(spark, SF).rdd.getNumPartitions() == -(-n // 100)


def test_padded_cells_in_one_pass(spark):
    grid = spark.createDataFrame([("d", 1, 0, 0, "a"), ("d", 1, 0, 1, "b"), ("d", 1, 1, 0, "c"), ("d", 1, 2, 2, "x"), ("d", 9, 1, 0, "no first row")], "doc_id string, pos int, row int, col int, cell string")
    got = markdown.padded(grid)
    assert sorted(tuple(r)[2:] for r in got.collect()) == [(0, 0, "a", False), (0, 1, "b", False), (1, 0, "c", False), (1, 1, "", False), (2, 0, "", True), (2, 1, "", True), (2, 2, "x", True)]
    assert plan(got).count("LogicalRDD") == 1


def test_numbers_are_walked_over_batches(spark):
    """Headings of all documents are walked in few Python batches, not a group at a time; a batch may end within a document."""
    rows = [(d, p, "heading", n) for d in range(40) for p, n in enumerate(("4", "4.1", "42", "421"))]
    blocks = spark.createDataFrame(rows, "doc_id int, pos int, kind string, number string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = repair.restored_numbers(blocks)
        assert {(r.pos, r.number) for r in got.collect()} == {(0, "4"), (1, "4.1"), (2, "4.2"), (3, "4.2.1")} and got.count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroups" not in plan(got)


def test_shapes_are_dealt_by_documents(spark, monkeypatch):
    from sheaf.plans import shapes

    monkeypatch.setattr(shapes, "DOCUMENTS_A_TASK", 10)
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert shapes.shaped(spark, SF, "a string", [[("x",)]]).rdd.getNumPartitions() == -(-n // 10)


def test_subjects_by_title(spark):
    """A title that many keys have is looked up once."""
    rows = spark.createDataFrame([(k, "旋转电机要求") for k in range(50)] + [(90, None), (91, "无"), (92, "机")], "k int, title string")
    words = spark.createDataFrame([("电机",), ("旋转电机",), ("机",)], "word string")
    got = titles.subjects(rows, words, "k")
    assert sorted((r.k, r.subject, r.remainder) for r in got.collect()) == [(k, "旋转电机", "要求") for k in range(50)] + [(90, None, None), (91, None, None), (92, "机", "")]
    assert "Aggregate [_t" in plan(got)


def test_matches_read_a_text_once(spark):
    texts = spark.createDataFrame([("见QQ1。按QQ22；￿QQ3",), ("无",), (None,)], "text string")
    got = texts.select(citations.matches(F.col("text"), "QQ[0-9]+").alias("m"))
    rows = [r.m for r in got.collect()]
    assert [[(m.start, m.before, m.hit) for m in r or []] for r in rows] == [[(1, "见", "QQ1"), (6, "见QQ1。按", "QQ22"), (12, "见QQ1。按QQ22；￿", "QQ3")], [], []]
    assert plan(got).count("QQ[0-9]+") == 1


def test_mentions_without_their_lead(spark):
    assert not any(citations.INTERNAL[k].startswith("(?U)(?:") for k in citations.NEEDED)
    rows = spark.createDataFrame([(1, "参见  表 A1-2、图3，见式（2）"), (2, None), (3, "按5.2的规定")], "id int, text string")
    got = {(r.id, r.target_type, r.number) for r in citations.internal(rows, ["id"]).collect()}
    assert got == {(1, "internalTable", "A1-2"), (1, "internalFigure", "3"), (1, "internalFormula", "2"), (3, "internalClause", "5.2")}
