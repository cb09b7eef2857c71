"""Nested JSON documents as flat tables."""

from __future__ import annotations

import json

from sheaf.sources import structured


def test_structured(spark, tmp_path):
    node = lambda i, *children, **more: {"id": i, "nodeType": "clause", "children": list(children), **more}
    doc = {"id": "D", "metadata": {"title": "t"}, "structuralRoot": node("r", node("a", node("a1", contentElements=[{"id": "c", "presentationType": "paragraph", "textContent": "x"}])), node("b", number="2"))}
    (tmp_path / "one.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "bad.json").write_text("{not json")
    good, bad = structured.read_structured(spark, str(tmp_path), 3)
    assert good.count() == 1 and bad.count() == 1
    nodes = structured.structure(good, 3)
    assert {(r.node_id, r.parent_id, r.depth) for r in nodes.collect()} == {("a", "r", 1), ("b", "r", 1), ("a1", "a", 2)}
    assert [(r.parent_id, r.text) for r in structured.contents(nodes).collect()] == [("a1", "x")]
    files = spark.createDataFrame([("a", "h", False), ("b", "i", True), ("c", "j", False)], "doc_id string, sha256 string, fatal boolean")
    found = spark.createDataFrame([("a", "X")], "doc_id string, code string")
    assert {r.doc_id: r.status for r in structured.runs(files, found).collect()} == {"a": "partial", "b": "failed", "c": "complete"}
