"""Markdown documents of our own through segmentation, tree, rules and projections."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sheaf.functions import citations
from sheaf.operators import checks, graph, joins, lines, markdown, rules, tree
from sheaf.sources import html, layout, sinks
from sheaf.sources import markdown as source

TEXT = """---
title: 小型风机规范
standard-number: GB/T 99999—2030
nested:
  a: 1
---
# 小型风机规范

## 目次
前言……1
1 范围……2

## 前言

本文件由风机小组提出。

## 1 范围

本文件规定了小型风机。
第二行。

## 2 规范性引用文件

GB/T 755 旋转电机

## 4 要求

悬置段。

### 4.1 外观

见表1。温升不大于 80 K，质量不超过 5。

- 甲
- 乙

a) 一
c) 三

单位为mm
**表1 尺寸**
| 名称 | 值 |
| --- | --- |
| 高\\|宽 | 3 |
| 短 |

### 4.3 噪声

$$
x = 1
$$

> 注：正常。

> 备注没有引导语

```
code # not heading

still code
```

## 附录 A 资料

### A.1 甲
## 附录 C 其他
"""


@pytest.fixture(scope="module")
def docs(spark):
    made = source.with_front_matter(spark.createDataFrame([("d1", TEXT), ("d2", "")], "doc_id string, text string"))
    return made.cache()


@pytest.fixture(scope="module")
def blocks(docs):
    return markdown.blocks(docs.select("doc_id", F.col("body").alias("text"))).cache()


@pytest.fixture(scope="module")
def nodes(blocks):
    return markdown.sections(blocks).cache()


def test_front_matter(docs):
    r = docs.filter("doc_id = 'd1'").first()
    assert r.meta["title"] == "小型风机规范" and r.meta["nested.a"] == "1" and r.body_line == 7 and r.body.startswith("# 小型")
    filled = source.completed(docs).filter("doc_id = 'd1'").first()
    assert filled.meta["language"] == "zh-CN" and "title" not in filled.filled and "csm-version" in filled.filled


def test_decoding(spark):
    raw = spark.createDataFrame([("a", "﻿x\r\ny\rz".encode()), ("b", b"\xff\xfe\x00"), ("c", b"plain")], "doc_id string, content binary")
    got = {r.doc_id: r for r in source.decoded(raw).collect()}
    assert got["a"].text == "x\ny\nz" and got["a"].issues == ["CSM-ENC-001", "CSM-ENC-002"] and got["b"].fatal and got["b"].text is None and got["c"].issues == []


def test_blocks(blocks):
    got = [(r.kind, r.number, r.title) for r in blocks.filter("doc_id = 'd1'").orderBy("pos").collect()]
    kinds = [k for k, _, _ in got]
    assert kinds.count("heading") == 11 and kinds.count("table") == 1 and kinds.count("formula") == 1 and kinds.count("code") == 1
    assert kinds.count("list") == 1 and kinds.count("note") == 1 and kinds.count("quote") == 1 and kinds.count("unit") == 1
    assert ("heading", "4.1", "外观") in got and ("heading", "A", "资料") in got and ("heading", "A.1", "甲") in got
    texts = [r.text for r in blocks.filter("kind = 'paragraph'").collect()]
    assert "本文件规定了小型风机。\n第二行。" in texts and not any("……" in t for t in texts)


def test_tables_and_lists(blocks):
    grid = markdown.cells(blocks)
    assert {(r.row, r.col): r.cell for r in grid.collect()} == {(0, 0): "名称", (0, 1): "值", (1, 0): "高|宽", (1, 1): "3", (2, 0): "短"}
    full = {(r.row, r.col): (r.cell, r.too_long) for r in markdown.padded(grid).collect()}
    assert full[2, 1] == ("", False) and len(full) == 6
    table = markdown.folded_units(blocks).filter("kind = 'table'").first()
    assert table.unit == "mm" and table.caption == "表1 尺寸"
    assert [(r.marker, r.marker_kind, r.text) for r in markdown.items(blocks).orderBy("item").collect() if r.text] == [("-", "symbol", "甲"), ("-", "symbol", "乙"), ("a）", "letter", "一"), ("c）", "letter", "三")]


def test_tree(nodes):
    by = {r.pos: r for r in nodes.filter("doc_id = 'd1'").collect()}
    number = {r.number: r for r in by.values() if r.kind == "heading" and r.number}
    assert number["4.1"].parent_pos == number["4"].pos and number["A.1"].parent_pos == number["A"].pos
    assert number["1"].parent_pos is None and number["A"].node_type == "annex" and number["4.3"].node_type == "clause"
    formula = next(r for r in by.values() if r.kind == "formula")
    assert formula.parent_pos == number["4.3"].pos


def test_rules(nodes, blocks, docs):
    found = rules.verdicts(
        rules.cover_fields(docs), rules.element_order(nodes), rules.annex_letters(nodes), rules.numbering(nodes), rules.hanging_paragraphs(nodes), rules.limits_without_unit(blocks),
        rules.note_leads(blocks), rules.confusable_numbers(nodes), rules.sibling_titles(nodes),
        rules.list_numbering(markdown.items(blocks).filter("marker_kind = 'letter'")),
    )
    got = {(r.rule_id, r.subject, r.status) for r in found.filter("doc_id = 'd1'").collect()}
    assert ("GBT-H03", "3", "fail") in got and ("GBT-H03", "4.2", "fail") in got and ("GBT-C15", "B", "fail") in got
    assert ("GBT-C01", "ics", "fail") in got and ("GBT-C01", "title", "fail") not in got
    assert ("GBT-P10-R02", "limits", "warning") in got and not any(r == "GBT-X03" for r, _, _ in got) and any(r == "GBT-H05" for r, _, _ in got)
    assert any(r == "GBT-C14" for r, _, _ in got) and not any(r in ("GBT-E03", "GBT-E05", "GBT-C05", "GBT-C16", "GBT-H04") for r, _, _ in got)


def test_declared_checks(nodes, blocks, docs):
    mentions = citations.internal(blocks.filter("kind = 'paragraph'"), ["doc_id"])
    tables = markdown.folded_units(blocks).filter("kind = 'table'").select("doc_id", F.regexp_extract("caption", "表([^ ]+)", 1).alias("number"))
    given = {"documents": docs, "nodes": nodes.filter("node_type IS NOT NULL"), "blocks": blocks, "mentions": mentions, "tables": tables}
    got = {(r.doc_id, r.check_id): r.state for r in rules.audited(given, [
        {"id": "t", "operator": "non_empty", "target": "title"},
        {"id": "n", "operator": "equals", "target": "nested.a", "expected": "1"},
        {"id": "s", "operator": "contains_node_title", "expected": "范围"},
        {"id": "any", "operator": "contains_node_title_any", "expected": ["没有", "要求"]},
        {"id": "f", "operator": "first_numbered_node_equals", "expected": "1"},
        {"id": "c", "operator": "sibling_numbers_contiguous", "severity": "should"},
        {"id": "p", "operator": "clause_parent_exists"},
        {"id": "r", "operator": "table_references_resolve"},
        {"id": "g", "operator": "figure_references_resolve"},
        {"id": "a", "operator": "each_has_source_anchor"},
        {"id": "u", "operator": "unheard_of"},
        {"id": "x", "operator": "annex_kind_declared", "applies": F.col("doc_id") == "d2"},
        {"id": "q", "operator": "quantitative_requirements_have_test_methods"},
        {"id": "m", "operator": "numeric_requirements_carry_units"},
    ]).collect()}
    assert [got["d1", k] for k in "tnsfcprgauxqm"] == ["pass", "pass", "pass", "pass", "warning", "pass", "pass", "unresolved", "pass", "unresolved", "not-applicable", "fail", "fail"]
    assert got["d1", "any"] == "pass" and got["d2", "t"] == "fail"


def test_projections(blocks, nodes, spark):
    text = sinks.plain_markdown(blocks).filter("doc_id = 'd1'").first().markdown
    assert "### 4 要求" in text and "#### 4.1 外观" in text and "ssir" not in text
    page = sinks.html(blocks).filter("doc_id = 'd1'").first().html
    assert "<h3>4 要求</h3>" in page and "<p>悬置段。</p>" in page
    once = markdown.canonical(blocks)
    twice = markdown.canonical(markdown.blocks(once))
    assert [r.text for r in once.collect()] == [r.text for r in twice.collect()]
    given = spark.createDataFrame([("S#1", None, "section", 'a "b"'), ("S#1.1", "S#1", "clause", None)], "element_id string, parent_id string, node_type string, title string")
    assert sinks.turtle(sinks.triples(given)).count() == 4
    assert [r.json for r in sinks.sorted_json(given.select("title", "element_id")).collect()][1] == '{"element_id":"S#1.1","title":null}'


def test_upsert(spark, tmp_path):
    out = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "doc_id string, v int"), out)
    sinks.upsert(spark.createDataFrame([("a", 2)], "doc_id string, v int"), out)
    assert sorted((r.doc_id, r.v) for r in spark.read.parquet(out).collect()) == [("a", 2), ("b", 1)]


def test_streamed_batches_equal_one_batch(spark, tmp_path):
    from sheaf.streaming import ingest

    for i in range(4):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.md").write_text(f"# t{i}\n\n## 1 a\n\ntext {i}\n")
    query = ingest.into_table(ingest.read_texts(spark, str(tmp_path / "in"), 2), lambda d: markdown.blocks(d.select("doc_id", "text")).select("doc_id", "pos", "kind", "text"), str(tmp_path / "out"), str(tmp_path / "mark"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    whole = markdown.blocks(spark.read.text(str(tmp_path / "in"), wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text")))
    assert sorted((r.pos, r.kind, r.text) for r in got.collect()) == sorted((r.pos, r.kind, r.text) for r in whole.collect())


def test_html_tables(spark):
    pages = spark.createDataFrame([(1, "<p>x</p><table><tr><td rowspan=2>a</td><td colspan=2>b &amp; c</td></tr><tr><td>-</td><td>e</td></tr><tr><td>f</td><td>g</td><td></td></tr></table>"), (2, "none"), (3, None)], "page_id int, html string")
    got = {(r.row, r.col): (r.cell, r.rowspan, r.colspan, r.is_header) for r in html.table_cells(pages, "page_id").collect()}
    assert got == {(0, 0): ("a", 2, 1, True), (0, 1): ("b & c", 1, 2, True), (1, 1): ("—", 1, 1, True), (1, 2): ("e", 1, 1, True), (2, 0): ("f", 1, 1, False), (2, 1): ("g", 1, 1, False), (2, 2): ("", 1, 1, False)}
    assert html.header_rows(html.table_cells(pages, "page_id"), ["page_id", "table_no"]).first().header_rows == 2
    assert "<th rowspan=\"2\">a</th>" in sinks.table_html(html.table_cells(pages, "page_id"), ["page_id", "table_no"]).first().html


def test_restored_markers(spark):
    cells = spark.createDataFrame([(1, 0, 0, "额定电压"), (1, 0, 1, "电压"), (1, 1, 0, "a 额定电压为有效值")], "t int, row int, col int, cell string")
    assert {(r.row, r.col): r.cell for r in html.restored_markers(cells, ["t"]).collect()}[0, 0] == "额定电压a"


def test_layout(spark):
    line = lambda t: [{"bbox": [0.0, 0.0, 1.0, 1.0], "spans": [{"type": "text", "content": c} for c in t]}]
    figure = lambda x0, x1, asset: {"type": "image", "bbox": [x0, 0.0, x1, 100.0], "blocks": [{"type": "image_body", "bbox": [x0, 0.0, x1, 100.0], "lines": [{"bbox": [], "spans": [{"type": "image", "image_path": asset}]}]}, {"type": "image_caption", "bbox": [110.0, 80.0, 190.0, 105.0], "lines": line(["图 ", asset])}]}
    page = {"page_idx": 1, "para_blocks": [{"type": "title", "bbox": [], "lines": line(["范围"])}, {"type": "text", "bbox": [], "lines": line(["see", "the"])}, {"type": "text", "bbox": [], "merge_prev": True, "lines": line(["文件"])}, {"type": "odd", "bbox": []}, figure(0.0, 95.0, "p1"), figure(100.0, 200.0, "p2")]}
    first = {"page_idx": 0, "para_blocks": [], "discarded_blocks": [{"type": "header", "bbox": [], "lines": line(["ICS 29.160"])}, {"type": "header", "bbox": [], "lines": line(["K 20"])}]}
    docs = spark.createDataFrame([("d", [first, page])], "doc_id string, " + layout.SCHEMA)
    blocks = layout.page_blocks(docs)
    assert [r.text for r in layout.paragraphs(blocks).orderBy("page", "block").collect()] == ["## 范围", "see the文件"]
    assert blocks.filter("unknown").count() == 1
    assert {(r.text, r.figure_asset) for r in layout.captioned_figures(blocks).collect()} == {("图 p1", "p2"), ("图 p2", "p2")}
    assert {(r.asset, r.height) for r in layout.figure_sizes(blocks).collect()} == {("p1", 100.0), ("p2", 80.0)}
    assert layout.cover_hints(docs).first().asDict() == {"doc_id": "d", "ics": "29.160", "ccs": "K 20"}


def test_lines_and_spans(spark):
    docs = spark.createDataFrame([(1, "a\r\nb\x0bc\n"), (2, ""), (3, None), (4, "x")], "doc_id int, text string")
    assert [(r.doc_id, r.pos, r.line) for r in lines.lines(docs).orderBy("doc_id", "pos").collect()] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (4, 0, "x")]
    rows = spark.createDataFrame([(1, i, k) for i, k in enumerate("a[b[c]d[|e|f]g")], "doc_id int, pos int, k string")
    k = F.col("k")
    inside = [r.k for r in lines.spans_between(rows, k == "[", k == "]").filter("inside").orderBy("pos").collect()]
    assert inside == ["b", "c", "|", "e", "|", "f"]
    grouped = {r.k: (r.group_no, r.column_no) for r in lines.groups_within(rows, k == "[", k == "|", k == "]").collect() if r.k in "aef"}
    assert grouped["a"] == (None, None) and grouped["e"][1] == 1 and grouped["f"][1] == 2
    target = lines.next_matching(rows, F.col("k"), k.isin("d", "g")).filter("pos = 0").first().target
    assert target == "d" and lines.last_matching(rows, k, k == "a").filter("pos = 5").first().owner == "a"


def test_list_groups_and_majority(spark):
    rows = spark.createDataFrame([(1, 0, "paragraph", "如下："), (1, 1, "list", "甲；"), (1, 2, "list", "乙；"), (1, 3, "paragraph", "x"), (1, 4, "list", "丙。")], "doc_id int, pos int, kind string, text string")
    assert [(r.first_pos, r.n_items, r.intro_pos, r.terminator) for r in lines.list_groups(rows).orderBy("first_pos").collect()] == [(1, 2, 0, "；"), (4, 1, None, "。")]
    tie = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (2, "b")], "g int, v string")
    assert {r.g: r.majority for r in lines.majority(tie, "g", "v").collect()} == {1: None, 2: "a"}


def test_tree_functions(spark):
    import random

    rng = random.Random(5)
    rows = [(d, i, rng.choice([1, 2, 3, 4, None])) for d in range(20) for i in range(40)]
    got = {(r.doc_id, r.pos): r.parent_pos for r in tree.parents(spark.createDataFrame(rows, "doc_id int, pos int, depth int"), "depth").collect()}
    stack: list = []
    for d, i, k in rows:
        if i == 0:
            stack = []
        if k is None:
            assert got[d, i] == max((p for p, _ in stack), default=None)
            continue
        while stack and stack[-1][1] >= k:
            stack.pop()
        assert got[d, i] == (stack[-1][0] if stack else None)
        stack.append((i, k))
    loop = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "id string, up string")
    paths = {r.id: r.path for r in tree.paths(loop, "id", "up", deepest=5).collect()}
    assert paths["c"] == ["a", "b", "c"] and paths["x"] is None
    seeds = spark.createDataFrame([(1, "3.1.1")], "doc_id int, number string")
    found = spark.createDataFrame([(1, n) for n in ("3.2", "3.1.2", "3.2.1", "5.2")], "doc_id int, number string")
    assert {r.number for r in tree.promoted(seeds, found).collect()} == {"3.2", "3.1.2", "3.2.1"}


def test_joins(spark):
    lost = spark.createDataFrame([(1, 0, "温升。"), (1, 1, "噪声,振动"), (1, 9, "远处")], "d int, pos int, t string")
    model = spark.createDataFrame([(1, 0, "噪声，振动"), (1, 2, "温升。"), (1, 30, "远处x")], "d int, pos int, t string")
    got = {r.left_pos: r.right_pos for r in joins.nearest_line(lost, model, "d", "pos", "t").collect()}
    assert got == {0: 2, 1: 0, 9: 2} or got == {0: 2, 1: 0}
    pairs = spark.createDataFrame([("d", 1, 1, 0.1), ("d", 1, 2, 0.2), ("d", 2, 1, 0.15), ("d", 2, 2, 0.3)], "k string, left_id int, right_id int, cost double")
    assert {(r.left_id, r.right_id) for r in joins.greedy_pairs(pairs, "k").collect()} == {(1, 1), (2, 2)}


def test_graph_faults_and_coverage(spark):
    nodes = spark.createDataFrame([("a", "k", None, "t"), ("b", "odd", "a", "t"), ("b", "k", "z", "t")], "id string, kind string, parent string, title string")
    edges = graph.edges_of(nodes)
    assert {r.fault for r in graph.faults(nodes, edges, ["k"], ["HAS_CHILD"]).collect()} == {"unknown kind", "repeated id"}
    assert {r.element: r.present for r in checks.coverage(nodes, "kind", ["k", "none"]).collect()} == {"k": True, "none": False}
