"""A small corpus from files to tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaf import service

ONE = """---
title: 风机试验方法
standard-number: GB/T 100—2030
---
# 风机试验方法

## 前言

说明。

## 1 范围

适用,见表1。

## 2 规范性引用文件

下列文件适用：

GB/T 755 电机

GB/T 900 另一个

## 3 要求

应符合 GB/T755 的规定。应符合 ISO 9001 的规定。

**表1 尺寸**
| 甲 | 乙 |
| --- | --- |
| 1 | 2 |

### 3.2 噪声

正文。
"""


def test_corpus(spark, tmp_path):
    files = spark.createDataFrame([("a", ONE.encode()), ("b", b"\xff\xfe\xfa"), ("c", b"")], "doc_id string, content binary")
    corpus = service.parse(files)
    assert [r.doc_id for r in corpus.rejected.collect()] == ["b"]
    found = {(r.rule_id, r.subject) for r in corpus.findings().filter("doc_id = 'a'").collect()}
    assert ("GBT-C06", "GB_T_900") in found and ("GBT-C06", "ISO_9001") in found and ("GBT-C06", "GB_T_755") not in found
    assert ("GBT-C01", "ics") in found and not any(r in ("GBT-X01", "GBT-N01", "GBT-N02", "GBT-E03", "GBT-E05") for r, _ in found)
    nodes, edges = corpus.graph()
    kinds = {r.kind: r["count"] for r in nodes.filter(F.col("id").startswith("a")).groupBy("kind").count().collect()}
    assert kinds["document"] == 1 and kinds["section"] == 3 and kinds["clause"] == 1
    ids = {r.id for r in nodes.collect()}
    assert all(r.source in ids and r.target in ids for r in edges.collect())
    one = corpus.catalogue().filter("doc_id = 'a'").first()
    assert one.standard_id == "GB_T_100-2030" and one.kind == "方法标准" and one.node_count == 5
    assert {r.number: len(r.path) for r in corpus.structure().filter("number IS NOT NULL").collect()} == {"1": 1, "2": 1, "3": 1, "3.2": 2}
    assert corpus.blocks.filter(F.col("text").contains("适用，见表1。")).count() == 1
    service.write(corpus, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "html")).filter("doc_id = 'a'").first().html.startswith("<h2>")


def test_replay(spark):
    docs = spark.createDataFrame([("a", "x\ny"), ("b", "z")], "doc_id string, text string")
    got = service.replay(docs, lambda d: d.withColumn("text", F.replace("text", F.lit("y"), F.lit("w")))).collect()
    assert [(r.doc_id, r.removed, r.added) for r in got] == [("a", ["y"], ["w"])]
