"""Stored tables, rule files and recovery operators where a query can't reach."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sheaf.functions import citations
from sheaf.operators import alignment, checks, patterns, repair, rulepacks, validation
from sheaf.plans.asked import PACKS
from sheaf.sources import sinks


def test_stored_tables(spark, tmp_path):
    out, schema = str(tmp_path / "t"), "doc_id string, v int"
    sinks.remove(spark.createDataFrame([("a",)], "doc_id string"), out)
    sinks.upsert(spark.createDataFrame([(f"d{i}", i) for i in range(200)] + [("d1", -1)], schema), out)
    sinks.upsert(spark.createDataFrame([("d1", 7), ("new", 1)], schema), out)
    got = sorted(map(tuple, sinks.stored(spark, out).collect()))
    assert len(got) == 201 and ("d1", 7) in got and ("new", 1) in got and ("d1", 1) not in got
    assert len(list((tmp_path / "t").glob("bucket=*"))) <= sinks.BUCKETS
    sinks.remove(spark.createDataFrame([(f"d{i}",) for i in range(200)] + [("none",)], "doc_id string"), out)
    assert list(map(tuple, sinks.stored(spark, out).collect())) == [("new", 1)]
    sinks.clear(spark, out)
    assert not (tmp_path / "t").exists()


def test_rule_files(spark, tmp_path):
    (tmp_path / "base").mkdir()
    for i, pack in enumerate(PACKS):
        (tmp_path / "base" / f"{i}.yaml").write_text(pack)
    rules = rulepacks.read_packs(spark, str(tmp_path))
    assert {r["fault"] for r in rules.collect()} == {None, "no rule pack", "no id or operator"}
    base, profile = (rulepacks.layered(rules, order).filter("rule_id = 'R16'").first() for order in (["profile", "base"], ["base", "profile"]))
    assert (base["operator"], base["severity"]) == ("unheard_of", "warning") and profile["severity"] == "must"
    assert rulepacks.layered(rules, []).count() == 18


def test_row_matches(spark):
    rows = spark.createDataFrame([(d, i, c) for d, text in ((1, "xabbyab"), (2, "zz"), (3, "abb")) for i, c in enumerate(text)], "doc_id int, pos int, c string")
    got = patterns.row_matches(rows, F.col("c"), "ab+").orderBy("doc_id", "pos").collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append((r["match"], r["place"]))
    runs = {d: [[p for m, p in own if m == k] for k in sorted({m for m, _ in own if m})] for d, own in found.items()}
    assert runs == {1: [[0, 1, 2], [0, 1]], 2: [], 3: [[0, 1, 2]]}


def test_rebuilt_lists_stay(spark):
    given = [(1, 0, "paragraph", "内容："), (1, 1, "paragraph", "甲；"), (1, 2, "list", "— 乙。")]
    once = patterns.colon_lists(spark.createDataFrame(given, "doc_id long, pos int, kind string, text string"))
    line = F.concat_ws(" ", "marker", "text")
    blocks = once.groupBy("doc_id", "pos", "kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item", line.alias("t")))), lambda s: s["t"]), "\n").alias("text"))
    twice = patterns.colon_lists(blocks)
    assert sorted(map(tuple, twice.drop("issue").collect())) == sorted(map(tuple, once.drop("issue").collect()))
    assert twice.filter("issue IS NOT NULL").count() == 0


def test_restored_ellipses_stay(spark):
    lines = spark.createDataFrame([(1, 0, "1 a"), (1, 1, "2 b")], "doc_id long, pos int, line string")
    layer = spark.createDataFrame([(1, 1, 0, 1.0, 10.0, "…"), (1, 1, 1, 1.0, 90.0, "2 b")], "doc_id long, page int, line_no int, x0 double, y0 double, text string")
    once = alignment.restored_ellipses(lines, layer)
    assert [r["line"] for r in once.orderBy("pos").collect()] == ["1 a", "……", "2 b"]
    assert alignment.restored_ellipses(once.drop("restored"), layer).filter("restored").count() == 0


@pytest.mark.parametrize(("last", "digits", "want"), [((7, 4, 2), "7421", (7, 4, 2, 1)), ((4, 1, 9), "4110", (4, 1, 10)), ((5, 2, 3), "53", (5, 3)), ((9,), "10", (10,))])
def test_readings(last, digits, want):
    assert next(r for r in repair._readings(digits) if repair._continues(r, last)) == want


def test_schema_places():
    schema = {"$ref": "#/definitions/a", "definitions": {"a": {"properties": {"x/y": {"$ref": "#/definitions/a"}}, "additionalProperties": {"type": ["string", "null"]}}}}
    rows = {r[0]: r for r in validation.compiled(schema)}
    assert rows["#/definitions/a"][3] == {"x/y": "#/definitions/a"} and rows["#/definitions/a/additionalProperties"][1] == ["string", "null"]


def test_numbers_of_paths_by_parts(spark):
    rows = spark.createDataFrame([(i, "p" if i % 3 else ("q" if i % 2 else None)) for i in range(500)], "doc_id int, path string")
    whole = checks.suffixed_ids(rows, "path", "doc_id")
    parts = checks.suffixed_ids(rows, "path", "doc_id", part=F.floor(F.col("doc_id") / 64))
    assert parts.columns == whole.columns and sorted(map(tuple, parts.fillna("").collect())) == sorted(map(tuple, whole.fillna("").collect()))


def test_wide_gaps(spark):
    rows = spark.createDataFrame([(1, 1), (1, 3), (1, 200_000), (2, 5), (3, None)], "g int, n int")
    got = checks.numbering_gaps(rows, "g", "n").agg(F.count("*"), F.min("missing"), F.max("missing"), F.countDistinct("missing")).first()
    assert tuple(got) == (199_997, 2, 199_999, 199_997)


def test_matches_of_long_texts(spark):
    import re

    text = "。".join(f"见 GB/T {i} 和 GB {i}" for i in range(600)) + "末尾" * 5000
    got = spark.createDataFrame([(text,), ("无",), (None,)], "text string").select(citations.matches(F.col("text"), "GB(?:/T)? [0-9]+").alias("m")).collect()
    assert got[1]["m"] is None and got[2]["m"] is None
    want = list(re.finditer("GB(?:/T)? [0-9]+", text))
    assert [(r["start"], r["hit"]) for r in got[0]["m"]] == [(m.start(), m[0]) for m in want]
    for r, m in zip(got[0]["m"], want, strict=True):
        assert text[: m.start()].endswith(r["before"]) and text[m.end() :].startswith(r["after"])
        assert r["before"].split("。")[-1] == text[: m.start()].split("。")[-1] and r["after"].split("。")[0] == text[m.end() :].split("。")[0]
    assert max(len(r["before"]) for r in got[0]["m"]) < 100
