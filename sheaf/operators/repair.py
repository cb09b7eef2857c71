"""Repairs of blocks and texts; each leaves what is ambiguous and tells what it changed.

A repair returns the rows with the repaired column and an ``issue`` code where
it changed something.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.citations import DESIGNATORS

#: Half-width marks and their full-width forms, brackets in pairs,
#: what is left alone, and what counts as Han text.
WIDE = {",": "，", ";": "；", ":": "：", "?": "？", "!": "！"}
BRACKETS = {"(": "（", ")": "）"}
MASKED = r"\$\$[^$]*\$\$|\$[^$\n]*\$|<!--[^\n]*?-->"
HAN = "　-〿㐀-䶿一-鿿豈-﫿！-｠￠-￦"


def changed(rows: DataFrame, column: str, repaired: Column, code: str) -> DataFrame:
    """rows with a repaired column and the code where it differs from before."""
    held = rows.withColumn("_new", repaired)
    differs = ~F.col("_new").eqNullSafe(F.col(column))
    before = F.col("issue") if "issue" in rows.columns else F.lit(None).cast("string")
    return held.withColumn("issue", F.when(differs, F.concat_ws(",", before, F.lit(code))).otherwise(before)).withColumn(column, F.col("_new")).drop("_new")


def raised_levels(blocks: DataFrame) -> DataFrame:
    """Headings as deep as their number says, never shallower than they were."""
    asked = F.size(F.split("number", r"\.")) + 1
    return changed(blocks, "level", F.when((F.col("kind") == "heading") & F.col("number").rlike(r"^\d+(\.\d+)*$"), F.least(F.greatest("level", asked), F.lit(6))).otherwise(F.col("level")), "CSM-OCR-006")


def demoted_sentences(blocks: DataFrame) -> DataFrame:
    """Numbered headings that end like a sentence become paragraphs."""
    sentence = (F.col("kind") == "heading") & F.col("number").isNotNull() & F.col("title").rlike("[。！？]$")
    return changed(blocks, "kind", F.when(sentence, "paragraph").otherwise(F.col("kind")), "CSM-OCR-009")


def spaced_numbers(blocks: DataFrame, column: str = "text") -> DataFrame:
    """A space between a designator and the number stuck to it."""
    return changed(blocks, column, F.regexp_replace(column, rf"(?<![A-Za-z0-9/])({DESIGNATORS})(?=\d)", "$1 "), "CSM-OCR-003")


def guide_phrase(blocks: DataFrame, column: str = "text") -> DataFrame:
    """The misread first character of the list's lead-in."""
    return changed(blocks, column, F.regexp_replace(column, "^卜列文件对于本文件", "下列文件对于本文件"), "CSM-OCR-011")


def bracketed_entries(blocks: DataFrame, column: str = "text") -> DataFrame:
    """[N] restored before a designator where a bracket was lost."""
    return changed(blocks, column, F.regexp_replace(column, rf"(?m)^(?:\[(\d{{1,3}})|(\d{{1,3}})\]|［(\d{{1,3}})］)\s*(?=(?:{DESIGNATORS})\s*\d)", "[$1$2$3] "), "CSM-OCR-013")


def merged_titles(blocks: DataFrame) -> DataFrame:
    """A first-level heading and the part title right after it become one, up to 60 characters."""
    w = W.partitionBy("doc_id").orderBy("pos")
    part = lambda k, t: (k == "heading") & t.rlike(r"(?U)^第\s*(?:\d+|[一二三四五六七八九十百千]+)\s*部分\s*[:：]")
    after = F.lead(F.struct("kind", "level", "title")).over(w)
    joins_ = (F.col("kind") == "heading") & (F.col("level") == 1) & part(after["kind"], after["title"]) & (after["level"] == 1) & (F.length("title") + F.length(after["title"]) <= 60)
    before = F.lag(F.struct("kind", "level", "title")).over(w)
    gone = part(F.col("kind"), F.col("title")) & (F.col("level") == 1) & (before["kind"] == "heading") & (before["level"] == 1) & (F.length("title") + F.length(before["title"]) <= 60)
    held = blocks.withColumns({"_title": F.when(joins_, F.concat_ws(" ", "title", after["title"])).otherwise(F.col("title")), "_gone": F.coalesce(gone, F.lit(False))})
    return changed(held, "title", F.col("_title"), "CSM-STRUCT-001").filter(~F.col("_gone")).drop("_title", "_gone")


def lost_markers(blocks: DataFrame, most: int = 40) -> DataFrame:
    """A short paragraph between two dash lists that ends like an item becomes one."""
    w = W.partitionBy("doc_id").orderBy("pos")
    dash = lambda c: (c["kind"] == "list") & c["text"].rlike("^[-—–]")
    around = dash(F.lag(F.struct("kind", "text")).over(w)) & dash(F.lead(F.struct("kind", "text")).over(w))
    item = (F.col("kind") == "paragraph") & (F.length("text") <= most) & F.col("text").rlike("[；。]$") & around
    held = blocks.withColumn("_item", F.coalesce(item, F.lit(False)))
    out = changed(held, "text", F.when(F.col("_item"), F.concat(F.lit("— "), "text")).otherwise(F.col("text")), "CSM-OCR-005")
    return out.withColumn("kind", F.when(F.col("_item"), "list").otherwise(F.col("kind"))).drop("_item")


def unified_markers(items: DataFrame) -> DataFrame:
    """Symbols of a list become the one that more than half of at least two items have."""
    symbols = items.filter("marker_kind = 'symbol'")
    counts = symbols.groupBy("doc_id", "pos", "marker").agg(F.count("*").alias("n"))
    best = counts.groupBy("doc_id", "pos").agg(F.max_by("marker", "n").alias("_best"), F.max("n").alias("_n"), F.sum("n").alias("_all")).filter("_n >= 2 AND _n * 2 > _all")
    joined = items.join(best.select("doc_id", "pos", "_best"), ["doc_id", "pos"], "left")
    return changed(joined, "marker", F.when((F.col("marker_kind") == "symbol") & F.col("_best").isNotNull(), F.col("_best")).otherwise(F.col("marker")), "CSM-OCR-001").drop("_best")


def formula_numbers(blocks: DataFrame) -> DataFrame:
    """Formulas with the number in their tag or the line after it, and the number that order asks for."""
    tag = F.regexp_extract("text", r"\\tag\s*\{[（(]?\s*([A-Za-z]?\.?\d+(?:\.\d+)*)\s*[）)]?\}?", 1)
    line = F.regexp_extract("text", r"(?mU)^式\s*[（(]\s*(.+?)\s*[）)]\s*$", 1)
    number = F.when(tag != "", tag).when(line != "", line)
    w = W.partitionBy("doc_id").orderBy("pos")
    scope = F.last(F.when((F.col("kind") == "heading") & F.col("number").rlike("^[A-Z]$"), F.col("number")), True).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    own = blocks.withColumn("_scope", scope).filter("kind = 'formula'").withColumn("number", number)
    rank = F.row_number().over(W.partitionBy("doc_id", "_scope").orderBy("pos")).cast("string")
    expected = F.when(F.col("_scope").isNull(), rank).otherwise(F.concat_ws(".", "_scope", rank))
    return own.withColumn("expected", expected).withColumn("issue", F.when(F.col("number").isNotNull() & (F.col("number") != F.col("expected")), "CSM-OCR-017")).drop("_scope")


def term_spacing(blocks: DataFrame) -> DataFrame:
    """In the terms chapter the gap between a Han term and its Latin name becomes one ideographic space."""
    w = W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    chapter = F.last(F.when((F.col("kind") == "heading") & F.col("number").rlike(r"^\d+$"), F.col("title").contains("术语")), True).over(w)
    held = blocks.withColumn("_terms", F.coalesce(chapter, F.lit(False)))
    fixed = F.regexp_replace("text", r"(?mU)^([一-龥（）]+)[ \t　]+([A-Za-z][A-Za-z \-;,()]*)$", "$1　$2")
    return changed(held, "text", F.when(F.col("_terms") & (F.col("kind") == "paragraph"), fixed).otherwise(F.col("text")), "CSM-OCR-004").drop("_terms")


_HAN = re.compile(f"[{HAN}]")
_MARK = re.compile(f"(?<=[{HAN}])[{re.escape(''.join(WIDE))}]|[{re.escape(''.join(WIDE))}](?=[{HAN}])")
_STOP = re.compile(rf"(?<=[{HAN}])\.(?=[^\S\n]*$)", re.M)


def bracket_pairs(text: str) -> list[tuple[int, int]]:
    """Places of brackets that belong together, of either width."""
    opened, pairs = [], []
    for m in re.finditer("[(（)）]", text):
        if m[0] in "(（":
            opened.append(m.start())
        elif opened:
            pairs.append((opened.pop(), m.start()))
    return pairs


def widened(text: str) -> str:
    """One round: what stands beside Han text, as it was before the round."""
    seen = re.sub(MASKED, lambda m: "\ue000" * len(m[0]), text)
    new: dict[int, str] = {m.start(): WIDE[m[0]] for m in _MARK.finditer(seen)} | {m.start(): "。" for m in _STOP.finditer(seen)}
    word = lambda c: c.isascii() and c.isalnum()
    for a, b in bracket_pairs(seen):
        mixed = (seen[a] == "(") != (seen[b] == ")")
        outside = seen[max(0, a - 1) : a], seen[b + 1 : b + 2]
        beside = _HAN.search(outside[0] + seen[a + 1 : b] + outside[1]) and not all(map(word, outside))
        if mixed or (seen[a] == "(" and beside):
            new |= {a: "（", b: "）"}
    return "".join(new.get(i, c) for i, c in enumerate(text))


def wide_punctuation(text: str) -> str:
    """Half-width marks beside Han become full-width, brackets only as pairs; formulas and comments stay.

    Brackets also change for Han between them, but not inside a word. A full
    stop changes at the end of a line after Han alone. Three rounds at most, as
    a changed bracket is Han to its neighbour.
    """
    for _ in range(3):
        before, text = text, widened(text)
        if text == before:
            break
    return text


@F.pandas_udf(T.StringType())
def body_punctuation(texts: pd.Series) -> pd.Series:
    """wide_punctuation of every text: masks and pairs aren't regular."""
    return texts.map(wide_punctuation, na_action="ignore")


#: Parts of a clause number at most.
PARTS = 4


def _readings(digits: str, parts: int = PARTS) -> Iterator[tuple[int, ...]]:
    """All ways to read a run of digits as a number of so many parts, short first parts first; no part has a leading zero."""
    if not digits:
        yield ()
    elif parts:
        for k in range(1, len(digits) + 1):
            if k == 1 or digits[0] != "0":
                yield from ((int(digits[:k]), *rest) for rest in _readings(digits[k:], parts - 1))


def _continues(new: tuple[int, ...], last: tuple[int, ...]) -> bool:
    """Whether a number is the first below the last one, the next beside it, or the next beside one it stands in."""
    if len(new) == len(last) + 1:
        return new[:-1] == last and new[-1] == 1
    return len(new) <= len(last) and new[:-1] == last[: len(new) - 1] and new[-1] == last[len(new) - 1] + 1


def restored_numbers(blocks: DataFrame) -> DataFrame:
    """Headings whose number lost some or all of its dots, as 421 or 42.1 for 4.2.1, get the first reading that continues the numbering.

    A number that continues as it stands is right. Readings have four parts at
    most. What continues depends on all headings before, so the headings, and
    they alone, are walked in order, document after document; a task holds a
    batch of them and the last number.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        doc, last = None, ()
        for pdf in batches:
            fixed, codes = [], []
            for at, number in zip(pdf["doc_id"], pdf["number"], strict=True):
                if at != doc:
                    doc, last = at, ()
                own, code = tuple(int(p) for p in number.split(".")), None
                if last and not _continues(own, last):
                    found = next((r for r in _readings(number.replace(".", "")) if _continues(r, last)), own)
                    if found != own:
                        own, code = found, "CSM-OCR-002"
                fixed.append(".".join(map(str, own)))
                codes.append(code)
                last = own
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "pos": pdf["pos"], "_number": fixed, "_code": codes})

    kind = blocks.schema["doc_id"].dataType.simpleString()
    numbered = blocks.filter((F.col("kind") == "heading") & F.col("number").rlike(r"^\d+(\.\d+)*$") & F.col("doc_id").isNotNull()).select("doc_id", "pos", "number")
    walked = numbered.repartition("doc_id").sortWithinPartitions("doc_id", "pos").mapInPandas(walk, f"doc_id {kind}, pos int, _number string, _code string")
    before = F.col("issue") if "issue" in blocks.columns else F.lit(None).cast("string")
    return blocks.join(walked, ["doc_id", "pos"], "left").withColumn("number", F.coalesce("_number", "number")).withColumn("issue", F.coalesce("_code", before)).drop("_number", "_code")


def bound_footnotes(definitions: DataFrame, citations: DataFrame) -> DataFrame:
    """Footnote definitions with the block that cites their label, if only one does."""
    owners = citations.groupBy("doc_id", "label").agg(F.countDistinct("pos").alias("n_blocks"), F.min("pos").alias("owner_pos"))
    joined = definitions.join(owners, ["doc_id", "label"], "left")
    issue = F.when(F.col("n_blocks").isNull(), "CSM-STRUCT-009").when(F.col("n_blocks") > 1, "CSM-STRUCT-008")
    return joined.withColumns({"owner_pos": F.when(F.col("n_blocks") == 1, F.col("owner_pos")), "issue": issue})


def damaged_text_layers(lines: DataFrame, orphans: int = 30, truncated: int = 3) -> DataFrame:
    """doc_id, counts of orphan and truncated numbers in its lines, and whether they show a damaged layer."""
    w = W.partitionBy("doc_id").orderBy("pos")
    alone = F.col("line").rlike(r"(?U)^\s*\d+\.\s*$")
    long_after = F.greatest(*(F.coalesce(F.length(F.lead("line", k).over(w)), F.lit(0)) for k in (1, 2, 3))) >= 15
    marked = lines.withColumns({"_orphan": alone & long_after, "_cut": F.col("line").rlike(r"(?U)^\s*\d+(?:\.\d+)*\.\s*[一-龥]")})
    counts = marked.groupBy("doc_id").agg(F.count_if("_orphan").alias("n_orphans"), F.count_if("_cut").alias("n_truncated"))
    return counts.withColumn("damaged", (F.col("n_orphans") >= orphans) | (F.col("n_truncated") >= truncated))
