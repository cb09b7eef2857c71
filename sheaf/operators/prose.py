"""Paragraphs from lines: what belongs together over a blank line, and what was run together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.operators import lines as runs

# Beginnings of examples and notes, and the places where a paragraph holds another one.
EXAMPLE = r"(?U)^示例\s*\d*\s*[:：]"
EXAMPLE_ALONE = r"(?U)^示例\s*\d*\s*[:：]\s*$"
NOTE = r"(?U)^注\s*\d*\s*[:：]"
BEFORE_NOTE = r"(?U)(?<=。)(?=注\s*\d*\s*[:：])"
BEFORE_CLAUSE = r"(?U)(?<=[。；])\s*(?=\d+(?:\.\d+)+[一-鿿])"


def assembled(classified: DataFrame, key: str = "doc_id") -> DataFrame:
    """Paragraphs of classified lines: key, start_line, end_line, part, kind, level and text.

    Lines follow each other in one paragraph until a blank or another kind of
    line; marks of pages don't interrupt. Over blank lines it goes on only after
    ， or 、, with a line that begins with a Han character and is no example or
    note; such lines join without a break. A paragraph whose lines are mostly
    whole sentences, one ending in a semicolon, is an enumeration: a part for
    each line. Other paragraphs are cut before a note (after 。) and before a
    clause number (after 。 or ；). Parts count from 0 and keep the line range of
    their paragraph; a part may be a note or the heading of an example.
    """
    w = W.partitionBy(key).orderBy("pos")
    solid = classified.filter("kind NOT IN ('blank', 'page') AND line IS NOT NULL")
    blanks = classified.filter("kind <> 'page'")
    gap = F.lag("kind").over(w) == "blank"
    apart = blanks.withColumn("_gap", F.coalesce(gap, F.lit(False))).filter("kind <> 'blank'").select(key, "pos", "_gap")
    line = F.regexp_replace("line", r"(?U)\s+$", "")
    held = solid.join(apart, [key, "pos"]).withColumn("_line", line)
    held = held.withColumns({"_kind": F.lag("kind").over(w), "_before": F.lag("_line").over(w)})
    now = F.trim("_line")
    joins = F.col("_before").rlike("[，、]$") & now.rlike("^[一-鿿]") & ~now.rlike(EXAMPLE) & ~now.rlike(NOTE)
    goes_on = (F.col("_kind") == "paragraph") & (~F.col("_gap") | joins)
    held = held.filter("kind = 'paragraph'").withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    held = held.withColumn("_p", runs.running(F.when(F.col("_on"), 0).otherwise(1), key))
    piece = F.struct("pos", F.concat(F.when(F.col("_on") & ~F.col("_gap"), "\n").otherwise(""), "_line").alias("t"))
    made = held.groupBy(key, "_p").agg(F.min("pos").alias("start_line"), F.max("pos").alias("end_line"), F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda s: s["t"]), "").alias("_text"))

    own = F.filter(F.transform(F.split("_text", "\n"), lambda x: F.trim(F.regexp_replace(F.trim(x), r"\$+$", ""))), lambda x: x != "")
    whole = F.size(F.filter("_lines", lambda x: x.rlike("[。；：;.]$")))
    listed = (F.size("_lines") >= 2) & (whole >= 2) & (whole * 3 >= F.size("_lines") * 2) & F.exists("_lines", lambda x: x.rlike("[；;]$"))
    cut = F.flatten(F.transform(F.split("_text", BEFORE_NOTE), lambda x: F.split(F.trim(x), BEFORE_CLAUSE)))
    parts = F.when(listed, F.col("_lines")).otherwise(F.filter(F.transform(cut, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != ""))
    rows = made.withColumn("_lines", own).select(key, "start_line", "end_line", listed.alias("_listed"), F.posexplode(parts).alias("part", "text"))
    heading = F.col("text").rlike(EXAMPLE_ALONE) & ~F.col("_listed")
    kind = F.when(heading, "heading").when(F.col("text").rlike(NOTE), "note").otherwise("paragraph")
    return rows.select(key, "start_line", "end_line", "part", kind.alias("kind"), F.when(heading, 2).alias("level"), "text")
