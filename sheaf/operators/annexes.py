"""Headings of annexes that were split into several lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators.patterns import row_matches

# An annex's letter, its status, and what begins a clause of an annex.
LETTER = r"附\s*录\s*([A-Z])"
STATUS = "规范性附录|资料性附录|规范性|资料性|推荐性"
#: In order: what a line is, as a letter. A and B: the letter alone, as a heading or not; s, u and T: a heading with a usual
#: status, with another one, with status and title; S and V: the same without a heading; c: a heading that is no title.
CLASSES = (
    ("A", rf"(?U)^#{{1,2}}\s*{LETTER}\s*$"),
    ("B", r"(?U)^附录\s*([A-Z])\s*$"),
    ("s", rf"(?U)^#{{1,2}}\s*[(（](?:{STATUS})[)）]\s*$"),
    ("u", r"(?U)^#{1,2}\s*[(（][^)）]+[)）]\s*$"),
    ("T", r"(?U)^#{1,2}\s*[(（][^)）]+[)）]\s*[^#\s]"),
    ("S", rf"(?U)^\s*[(（](?:{STATUS})[)）]\s*$"),
    ("V", r"(?U)^\s*[(（][^)）]+[)）]\s*$"),
    ("c", r"(?U)^#{1,2}\s*(?:附录|[A-Z]\.\d)|^#{3,}"),
    ("h", r"(?U)^#{1,2}\s*[^#\s]"),
    ("p", r"^[^#]"),
)
#: The forms a split heading has; one without a heading needs a line after it.
FORMS = "A(?:s[hcp]|up|T|[SV]?h|Sp)|BSp(?=.)"


def rebuilt_annex_headings(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines with each split annex heading as one line: key, pos, line, issue.

    lines: key, pos, line. Letter, status and title may stand in two or three
    lines, some of them headings, with blank lines between; they become
    ``## 附录 A（规范性） title`` in place of the first. Lines that a heading took
    and the blanks between are gone; all else stays, null lines as well.
    """
    letter = F.lit("x")
    for name, pattern in reversed(CLASSES):
        letter = F.when(F.col("line").rlike(pattern), name).otherwise(letter)
    solid = lines.filter(F.trim("line") != "").select(key, "pos", "line", letter.alias("_letter"))
    found = row_matches(solid, F.col("_letter"), FORMS, key).filter("match IS NOT NULL")
    status = F.when(F.col("_letter").isin("s", "u", "S", "V", "T"), F.regexp_extract("line", "[(（]([^)）]+)[)）]", 1))
    bare = F.trim(F.regexp_replace("line", r"(?U)^#{1,2}\s*", ""))
    title = F.when(F.col("_letter") == "T", F.trim(F.regexp_replace(bare, "^[(（][^)）]+[)）]", ""))).when(F.col("_letter").isin("h", "c", "p"), bare)
    made = found.groupBy(key, "match").agg(
        F.min("pos").alias("_from"), F.max("pos").alias("_to"), F.max(F.when(F.col("place") == 0, F.regexp_extract("line", LETTER, 1))).alias("_a"),
        F.max(F.when(F.col("place") == 0, F.col("_letter"))).alias("_form"), F.max(F.when(F.col("place") > 0, status)).alias("_status"), F.max(F.when(F.col("place") > 0, title)).alias("_title"),
    )
    known = F.when(F.col("_form") == "A", F.trim(F.replace("_status", F.lit("附录"), F.lit("")))).otherwise(F.col("_status"))
    mark = F.when(F.coalesce(known, F.lit("")) != "", F.concat(F.lit("（"), known, F.lit("）"))).otherwise("")
    headings = made.select(key, "_from", "_to", F.concat(F.lit("## 附录 "), "_a", mark, F.lit(" "), "_title").alias("_heading"))
    taken = headings.select(key, F.explode(F.sequence("_from", "_to")).alias("pos"), "_from", "_heading")
    out = lines.join(taken, [key, "pos"], "left").filter("_from IS NULL OR pos = _from")
    return out.select(key, "pos", F.coalesce("_heading", "line").alias("line"), F.when(F.col("_heading").isNotNull(), "GEN-030").alias("issue"))
