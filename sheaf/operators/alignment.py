"""What a page's text layer has and the recognized lines lack, put back between lines that both have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The characters of an ellipsis, wide digits, the number a line begins with, and the end of a page's lines.
ELLIPSIS = "^[…⋯]{1,6}$"
WIDE, NARROW = "０１２３４５６７８９．", "0123456789."
NUMBER = r"(?U)^[\s—–\-]*([0-9]+(?:\.[0-9]+){0,3})(?=\s(?![0-9])|$)"
PAGES_END = "<!-- /ssir:mineru-pages -->"
#: Lines of one table row: so near in height, so far apart, so many.
SAME_ROW, APART, CELLS = 40, 60, 2
NEAR = 3


def is_ellipsis(text: Column) -> Column:
    """Whether a line is a short ellipsis and nothing else."""
    return F.replace(text, F.lit(" "), F.lit("")).rlike(ELLIPSIS)


def clause_number(text: Column) -> Column:
    """The dotted number a line of the text layer begins with, else null."""
    return F.nullif(F.regexp_extract(F.translate(text, WIDE, NARROW), NUMBER, 1), F.lit(""))


def restored_ellipses(lines: DataFrame, layer: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines with the ellipses that only the text layer has: key, pos, line, restored.

    lines: key, pos, line. layer: key, page, line_no, x0, y0, text. An ellipsis
    goes before the last line that begins with the number of the next numbered
    line on its page; both sequences only go forward, so that a line that lies
    before one already used is none. One at the end of the last page goes to the
    end. Cells of tables are left alone, and so is a place that has an ellipsis
    in the three lines before. Null lines stay, null layer texts say nothing.
    """
    page = W.partitionBy(key, "page").orderBy("line_no")
    document = W.partitionBy(key).orderBy("page", "line_no")
    whole = document.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ahead = F.first(clause_number(F.col("text")), True).over(page.rowsBetween(1, W.unboundedFollowing))
    last = F.last(F.struct("page", "y0")).over(whole)
    held = layer.filter("text IS NOT NULL").withColumns({"_number": ahead, "_last": last}).filter(is_ellipsis(F.col("text")))
    held = held.withColumn("_final", F.col("_number").isNull() & (F.col("page") == F.col("_last.page")) & (F.col("y0") >= F.col("_last.y0")))
    held = held.filter(F.col("_number").isNotNull() | F.col("_final"))

    other = layer.select(key, "page", F.col("line_no").alias("_no"), F.col("x0").alias("_x"), F.col("y0").alias("_y"))
    beside = (F.abs(F.col("_y") - F.col("y0")) <= SAME_ROW) & (F.abs(F.col("_x") - F.col("x0")) >= APART)
    cells = held.select(key, "page", "line_no", "x0", "y0").join(other, [key, "page"]).filter(beside).groupBy(key, "page", "line_no").count().filter(F.col("count") >= CELLS)
    held = held.join(cells, [key, "page", "line_no"], "left_anti")

    # the last line with each number, and the end of the lines
    by_pos = W.partitionBy(key).orderBy("pos")
    near = F.max(F.when(is_ellipsis(F.trim("line")), 1)).over(by_pos.rowsBetween(-NEAR, -1)).isNotNull()
    begun = F.regexp_extract(F.trim(F.regexp_replace("line", "^#+", "")), r"^([0-9]+(?:\.[0-9]+)*)(?=[^0-9.]|$)", 1)
    known = lines.withColumns({"_near": near, "_begun": begun})
    places = known.filter("_begun <> ''").groupBy(key, F.col("_begun").alias("_number")).agg(F.max(F.struct("pos", "_near")).alias("_at"))
    closing = F.max(F.when(F.col("line").startswith(PAGES_END), F.col("pos")))
    ends = lines.groupBy(key).agg(F.coalesce(closing, F.max("pos") + 1).alias("_end"), (F.max("pos") + 1).alias("_length"))
    found = held.join(places, [key, "_number"], "left").join(ends, key)
    reach = F.when(F.col("_final"), F.col("_length")).otherwise(F.col("_at.pos"))
    before = F.max(reach).over(document.rowsBetween(W.unboundedPreceding, -1))
    forward = F.col("_final") | ((reach > F.coalesce(before, F.lit(-1))) & ~F.col("_at._near"))
    put = found.withColumns({"_reach": reach, "_forward": forward}).filter("_forward")
    added = put.select(key, F.when(F.col("_final"), F.col("_end")).otherwise(F.col("_reach")).alias("_p"), F.struct("page", "line_no").alias("_k"), F.lit("……").alias("line"), F.lit(True).alias("restored"))
    nothing = F.lit(None).cast(added.schema["_k"].dataType)
    both = lines.select(key, F.col("pos").alias("_p"), nothing.alias("_k"), "line", F.lit(False).alias("restored")).unionByName(added)
    place = F.row_number().over(W.partitionBy(key).orderBy("_p", F.col("_k").asc_nulls_last())) - 1
    return both.select(key, place.alias("pos"), "line", "restored")
