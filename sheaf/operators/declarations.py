"""Bodies of declarations: the legends and part captions of figures that a directive announces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators.patterns import row_matches

# Directives, the lines that end a body without a closing one, and what an item of each declaration looks like.
OPENING = r"(?U)^<!--\s*ssir:([a-z-]+).*?\s*-->\s*$"
CLOSING = r"(?U)^<!--\s*ssir:/\s*[A-Za-z][\w-]*\s*-->\s*$"
STOPS = r"^(?:#|```|\||>|!\[)"
ITEMS = {
    "figure-legend": r"(?U)^([0-9]+|[A-Za-z])\s*[—–-]{1,2}\s*(.+?)[；;。]?$",
    "figure-sub": r"(?U)^([A-Za-z0-9])\s*[)）]\s*(.+)$",
}
#: D begins, C closes; o is another directive, h a heading or fence, s another stop, i an item, b a blank line, t any other line.
BODY = "D[sibt]*C|D(?:b*i)*"


def declared(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, name, start_line, end_line, item, label and text of every item of the declarations in lines (key, pos, line).

    A body reaches to its closing directive, and all its lines are items, those
    of another form without a label; without one, it is the items that follow,
    blank lines between or not. A declaration without items has one row whose
    item is null. Null lines count as blank.
    """
    line = F.trim(F.coalesce("line", F.lit("")))
    out = []
    for name, pattern in ITEMS.items():
        own = lines.select(key, "pos", line.alias("line"))
        begins = F.regexp_extract("line", OPENING, 1)
        letter = (
            F.when(F.col("line") == "", "b").when(F.col("line").rlike(CLOSING), "C").when(begins == name, "D").when(begins != "", "o")
            .when(F.col("line").rlike("^(?:#|```)"), "h").when(F.col("line").rlike(STOPS), "s").when(F.col("line").rlike(pattern), "i").otherwise("t")
        )
        found = row_matches(own.withColumn("_letter", letter), F.col("_letter"), BODY, key).filter("match IS NOT NULL")
        label, text = (F.regexp_extract("line", pattern, k) for k in (1, 2))
        item = F.when(~F.col("_letter").isin("D", "C", "b"), F.struct("pos", F.nullif(label, F.lit("")).alias("label"), F.when(text != "", text).otherwise(F.col("line")).alias("text")))
        ends = F.max(F.when(F.col("_letter") != "b", F.col("pos")))
        bodies = found.groupBy(key, "match").agg(F.min("pos").alias("start_line"), ends.alias("end_line"), F.array_sort(F.collect_list(item)).alias("_items"))
        rows = bodies.select(key, "start_line", "end_line", F.posexplode_outer("_items").alias("item", "_e"))
        out.append(rows.select(key, F.lit(name).alias("name"), "start_line", "end_line", "item", "_e.label", "_e.text"))
    return reduce(DataFrame.unionByName, out)
