"""Patterns over rows: every row is a letter, a document a string, and a regular expression finds runs of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def row_matches(rows: DataFrame, letter: Column, pattern: str, key: str = "doc_id", pos: str = "pos") -> DataFrame:
    """rows with match (from 1, null outside) and place (from 0 in its match): runs of rows whose letters match a pattern.

    Matches don't overlap, the earliest comes first. The pattern must not hold
    capturing groups or match nothing; ``letter`` is one character. Lookaheads
    see the rows after a match. Only a document's letters come together.
    """
    w = W.partitionBy(key).orderBy(pos)
    numbered = rows.withColumns({"_i": F.row_number().over(w) - 1, "_l": letter})
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_l"))), lambda s: s["_l"]), "")
    docs = numbered.groupBy(key).agg(letters.alias("_s")).filter(F.col("_s").rlike(pattern))
    every = F.lit(f"({pattern})|[\\s\\S]")
    pieces = F.arrays_zip(F.regexp_extract_all("_s", every, F.lit(0)).alias("all"), F.regexp_extract_all("_s", every, F.lit(1)).alias("hit"))
    marks = F.flatten(F.transform(pieces, lambda p, i: F.transform(F.sequence(F.lit(0), F.length(p["all"]) - 1), lambda k: F.struct(F.when(p["hit"] != "", i + 1).alias("match"), k.alias("place")))))
    hits = docs.select(F.col(key), F.posexplode(marks).alias("_i", "_m")).filter("_m.match IS NOT NULL").select(key, "_i", F.col("_m.match").alias("match"), F.col("_m.place").alias("place"))
    return numbered.join(hits, [key, "_i"], "left").drop("_i", "_l")


# Beginnings of clauses and of other things than list items, and the markers of each family.
CLAUSE = r"(?U)^(?:\d+(?:\.\d+)+|[A-Z]\.\d+(?:\.\d+)*)\s*\S|^[A-Z](?:\.\d+)?\s"
LEAD = r"(?U)^(?:注|警示|示例|表|图|附录|附\s*录|参考文献|目\s*次)"
FAMILIES = (("dash", "[-—–]{1,3}"), ("dot", "[·•・]"), ("letter", "[A-Za-z][)）]"), ("number", r"\d+[)）]"))
GLUED = 60

_MARKER = "(?U)^(" + "|".join(p for _, p in FAMILIES) + r")\s*"


def _family(marker: Column) -> Column:
    out = None
    for i, (_, pattern) in enumerate(FAMILIES):
        test = marker.rlike(f"(?U)^(?:{pattern})$")
        out = F.when(test, i) if out is None else out.when(test, i)
    return out


def _groups() -> str:
    """The pattern of a list that a colon leads in, for each family of markers.

    Letters: i and j end in a colon (i may be an item whose semicolon was read
    as a colon), g and h hold their first item behind the colon (g may itself
    be an item), p and q are items without a marker that end in ； or 。; lists
    of family f are A+f (all items end in ；), E+f (the last does) or I+f (the
    last ends in 。). A 。 ends the group unless what follows ends in ；.
    """
    strong, out = "[A-Dpg]", []
    for f in range(len(FAMILIES)):
        all_semi, some, last = (chr(ord(c) + f) for c in "AEI")
        listed = all_semi + some + last
        body = f"(?:[{all_semi}{some}pg]|{last}(?={strong})|i(?={strong}))*(?:{last}(?!{strong})|q)"
        marked = f"(?=[pgi]*[{listed}])"
        out += [f"[ij]{marked}(?=[{listed}]*[pgiq]){body}", f"[gh]{marked}{body}"]
    return "|".join(out)


def colon_lists(blocks: DataFrame) -> DataFrame:
    """Lists that a colon leads in, with the markers that got lost.

    In: doc_id, pos, kind and text of blocks; a list's text has a line for each
    item. Out: doc_id, pos, item, kind, marker, text and issue, a row for each
    item of a list and each other block. A group is rebuilt if two items at
    least are there, all markers are of one family, one is missing (or a
    semicolon was read as a colon) and the last item ends in 。. Dashes and dots
    get the most frequent marker, letters and numbers are counted anew; an item
    glued to the intro becomes one of its own. Rows with a null text stay.
    """
    stripped = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)^\s+|\s+$", "")
    cut = F.filter(F.split(stripped, r"\s*\n\s*"), lambda x: x != "")
    items = F.transform(cut, lambda x: F.struct(F.regexp_extract(x, _MARKER, 1).alias("marker"), F.regexp_replace(x, _MARKER, "").alias("text")))
    held = blocks.select("doc_id", "pos", "kind", "text", stripped.alias("_t"), F.when(F.col("kind") == "list", items).alias("_items"))

    ends = lambda c, mark: c.endswith(mark)
    texts, families = F.transform("_items", lambda x: x["text"]), F.array_distinct(F.transform("_items", lambda x: _family(x["marker"])))
    fits = F.forall(texts, lambda x: x.rlike("[；。]$")) & (F.size("_items") > 0) & (F.size(families) == 1) & families[0].isNotNull()
    base = F.when(F.forall(texts, lambda x: ends(x, "；")), ord("A")).when(ends(F.element_at(texts, -1), "；"), ord("E")).otherwise(ord("I"))
    t, tail = F.col("_t"), F.trim(F.regexp_extract("_t", r"：([^：]*)\z", 1))
    single, barred = ~t.contains("\n"), t.rlike(CLAUSE) | t.rlike(LEAD)
    item = single & ~barred & t.rlike("[；。]$")
    glued = ends(tail, "；") & ~tail.contains("。") & (F.length(tail) <= GLUED) & ~tail.rlike(CLAUSE) & ~tail.rlike(LEAD)
    prose = F.when(ends(t, "："), F.when(single & ~barred, "i").otherwise("j")).when(glued, F.when(item, "g").otherwise("h")).when(item, F.when(ends(t, "；"), "p").otherwise("q")).otherwise("x")
    letter = F.when((F.col("kind") == "list") & fits, F.chr(base + families[0])).when(F.col("kind") == "paragraph", prose).otherwise("x")
    found = row_matches(held.withColumn("_letter", F.coalesce(letter, F.lit("x"))), F.col("_letter"), _groups())

    # every block as its rows: text that stays outside, then items
    inside, intro = F.col("match").isNotNull() & (F.col("place") > 0), F.col("place") == 0
    split = intro & F.col("_letter").isin("g", "h")
    plain = F.array(F.struct(F.lit("").alias("marker"), F.col("text")))
    own = (
        F.when(F.col("kind") == "list", F.transform("_items", lambda x: F.struct(x["marker"].alias("marker"), x["text"].alias("text"))))
        .when(split, F.array(F.struct(F.lit("").alias("marker"), F.regexp_replace("_t", r"：[^：]*\z", "：").alias("text")), F.struct(F.lit("").alias("marker"), tail.alias("text"))))
        .when(inside & (F.col("_letter") == "i"), F.array(F.struct(F.lit("").alias("marker"), F.regexp_replace("_t", "：$", "；").alias("text"))))
        .when(inside, F.array(F.struct(F.lit("").alias("marker"), F.col("_t").alias("text"))))
        .otherwise(plain)
    )
    rows = found.select("doc_id", "pos", "kind", "match", split.alias("_split"), inside.alias("_in"), F.posexplode(own).alias("_k", "_e"))
    entry = F.coalesce(F.col("_in") | (F.col("_split") & (F.col("_k") == 1)), F.lit(False))
    rows = rows.select("doc_id", "pos", "_k", "kind", "match", entry.alias("_entry"), F.coalesce("_split", F.lit(False)).alias("_lead"), F.nullif("_e.marker", F.lit("")).alias("marker"), "_e.text")

    # what a group's markers say
    group = W.partitionBy("doc_id", "match", "_entry")
    order = group.orderBy("pos", "_k")
    number = F.row_number().over(order) - 1
    first = F.first("marker", True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rows = rows.withColumns({"_n": number, "_first": first, "_all": F.count(F.lit(1)).over(group), "_lost": F.sum(F.when(F.col("marker").isNull(), 1).otherwise(0)).over(group), "_pos": F.coalesce(F.min(F.when(~F.col("_lead"), F.col("pos"))).over(group), F.col("pos"))})
    same = W.partitionBy("doc_id", "match", "_entry", "marker")
    rows = rows.withColumns({"_same": F.count("marker").over(same), "_since": F.min("_n").over(same)})
    best = F.max(F.when(F.col("marker").isNotNull(), F.struct("_same", (-F.col("_since")).alias("s"), "marker"))).over(group)
    rows = rows.withColumn("_best", best)
    most, closing = F.col("_best.marker"), F.when(F.col("_first").endswith("）"), "）").otherwise(")")
    clear = (F.col("_best._same") + F.col("_lost") >= 2) & (2 * (F.col("_best._same") + F.col("_lost")) > F.col("_all"))
    symbol = F.when(F.col("marker").isNull() | clear, most).otherwise(F.col("marker"))
    capital = F.col("_first").rlike("^[A-Z]")
    lettered = F.when(F.col("_all") <= 26, F.concat(F.chr(F.when(capital, 65).otherwise(97) + F.col("_n")), closing)).otherwise(F.col("marker"))
    family = _family(F.col("_first"))
    rebuilt = F.when(family < 2, symbol).when(family == 2, lettered).otherwise(F.concat((F.col("_n") + 1).cast("string"), closing))
    hit = F.col("_entry")
    return rows.select(
        "doc_id",
        F.when(hit, F.col("_pos")).otherwise(F.col("pos")).cast("int").alias("pos"),
        F.when(hit, F.col("_n")).when(F.col("kind") == "list", F.col("_k")).otherwise(0).cast("int").alias("item"),
        F.when(hit, "list").otherwise(F.col("kind")).alias("kind"),
        F.when(hit, rebuilt).otherwise(F.col("marker")).alias("marker"),
        "text",
        F.when(hit, "CSM-OCR-016").alias("issue"),
    )
