"""Lines, runs of lines and text ledgers: segmentation as gaps and islands.

Every function takes the name of the document key. Lines carry an explicit
``pos``; nothing depends on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What ends a line, other than a line feed: the forms that Unicode text files use.
LINE_ENDS = "\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, pos (from 0) and line; other line ends count as line feeds, a final one ends no extra line."""
    body = F.regexp_replace(F.regexp_replace(F.col(text), LINE_ENDS, "\n"), "\n\\z", "")
    own = docs.filter(F.length(text) > 0).select(key, body.alias("_body"))
    return own.select(key, F.posexplode(F.split("_body", "\n", -1)).alias("pos", "line"))


def running(value: Column, key: str, pos: str = "pos") -> Column:
    """The sum of a value over a document's rows up to this one."""
    return F.sum(value).over(W.partitionBy(key).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow))


def islands(rows: DataFrame, same: Column, key: str = "doc_id", pos: str = "pos", name: str = "island") -> DataFrame:
    """Numbers runs of neighbouring rows with an equal value of ``same`` from 1."""
    w = W.partitionBy(key).orderBy(pos)
    begins = F.when(F.lag(F.lit(1)).over(w).isNull() | ~same.eqNullSafe(F.lag(same).over(w)), 1).otherwise(0)
    return rows.withColumn("_begins", begins).withColumn(name, running(F.col("_begins"), key, pos).cast("int")).drop("_begins")


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of lines that aren't blank: key, block, start_line, end_line, n_lines, n_chars."""
    cut = lines(docs, key, text).withColumn("blank", F.trim("line") == "")
    runs = islands(cut, F.col("blank"), key).filter(~F.col("blank"))
    made = runs.groupBy(key, "island").agg(F.min("pos").alias("start_line"), F.max("pos").alias("end_line"), F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))
    number = F.row_number().over(W.partitionBy(key).orderBy("start_line"))
    return made.select(key, number.alias("block"), "start_line", "end_line", "n_lines", "n_chars")


def spans_between(rows: DataFrame, opens: Column, closes: Column, key: str = "doc_id", pos: str = "pos", name: str = "inside") -> DataFrame:
    """Marks rows between an opening and a closing row; nested openings are ignored, an unclosed span reaches the end."""
    w = W.partitionBy(key).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.last(F.when(opens, 1).when(closes, 0), True).over(w)
    return rows.withColumn(name, (F.coalesce(last, F.lit(0)) == 1) & ~opens & ~closes)


def groups_within(rows: DataFrame, opens: Column, parts: Column, closes: Column, key: str = "doc_id", pos: str = "pos") -> DataFrame:
    """Numbers column groups and the columns in each; outside a group both are null."""
    held = spans_between(rows, opens, closes, key, pos, "_in")
    held = held.withColumn("group_no", F.when(F.col("_in"), running(F.when(opens, 1).otherwise(0), key, pos)))
    w = W.partitionBy(key, "group_no").orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    return held.withColumn("column_no", F.when(F.col("_in"), F.sum(F.when(parts, 1).otherwise(0)).over(w))).drop("_in")


def until_broken(rows: DataFrame, starts: Column, fits: Column, key: str = "doc_id", pos: str = "pos", name: str = "skipped") -> DataFrame:
    """Marks the rows after a starting row for as long as each fits, as a table of contents after its heading."""
    w = W.partitionBy(key).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    held = rows.withColumns({"_start": F.max(F.when(starts, F.col(pos))).over(w), "_break": F.max(F.when(F.coalesce(~starts & ~fits, F.lit(True)), F.col(pos))).over(w)})
    return held.withColumn(name, F.col("_start").isNotNull() & (F.col("_break").isNull() | (F.col("_break") < F.col("_start"))) & ~starts).drop("_start", "_break")


def next_matching(rows: DataFrame, value: Column, matches: Column, key: str = "doc_id", pos: str = "pos", name: str = "target") -> DataFrame:
    """The value of the next row that matches: what a directive before it applies to."""
    w = W.partitionBy(key).orderBy(pos).rowsBetween(1, W.unboundedFollowing)
    return rows.withColumn(name, F.first(F.when(matches, value), True).over(w))


def last_matching(rows: DataFrame, value: Column, matches: Column, key: str = "doc_id", pos: str = "pos", name: str = "owner") -> DataFrame:
    """The value of the latest earlier row that matches."""
    w = W.partitionBy(key).orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn(name, F.last(F.when(matches, value), True).over(w))


def fence_parity(rows: DataFrame, fence: Column, key: str = "doc_id", pos: str = "pos", name: str = "fenced") -> DataFrame:
    """Marks fenced rows; an odd number of fences leaves the rest open, which ``unclosed`` tells."""
    held = rows.withColumn("_fences", running(F.when(fence, 1).otherwise(0), key, pos))
    all_ = F.sum(F.when(fence, 1).otherwise(0)).over(W.partitionBy(key))
    return held.withColumn(name, (F.col("_fences") % 2 == 1) & ~fence).withColumn("unclosed", all_ % 2 == 1).drop("_fences")


def ledger(parts: DataFrame, key: str = "doc_id", pos: str = "pos", text: str = "line", gap: int = 1) -> DataFrame:
    """start and end of each part in the text that joins a document's parts with a separator."""
    w = W.partitionBy(key).orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(text) + gap).over(w), F.lit(0))
    return parts.withColumn("start_char", start.cast("long")).withColumn("end_char", F.col("start_char") + F.length(text))


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "text", ends: str = "[。！？.!?]") -> DataFrame:
    """key, sentence_no and the text between sentence ends, blank ones left out."""
    cut = docs.select(key, F.posexplode(F.split(text, ends)).alias("sentence_no", "sentence"))
    return cut.withColumn("sentence", F.trim("sentence")).filter("sentence <> ''")


def list_groups(items: DataFrame, key: str = "doc_id", pos: str = "pos", text: str = "text", kind: str = "kind") -> DataFrame:
    """Runs of list rows with what introduces them and the end mark they share.

    intro_pos is the row before a run if it ends in a colon; terminator is the
    items' common last character, null where they differ.
    """
    w = W.partitionBy(key).orderBy(pos)
    held = items.withColumns({"_before": F.lag(text).over(w), "_before_pos": F.lag(pos).over(w), "_before_kind": F.lag(kind).over(w)})
    held = islands(held, F.col(kind), key, pos, "_run").filter(F.col(kind) == "list")
    intro = F.min(F.when(F.col("_before").rlike("[：:]$") & ~F.col("_before_kind").eqNullSafe(F.lit("list")), F.col("_before_pos")))
    ends = F.collect_set(F.expr(f"right({text}, 1)"))
    return held.groupBy(key, "_run").agg(F.min(pos).alias("first_pos"), F.count("*").alias("n_items"), intro.alias("intro_pos"), F.when(F.size(ends) == 1, ends[0]).alias("terminator")).drop("_run")


def majority(rows: DataFrame, group: str, value: str) -> DataFrame:
    """group and the value that more than half its rows have, at least two; null where none does."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(group).agg(F.max_by(value, F.struct("n", value)).alias("_v"), F.max("n").alias("n_best"), F.sum("n").alias("n_all"))
    strict = (F.col("n_best") >= 2) & (F.col("n_best") * 2 > F.col("n_all"))
    return best.select(group, F.when(strict, F.col("_v")).alias("majority"), "n_best", "n_all")
