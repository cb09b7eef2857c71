"""Repairs of structure that look at neighbours: terms, examples, annexes, tables around images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EXAMPLE = r"(?U)^示例\s*\d*\s*[:：]?"
BACK = "^(?:参考文献|索引)"


def _before(column: Column, steps: int = 1) -> Column:
    return F.lag(column, steps).over(W.partitionBy("doc_id").orderBy("pos"))


def _after(column: Column, steps: int = 1) -> Column:
    return F.lead(column, steps).over(W.partitionBy("doc_id").orderBy("pos"))


def _running(column: Column) -> Column:
    return F.last(column, True).over(W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow))


def merged_terms(blocks: DataFrame) -> DataFrame:
    """A bare term number and the name after it become one heading, inside the terms chapter.

    The number may be a heading or a paragraph; the name is the block right
    after it, a Han term with a Latin name.
    """
    row = F.struct("kind", "text", "title", "number")
    chapter = _running(F.when((F.col("kind") == "heading") & F.col("number").rlike(r"^\d+$"), F.col("title").contains("术语")))
    inside = F.coalesce(chapter, F.lit(False))
    bare = lambda r: ((r["kind"] == "heading") & (F.coalesce(r["title"], F.lit("")) == "") & r["number"].contains(".")) | ((r["kind"] == "paragraph") & r["text"].rlike(r"(?U)^\s*\d+(?:\.\d+)+\s*$"))
    name = lambda r: r["kind"].isin("heading", "paragraph") & F.regexp_replace(r["text"], r"(?U)^#+\s*", "").rlike(r"(?U)^[一-龥（）、]+[\s　]+[A-Za-z][A-Za-z \-;,()]*$")
    takes, taken = inside & bare(row) & name(_after(row)), inside & bare(_before(row)) & name(row)
    plain = F.regexp_replace(_after(F.col("text")), r"(?U)^#+\s*", "")
    number = F.coalesce("number", F.regexp_extract("text", r"(\d+(?:\.\d+)+)", 1))
    held = blocks.withColumns({"_takes": F.coalesce(takes, F.lit(False)), "_taken": F.coalesce(taken, F.lit(False)), "_name": plain, "_number": number})
    out = held.filter(~F.col("_taken")).withColumns({
        "kind": F.when(F.col("_takes"), "heading").otherwise(F.col("kind")), "title": F.when(F.col("_takes"), F.col("_name")).otherwise(F.col("title")),
        "number": F.when(F.col("_takes"), F.col("_number")).otherwise(F.col("number")), "issue": F.when(F.col("_takes"), "CSM-OCR-007"),
    })
    return out.drop("_takes", "_taken", "_name", "_number")


def nested_examples(blocks: DataFrame) -> DataFrame:
    """Example headings go one level below the clause they stand in, to 6 at most.

    An example that holds numbered headings stays as it is; in a simple one,
    headings without a number become paragraphs.
    """
    heading = F.col("kind") == "heading"
    example = heading & F.col("title").rlike(EXAMPLE)
    numbered = heading & F.col("number").isNotNull() & ~example
    opened = F.sum(F.when(example | numbered, 1).otherwise(0)).over(W.partitionBy("doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow))
    held = blocks.withColumns({"_example": F.coalesce(example, F.lit(False)), "_numbered": F.coalesce(numbered, F.lit(False)), "_part": opened, "_level": _running(F.when(numbered, F.col("level")))})
    in_example = F.max(F.when(F.col("_example"), 1).otherwise(0)).over(W.partitionBy("doc_id", "_part")) == 1
    raised = F.least(F.greatest("level", F.col("_level") + 1), F.lit(6))
    held = held.withColumn("_in", in_example)
    level = F.when(F.col("_example") & F.col("_level").isNotNull(), raised).otherwise(F.col("level"))
    loose = F.col("_in") & ~F.col("_example") & ~F.col("_numbered") & (F.col("kind") == "heading")
    issue = F.when(loose, "CSM-OCR-020").when(~level.eqNullSafe(F.col("level")), "CSM-OCR-008")
    out = held.withColumns({"issue": issue, "_new": level, "_loose": loose})
    return out.withColumn("level", F.col("_new")).withColumn("kind", F.when(F.col("_loose"), "paragraph").otherwise(F.col("kind"))).drop("_example", "_numbered", "_part", "_level", "_in", "_new", "_loose")


def annex_examples(nodes: DataFrame) -> DataFrame:
    """Marks headings of annexes that are example content.

    Inside an annex a heading without a number begins an example, which ends at
    the next lettered number; back matter leaves the annex.
    """
    heading = F.col("kind") == "heading"
    in_annex = _running(F.when(heading & F.col("title").rlike(BACK), F.lit(False)).when(heading & (F.col("node_type") == "annex"), F.lit(True)).when(heading & F.col("node_type").isin("section"), F.lit(False)))
    state = _running(F.when(heading & F.col("number").rlike("^[A-Z](?:\\.|$)"), F.lit(False)).when(heading & F.col("number").isNull(), F.lit(True)))
    return nodes.withColumn("example_content", F.coalesce(in_annex & state, F.lit(False)))


def images_into_tables(blocks: DataFrame) -> DataFrame:
    """A bare image between a table and its continuation goes into the first free cell of the table's last row.

    The continuation is a table whose caption has the same number and 续; the
    cell is the first after the row's first that holds no image.
    """
    row = F.struct("kind", "text", "caption")
    number = lambda c: F.regexp_extract(c, r"表\s*([A-Z]?[0-9.]+)", 1)
    fits = lambda a, b: (a["kind"] == "table") & (b["kind"] == "table") & (number(a["caption"]) != "") & (number(a["caption"]) == number(b["caption"])) & b["caption"].contains("续")
    moved = (F.col("kind") == "image") & fits(_before(row), _after(row))
    gains = (F.col("kind") == "table") & (_after(F.col("kind")) == "image") & fits(row, _after(row, 2))
    last = F.element_at(F.split("text", "\n"), -1)
    cells = F.split(F.regexp_replace(last, r"^\s*\||\|\s*$", ""), r"\|", -1)
    at = F.array_position(F.transform(F.slice(cells, 2, F.size(cells)), lambda c: c.contains("![")), False).cast("int")
    held = blocks.withColumns({"_moved": F.coalesce(moved, F.lit(False)), "_gains": F.coalesce(gains, F.lit(False)), "_image": _after(F.col("text"))})
    filled = F.transform(cells, lambda c, i: F.when(i == at, F.trim(F.concat_ws(" ", F.trim(c), F.col("_image")))).otherwise(F.trim(c)))
    kept = F.expr("substring(text, 1, length(text) - length(substring_index(text, '\n', -1)))")
    text = F.concat(kept, F.lit("| "), F.array_join(filled, " | "), F.lit(" |"))
    out = held.withColumn("text", F.when(F.col("_gains") & (at > 0), text).otherwise(F.col("text")))
    return out.withColumn("issue", F.when(F.col("_gains"), "CSM-TABLE-002")).filter(~F.col("_moved")).drop("_moved", "_gains", "_image")


def cell_images(cells: DataFrame) -> DataFrame:
    """Text that went to the wrong one of two image cells goes back; cell and issue of every cell.

    cells: doc_id, pos (the table), number (its caption's, may be null),
    header_rows, row, col, cell. A cell with image and text, the only text of
    its column, gives the text to the cell before if that holds images alone;
    a run of such cells moves together. Two data rows are needed. Where a table
    changed, image cells of all tables with its number, be they continuations,
    get their images first. Tables that nothing moved in stay as extracted.
    """
    image = r"!\[[^\]]*\]\([^)]+\)"
    images = F.regexp_extract_all("cell", F.lit(f"({image})"), F.lit(1))
    plain = F.trim(F.regexp_replace("cell", image, ""))
    data = F.col("row") >= F.col("header_rows")
    held = cells.withColumns({"_images": F.when(data, images), "_plain": F.when(data, plain)})
    column, table, row = W.partitionBy("doc_id", "pos", "col"), W.partitionBy("doc_id", "pos"), W.partitionBy("doc_id", "pos", "row").orderBy("col")
    texts = F.sum(F.when(F.col("_plain") != "", 1).otherwise(0)).over(column)
    rows = F.size(F.collect_set(F.when(data, F.col("row"))).over(table))
    has_image = F.size("_images") > 0
    odd = has_image & (F.col("_plain") != "") & (texts == 1) & (rows >= 2) & (F.col("col") > 0)
    held = held.withColumns({"_odd": F.coalesce(odd, F.lit(False)), "_pure": F.coalesce(has_image & (F.col("_plain") == ""), F.lit(False))})
    base = F.last(F.when(~F.col("_odd"), F.col("_pure")), True).over(row.rowsBetween(W.unboundedPreceding, -1))
    held = held.withColumn("_gives", F.col("_odd") & F.coalesce(base, F.lit(False)))
    gets = F.when(F.lead("_gives").over(row), F.lead("_plain").over(row))
    held = held.withColumn("_gets", gets)
    rest = F.when(F.col("_gives"), F.array_join("_images", " ")).otherwise(F.regexp_replace("cell", r"(?U)\s+$", ""))
    moved = F.when(F.col("_gets").isNotNull(), F.concat_ws(" ", F.nullif(rest, F.lit("")), "_gets")).when(F.col("_gives"), rest).otherwise(F.col("cell"))
    held = held.withColumns({"_moved": moved, "_hit": F.col("_gives") | F.col("_gets").isNotNull()})
    same = W.partitionBy("doc_id", "number")
    changed = F.col("number").isNotNull() & F.max("_hit").over(same)
    parts = F.filter(F.transform(F.split("_moved", image), lambda t: F.trim(t)), lambda t: t != "")
    first = F.concat_ws(" ", F.array_join(F.regexp_extract_all("_moved", F.lit(f"({image})"), F.lit(1)), " "), F.array_join(parts, " "))
    late = changed & data & F.col("_moved").rlike(image) & (F.trim(F.split("_moved", image)[0]) != "")
    cell = F.when(late, first).otherwise(F.col("_moved"))
    out = held.withColumn("_new", cell)
    return out.select("doc_id", "pos", "row", "col", F.col("_new").alias("cell"), F.when(~F.col("_new").eqNullSafe(F.col("cell")), "CSM-TABLE-003").alias("issue"))


def realigned_merges(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Merge directives whose anchor went stale, moved to the cell that holds their text.

    cells: doc_id, table_id, header_rows, row, col, text. merges: doc_id,
    table_id, place (their order), row, col, rowspan, colspan, all from 0. Out:
    merges with row and rowspan to use and action. A vertical merge on a blank
    cell with text further down goes up to the nearest text of its column
    outside the header and ends before the next; the first directive that gets
    there has it (realigned), others stay as they are (overlap). Cells outside
    the table give out-of-range, a horizontal merge on a blank cell
    empty-anchor; both stay. A blank merge without any text is left alone.
    """
    key = ["doc_id", "table_id"]
    own = cells.withColumn("_full", F.trim(F.coalesce("text", F.lit(""))) != "")
    sizes = cells.groupBy(*key).agg((F.max("row") + 1).alias("_rows"), F.max("header_rows").alias("_header"))
    anchor = own.select(*key, "row", "col", F.col("_full").alias("_anchored"))
    held = merges.join(anchor, [*key, "row", "col"], "left").join(sizes, key, "left")
    labels = own.filter("_full").select(*key, "col", F.col("row").alias("_label"))
    stale = held.filter((F.col("rowspan") > 1) & ~F.col("_anchored")).select(*key, "place", "row", "col", "rowspan", "_header")
    met = stale.join(labels, [*key, "col"])
    found = met.groupBy(*key, "place", "col").agg(
        F.max(F.when((F.col("_label") <= F.col("row")) & (F.col("_label") >= F.col("_header")), F.col("_label"))).alias("_start"),
        F.min(F.when(F.col("_label") > F.col("row"), F.col("_label"))).alias("_next"),
        F.bool_or((F.col("_label") >= F.col("row")) & (F.col("_label") < F.col("row") + F.col("rowspan"))).alias("_inside"),
    ).filter("_inside AND _start IS NOT NULL")
    found = found.withColumn("_n", F.row_number().over(W.partitionBy(*key, "col", "_start").orderBy("place"))).drop("col")
    out = held.join(found, [*key, "place"], "left")
    action = (
        F.when(F.col("_anchored").isNull(), "out-of-range")
        .when(F.col("_n") == 1, "realigned")
        .when(F.col("_n") > 1, "overlap")
        .when((F.col("rowspan") <= 1) & (F.col("colspan") > 1) & ~F.col("_anchored"), "empty-anchor")
    )
    moves = F.col("_n") == 1
    end = F.coalesce("_next", "_rows")
    return out.select(*key, "place", F.when(moves, F.col("_start")).otherwise(F.col("row")).alias("row"), "col", F.when(moves, end - F.col("_start")).otherwise(F.col("rowspan")).alias("rowspan"), "colspan", action.alias("action"))
