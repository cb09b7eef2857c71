"""Projections of structure tables: Markdown, HTML, triples and JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.joins import in_order


def escaped(c: Column) -> Column:
    return reduce(lambda s, p: F.replace(s, F.lit(p[0]), F.lit(p[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")), c)


def plain_markdown(blocks: DataFrame) -> DataFrame:
    """doc_id and Markdown without directives; headings go one level down, between 2 and 6."""
    own = blocks.filter(~F.col("kind").isin("directive", "box", "columns", "page"))
    level = F.least(F.greatest(F.col("level") + 1, F.lit(2)), F.lit(6))
    heading = F.concat(F.repeat(F.lit("#"), level), F.lit(" "), F.concat_ws(" ", "number", "title"))
    text = F.when(F.col("kind") == "heading", heading).otherwise(F.regexp_replace("text", r"(?s)<!--.*?-->", ""))
    return in_order(own.withColumn("markdown", text).select("doc_id", "pos", "markdown"), "doc_id", "pos", "markdown", "\n\n")


def html(blocks: DataFrame) -> DataFrame:
    """doc_id and a plain HTML body."""
    level = F.least(F.greatest(F.col("level") + 1, F.lit(2)), F.lit(6)).cast("string")
    body = escaped(F.col("text"))
    made = (
        F.when(F.col("kind") == "heading", F.concat(F.lit("<h"), level, F.lit(">"), escaped(F.concat_ws(" ", "number", "title")), F.lit("</h"), level, F.lit(">")))
        .when(F.col("kind").isin("code", "table"), F.concat(F.lit("<pre>"), body, F.lit("</pre>")))
        .when(F.col("kind") == "list", F.concat(F.lit("<ul><li>"), F.array_join(F.split(body, "\n"), "</li><li>"), F.lit("</li></ul>")))
        .when(F.col("kind").isin("quote", "note", "example"), F.concat(F.lit("<blockquote>"), F.regexp_replace(body, "(?m)^&gt;\\s*", ""), F.lit("</blockquote>")))
        .otherwise(F.concat(F.lit("<p>"), body, F.lit("</p>")))
    )
    own = blocks.filter(~F.col("kind").isin("directive", "box", "columns", "page")).withColumn("html", made)
    return in_order(own.select("doc_id", "pos", "html"), "doc_id", "pos", "html")


def table_html(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the HTML of each table; blank covered cells are skipped, header rows go to the head."""
    tag = F.when(F.col("is_header"), "th").otherwise("td")
    span = lambda c: F.when(F.col(c) > 1, F.concat(F.lit(f' {c}="'), F.col(c).cast("string"), F.lit('"'))).otherwise("")
    cell = F.concat(F.lit("<"), tag, span("rowspan"), span("colspan"), F.lit(">"), escaped(F.col("cell")), F.lit("</"), tag, F.lit(">"))
    rows = cells.groupBy(*keys, "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", cell.alias("h")))), lambda s: s["h"]), "").alias("_cells"))
    line = F.concat(F.lit("<tr>"), "_cells", F.lit("</tr>"))
    return rows.groupBy(*keys).agg(F.concat(F.lit("<table>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", line.alias("l")))), lambda s: s["l"]), ""), F.lit("</table>")).alias("html"))


def triples(nodes: DataFrame, base: str = "urn:doc:") -> DataFrame:
    """(s, p, o) rows of nodes with element_id, parent_id, node_type and title."""
    iri = lambda c: F.concat(F.lit(f"<{base}"), F.url_encode(c), F.lit(">"))
    literal = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))
    rows = (("a", F.concat(F.lit("ssir:"), "node_type")), ("ssir:title", literal(F.col("title"))), ("ssir:parent", iri(F.col("parent_id"))))
    each = F.explode(F.filter(F.array(*(F.when(o.isNotNull(), F.struct(F.lit(p).alias("p"), o.alias("o"))) for p, o in rows)), lambda t: t.isNotNull()))
    return nodes.select(iri(F.col("element_id")).alias("s"), each.alias("t")).select("s", "t.p", "t.o")


def turtle(rows: DataFrame) -> DataFrame:
    """Lines of a Turtle file."""
    return rows.select(F.concat(F.concat_ws(" ", "s", "p", "o"), F.lit(" .")).alias("value"))


def sorted_json(rows: DataFrame, name: str = "json") -> DataFrame:
    """Each row as JSON with its fields by name, so that equal rows give equal bytes."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias(name))


#: Folders of a stored table: keys are dealt to them by their hash, so that their number doesn't grow with the documents.
BUCKETS = 64
_BUCKET = "bucket"


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table."""
    return spark.read.parquet(path).drop(_BUCKET)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _rewritten(path: str, keys: DataFrame, key: str, new: DataFrame | None) -> None:
    """The buckets of some keys, written again without their rows and with new ones; other buckets stay as they are."""
    spark = keys.sparkSession
    touched = keys.select(key).distinct().withColumn(_BUCKET, _bucket(key))
    rows, emptied = None if new is None else new.withColumn(_BUCKET, _bucket(key)), set()
    if _exists(spark, path):
        buckets = [r[0] for r in touched.select(_BUCKET).distinct().collect()]  # BUCKETS at most
        kept = spark.read.parquet(path).filter(F.col(_BUCKET).isin(buckets)).join(touched.select(key), key, "left_anti")
        rows = kept if rows is None else rows.unionByName(kept, allowMissingColumns=True)
        if new is None:  # what is left without rows is not overwritten
            emptied = set(buckets) - {r[0] for r in kept.select(_BUCKET).distinct().collect()}
    if rows is not None:
        rows.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
    for bucket in emptied:
        _delete(spark, f"{path}/{_BUCKET}={bucket}")


def upsert(rows: DataFrame, path: str, key: str = "doc_id") -> None:
    """Replace the stored rows of the keys in rows, leaving others as they are. Null keys are never replaced, only added."""
    _rewritten(path, rows, key, rows)


def remove(keys: DataFrame, path: str, key: str = "doc_id") -> None:
    """Delete the stored rows of some keys; unknown keys and tables are no fault."""
    _rewritten(path, keys, key, None)


def clear(spark: SparkSession, path: str) -> None:
    """Delete a stored table."""
    _delete(spark, path)


def volumes(files: DataFrame, left: str, right: str) -> DataFrame:
    """Pages, bytes and characters of two renditions and their differences; files have doc_id, rendition and the three."""
    names = ("pages", "bytes", "chars")
    side = lambda which: files.filter(F.col("rendition") == which).select("doc_id", *(F.col(n).alias(f"{which}_{n}") for n in names))
    return side(left).join(side(right), "doc_id", "full").withColumns({f"delta_{n}": F.col(f"{right}_{n}") - F.col(f"{left}_{n}") for n in names})
