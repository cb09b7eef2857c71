"""Queries that run the operators for standards on texts made from the driver's tables.

The tables hold no standards, so identifiers, titles, sentences and Markdown are
composed from their columns; the SQL states what must come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import citations, naming, titles
from sheaf.operators import catalog, markdown, references, repair, rules
from sheaf.plans.catalogue import query
from sheaf.sources import html, sinks
from sheaf.sources import markdown as source
from sheaf.sources.tables import table


def _s(column: str) -> Column:
    return F.col(column).cast("string")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with a standard's number and title."""
    code = F.element_at(F.array(*map(F.lit, ("GB/T", "GB", "JB/T", "DB11/T"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    kind = F.element_at(F.array(*map(F.lit, ("试验方法", "术语", "型号编制", "操作规程", "应用导则", "安全要求", "通用技术条件", "图样"))), (F.col("p_size") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", F.concat(code, F.lit(" "), _s("p_partkey"), F.lit("—"), (F.col("p_size") + 1990).cast("string")).alias("number"), F.concat(F.lit("电机"), kind).alias("title"))


_PARTS = """
SELECT p_partkey, p_size, ['GB/T', 'GB', 'JB/T', 'DB11/T'][p_partkey % 4 + 1] AS code,
  ['试验方法', '术语', '型号编制', '操作规程', '应用导则', '安全要求', '通用技术条件', '图样'][p_size % 8 + 1] AS kind FROM part"""


@query(f"""
SELECT p_partkey, replace(code, '/', '_') || '_' || p_partkey || '-' || (p_size + 1990) AS stem, replace(code, '/', '_') || '_' || p_partkey || '-' || (p_size + 1990) AS escaped,
  code || ' ' || p_partkey || '-' || (p_size + 1990) AS found, replace(code, '/', '_') || '_' || p_partkey || '-' || (p_size + 1990) || '#Table_' || p_size AS table_id,
  replace(code, '/', '_') || '_' || p_partkey || '-' || (p_size + 1990) || '#' || p_size || '.1_a' AS clause_id FROM ({_PARTS})""")
def standard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File stems, identifiers and numbers found in text."""
    escaped = naming.escaped_number(F.col("number"))
    return _parts(spark, sf_dir).select(
        "p_partkey", naming.file_stem(F.col("number")).alias("stem"), escaped.alias("escaped"), naming.number_in_text(F.concat(F.lit("见 "), "number", F.lit(" 的规定"))).alias("found"),
        naming.element_id(escaped, naming.element_path(F.lit("table"), F.concat(_s("p_size"), F.lit(")")))).alias("table_id"),
        naming.element_id(escaped, naming.clause_path(F.concat(_s("p_size"), F.lit(".1")), F.array(F.lit("a)")))).alias("clause_id"),
    )


@query(f"""
SELECT p_partkey, CASE kind WHEN '试验方法' THEN '方法标准' WHEN '术语' THEN '术语标准' WHEN '型号编制' THEN '分类标准' WHEN '操作规程' THEN '规程标准' WHEN '应用导则' THEN '指南标准' WHEN '安全要求' THEN '安全标准' WHEN '通用技术条件' THEN '产品标准' ELSE '其他标准' END AS kind,
  CASE kind WHEN '操作规程' THEN '规程' WHEN '应用导则' THEN '导则' WHEN '安全要求' THEN '安全' WHEN '图样' THEN '' ELSE kind END AS basis, true AS fits FROM ({_PARTS})""")
def title_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What kind of standard each title names."""
    held = _parts(spark, sf_dir).withColumn("k", titles.kind_of(F.col("title")))
    return held.select("p_partkey", "k.kind", "k.basis", titles.fits_kind(F.col("title"), F.col("k.kind")).alias("fits"))


@query("SELECT p_partkey, '电机' AS subject, kind AS remainder FROM (" + _PARTS + ")")
def title_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest known subject in each title."""
    lexicon = spark.createDataFrame([("电机",), ("旋转电机",), ("泵",), ("机",)], "word string")
    return titles.subjects(_parts(spark, sf_dir), lexicon, "p_partkey")


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sentence for each order line that cites a standard, and another after it."""
    o = table(spark, sf_dir, "lineitem")
    lead = F.when(F.col("l_returnflag") == "R", "应符合 ").when(F.col("l_returnflag") == "A", "参见 ").otherwise("采用 ")
    text = F.concat(lead, F.lit("GB/T "), _s("l_partkey"), F.lit("—20"), F.lpad((F.col("l_quantity").cast("int") % 30).cast("string"), 2, "0"), F.lit(",5."), _s("l_linenumber"), F.lit("。图样见表"), _s("l_linenumber"), F.lit("。"))
    return o.select("l_orderkey", "l_linenumber", text.alias("text"), F.lit("paragraph").alias("presentation"), F.lit("5").alias("clause_number"), F.lit("要求").alias("clause_title"), F.lit(False).alias("example"), F.lit(False).alias("guide"))


@query("""
SELECT l_orderkey, l_linenumber, 'GB_T_' || l_partkey AS standard_id, '20' || lpad(CAST(CAST(floor(l_quantity) AS INTEGER) % 30 AS VARCHAR), 2, '0') AS version, '5.' || l_linenumber AS cited_part, 'dated' AS kind,
  CASE WHEN l_returnflag = 'R' THEN 'normative' ELSE 'informative' END AS nature FROM lineitem""")
def external_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations with version, clause and nature."""
    return citations.external(_cited(spark, sf_dir), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "standard_id", "version", "cited_part", "kind", "nature")


@query("SELECT l_orderkey, l_linenumber, 'internalTable' AS target_type, CAST(l_linenumber AS VARCHAR) AS number FROM lineitem")
def internal_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of a document's own tables."""
    return citations.internal(_cited(spark, sf_dir), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "target_type", "number")


def _citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as citations; finished ones are the list."""
    key = F.concat(F.lit("GB_T_"), (F.col("o_orderkey") % 40).cast("string"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("."), (F.col("o_orderkey") % 2 + 1).cast("string"))).otherwise(""))
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("pos"), F.lit(0).alias("match_no"), key.alias("standard_id"), F.lit(None).cast("string").alias("version"), F.lit("undated").alias("kind"), F.lit("normative").alias("nature"), (F.col("o_orderstatus") == "F").alias("in_list"))


_CITATIONS = """
SELECT o_custkey AS doc_id, o_orderkey AS pos, 'GB_T_' || (o_orderkey % 40) || CASE WHEN o_orderkey % 3 = 0 THEN '.' || (o_orderkey % 2 + 1) ELSE '' END AS standard_id, o_orderstatus = 'F' AS in_list FROM orders"""


@query(f"""
WITH c AS ({_CITATIONS})
SELECT doc_id, standard_id, min(pos) AS pos FROM c l WHERE in_list AND NOT EXISTS (SELECT 1 FROM c b WHERE b.doc_id = l.doc_id AND NOT b.in_list AND b.standard_id = l.standard_id) GROUP BY ALL""")
def listed_but_uncited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List entries that the text never cites."""
    return references.listed_but_uncited(_citations(spark, sf_dir)).select("doc_id", "standard_id", "pos")


@query(f"""
WITH c AS ({_CITATIONS})
SELECT doc_id, standard_id, min(pos) AS pos FROM c b WHERE NOT in_list AND NOT EXISTS (
  SELECT 1 FROM c l WHERE l.doc_id = b.doc_id AND l.in_list AND (l.standard_id = b.standard_id OR starts_with(l.standard_id, b.standard_id || '.') OR starts_with(b.standard_id, l.standard_id || '.'))) GROUP BY ALL""")
def cited_but_unlisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations that no list entry covers."""
    return references.cited_but_unlisted(_citations(spark, sf_dir))


#: Orders whose documents one task makes and parses. An order is a few bytes, but eight lines of Markdown with all that is told
#: of each, so partitions sized by the orders' bytes would hold ever more lines.
ORDERS_A_TASK = 25_000


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown document for each customer: front matter, a chapter, a table, and a clause for each order with gaps left open."""
    o = table(spark, sf_dir, "orders")
    o = o.repartition(-(-o.count() // ORDERS_A_TASK) or 1, "o_custkey")
    n = F.col("n")
    clauses = o.selectExpr("o_custkey", "o_orderkey", "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r").selectExpr("o_custkey", "r", "r + (CASE WHEN r >= 3 THEN 1 ELSE 0 END) AS n", "o_orderkey")
    line = F.concat(F.lit("### 2."), n.cast("string"), F.lit(" 条款\n\n见表"), n.cast("string"), F.lit("。不大于 "), _s("o_orderkey"), F.lit("\n\n- 甲\n- 乙\n"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", line.alias("t")))), lambda s: s["t"]), "\n")
    made = clauses.groupBy(F.col("o_custkey").alias("doc_id")).agg(body.alias("_body"))
    head = F.concat(F.lit("---\ntitle: 客户"), _s("doc_id"), F.lit("\n---\n# 客户"), _s("doc_id"), F.lit("\n\n## 前言\n\n说明。\n\n## 1 范围\n\n| 甲 | 乙 |\n| --- | --- |\n| 1 |\n\n## 2 要求\n\n"))
    return source.with_front_matter(made.select("doc_id", F.concat(head, "_body").alias("text")))


_DOCUMENTS = """
SELECT o_custkey AS doc_id, r, r + CASE WHEN r >= 3 THEN 1 ELSE 0 END AS n FROM (
  SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders)"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.blocks(_documents(spark, sf_dir).select("doc_id", F.col("body").alias("text")))


@query(f"""
WITH d AS (SELECT doc_id, count(*) AS c FROM ({_DOCUMENTS}) GROUP BY doc_id)
SELECT doc_id, 'heading' AS kind, c + 4 AS n_blocks FROM d UNION ALL SELECT doc_id, 'paragraph', c + 1 FROM d UNION ALL SELECT doc_id, 'list', c FROM d UNION ALL SELECT doc_id, 'table', 1 FROM d""")
def markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of each kind of Markdown documents."""
    return _blocks(spark, sf_dir).groupBy("doc_id", "kind").agg(F.count("*").alias("n_blocks"))


@query(f"SELECT doc_id, '2.' || n AS number, '2' AS parent_number, 'clause' AS node_type FROM ({_DOCUMENTS})")
def section_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chapter that each clause hangs under."""
    nodes = markdown.sections(_blocks(spark, sf_dir)).filter("kind = 'heading'")
    up = nodes.select("doc_id", F.col("pos").alias("parent_pos"), F.col("number").alias("parent_number"))
    return nodes.filter("node_type = 'clause'").join(up, ["doc_id", "parent_pos"]).select("doc_id", "number", "parent_number", "node_type")


@query(f"SELECT doc_id, '2.3' AS subject, 'GBT-H03' AS rule_id, 'fail' AS status FROM ({_DOCUMENTS}) GROUP BY doc_id HAVING max(r) >= 3")
def numbering_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clauses that the numbering skips."""
    return rules.verdicts(rules.numbering(markdown.sections(_blocks(spark, sf_dir)))).select("doc_id", "subject", "rule_id", "status")


@query(f"SELECT doc_id, count(*) || ' limits without a unit' AS message FROM ({_DOCUMENTS}) GROUP BY doc_id")
def unit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits that end in a bare number."""
    return rules.limits_without_unit(_blocks(spark, sf_dir)).select("doc_id", "message")


@query(f"SELECT doc_id, unnest(['x', 'title', 'order', 'scope']) AS check_id, unnest(['unresolved', 'pass', CASE WHEN max(r) >= 3 THEN 'warning' ELSE 'pass' END, 'pass']) AS state FROM ({_DOCUMENTS}) GROUP BY doc_id")
def declared_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared checks run as data."""
    docs, blocks = _documents(spark, sf_dir), _blocks(spark, sf_dir)
    given = {"documents": docs, "blocks": blocks, "nodes": markdown.sections(blocks).filter("node_type IS NOT NULL")}
    specs = [{"id": "x", "operator": "unheard_of"}, {"id": "title", "operator": "non_empty", "target": "title"}, {"id": "order", "operator": "sibling_numbers_contiguous", "severity": "should"}, {"id": "scope", "operator": "contains_node_title", "expected": "范围"}]
    return rules.audited(given, specs).select("doc_id", "check_id", "state")


@query(f"SELECT DISTINCT doc_id, unnest([0, 0, 1, 1]) AS row, unnest([0, 1, 0, 1]) AS col, unnest(['甲', '乙', '1', '']) AS cell FROM ({_DOCUMENTS})")
def padded_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of pipe tables, short rows filled up."""
    return markdown.padded(markdown.cells(_blocks(spark, sf_dir))).select("doc_id", F.col("row").cast("int").alias("row"), "col", "cell")


@query(f"SELECT DISTINCT doc_id, unnest(['foreword', 'scope', 'requirements']) AS code, unnest(['front', 'body', 'body']) AS part FROM ({_DOCUMENTS})")
def element_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What element each top-level node is."""
    return catalog.elements(markdown.sections(_blocks(spark, sf_dir))).select("doc_id", "code", "part")


@query(f"SELECT doc_id, '客户' || doc_id AS title, 1 + 3 AS body_line, CAST(count(*) AS INTEGER) AS n_clauses FROM ({_DOCUMENTS}) GROUP BY doc_id")
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and where the body begins."""
    return _documents(spark, sf_dir).select("doc_id", F.col("meta")["title"].alias("title"), "body_line", (F.size(F.split("body", "### ")) - 1).alias("n_clauses"))


@query("""
SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 2 = 0 THEN '按 GB/T ' || c_custkey || ' 执行' ELSE '按 JB ' || c_custkey || ' 执行' END AS text, 'CSM-OCR-003' AS issue FROM customer""")
def spacing_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Designators parted from their numbers."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("按 "), F.when(F.col("c_custkey") % 2 == 0, "GB/T").otherwise("JB"), _s("c_custkey"), F.lit(" 执行")).alias("text"))
    return repair.spaced_numbers(c)


@query("SELECT p_partkey, '见（表' || p_size || '），下同。' AS text FROM part")
def punctuation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-width punctuation beside Han text."""
    text = F.concat(F.lit("见(表"), _s("p_size"), F.lit("),下同."))
    return table(spark, sf_dir, "part").select("p_partkey", repair.body_punctuation(text).alias("text"))


@query("""
SELECT s_suppkey, unnest([0, 0, 1]) AS row, unnest([0, 1, 1]) AS col, unnest([s_name, '—', CAST(s_nationkey AS VARCHAR)]) AS cell, unnest([2, 1, 1]) AS rowspan FROM supplier""")
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of HTML tables on absolute rows and columns."""
    page = F.concat(F.lit("<table><tr><td rowspan='2'>"), "s_name", F.lit("</td><td>-</td></tr><tr><td>"), _s("s_nationkey"), F.lit("</td></tr></table>"))
    return html.table_cells(table(spark, sf_dir, "supplier").select("s_suppkey", page.alias("html")), "s_suppkey").select("s_suppkey", "row", "col", "cell", "rowspan")


@query("""
SELECT '<urn:doc:n' || n_nationkey || '>' AS s, unnest(['a', 'ssir:title', 'ssir:parent']) AS p, unnest(['ssir:nation', '"' || n_name || '"', '<urn:doc:r' || n_regionkey || '>']) AS o FROM nation""")
def graph_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of nodes."""
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), _s("n_nationkey")).alias("element_id"), F.concat(F.lit("r"), _s("n_regionkey")).alias("parent_id"), F.lit("nation").alias("node_type"), F.col("n_name").alias("title"))
    return sinks.triples(n)
