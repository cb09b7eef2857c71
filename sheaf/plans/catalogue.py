"""Every registered query of the engine beside its SQL.

Each query applies an operator to a whole driver table; the SQL says the same
for DuckDB, with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.operators import checks, graph, joins, lines, tree
from sheaf.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Lines as the engine cuts them, in SQL; the driver's texts end lines with line feeds only.
_LINES = """
SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS parts FROM documents WHERE length(text) > 0)"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- lines and blocks


@query(f"""
WITH l AS ({_LINES})
SELECT doc_id,
  CASE WHEN trim(line) = '' THEN 'blank' WHEN regexp_matches(line, '^#{{1,6}} ') THEN 'heading' WHEN regexp_matches(line, '^[|]|[|]$') THEN 'table' WHEN regexp_matches(line, '^([-*+]|[0-9]+[.)]) ') THEN 'list' ELSE 'paragraph' END AS kind,
  count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM l GROUP BY ALL""")
def block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each kind in each document."""
    kind = F.when(F.trim("line") == "", "blank").when(F.col("line").rlike("^#{1,6} "), "heading").when(F.col("line").rlike(r"^[|]|[|]$"), "table").when(F.col("line").rlike("^([-*+]|[0-9]+[.)]) "), "list").otherwise("paragraph")
    cut = lines.lines(table(spark, sf_dir, "documents")).withColumn("kind", kind)
    return cut.groupBy("doc_id", "kind").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"))


@query(f"""
WITH l AS ({_LINES}), m AS (SELECT *, trim(line) = '' AS blank FROM l),
r AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, blank ORDER BY pos) AS run FROM m),
g AS (SELECT doc_id, min(pos) AS start_line, max(pos) AS end_line, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM r WHERE NOT blank GROUP BY doc_id, run)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start_line) AS INTEGER) AS block, CAST(start_line AS INTEGER) AS start_line, CAST(end_line AS INTEGER) AS end_line, n_lines, n_chars FROM g""")
def block_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph blocks: runs of lines between blank ones."""
    return lines.paragraphs(table(spark, sf_dir, "documents"))


@query(f"""
WITH l AS ({_LINES})
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char,
  CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(line) AS BIGINT) AS end_char
FROM l""")
def canonical_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each line stands in its document's text."""
    return lines.ledger(lines.lines(table(spark, sf_dir, "documents"))).select("doc_id", "pos", "start_char", "end_char")


@query("""
WITH s AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[。！？.!?]')) AS sentence FROM documents)
SELECT doc_id, count(*) AS n_sentences, CAST(max(length(trim(sentence))) AS INTEGER) AS longest FROM s WHERE trim(sentence) <> '' GROUP BY doc_id""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of each document and the longest one."""
    return lines.sentences(table(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.max(F.length("sentence")).alias("longest"))


@query(f"""
WITH l AS ({_LINES}), m AS (SELECT *, max(CASE WHEN length(line) >= 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS broken FROM l)
SELECT doc_id, count_if(broken = 0) AS n_skipped FROM m WHERE pos > 0 GROUP BY doc_id""")
def leading_short_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines after the first that are skipped until one is too long, as a table of contents is."""
    cut = lines.lines(table(spark, sf_dir, "documents"))
    first_fits = F.col("pos") == 0
    held = lines.until_broken(cut.withColumn("_long", F.length("line") >= 200), first_fits & ~F.col("_long"), ~F.col("_long"))
    return held.filter("pos > 0").groupBy("doc_id").agg(F.count_if("skipped").alias("n_skipped"))


@query("""
SELECT conv_id, CASE WHEN n_best >= 2 AND n_best * 2 > n_all THEN role END AS majority, n_best, CAST(n_all AS BIGINT) AS n_all
FROM (SELECT conv_id, role, count(*) AS n_best, sum(count(*)) OVER (PARTITION BY conv_id) AS n_all,
        row_number() OVER (PARTITION BY conv_id ORDER BY count(*) DESC, role DESC) AS rn
      FROM conversations GROUP BY conv_id, role) WHERE rn = 1""")
def marker_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The role that most turns of a conversation have, none on a tie."""
    return lines.majority(table(spark, sf_dir, "conversations"), "conv_id", "role")


@query("""
SELECT page_id, lower(m[1]) AS tag, count(*) AS n_tags
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<(h1|h2|p|ul|li|nav|script|footer|table|tr|td)[ >]', 1)) AS t FROM pages) x, LATERAL (SELECT [x.t] AS m) GROUP BY ALL""")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening block tags of each page."""
    tags = F.regexp_extract_all("html", F.lit("<(h1|h2|p|ul|li|nav|script|footer|table|tr|td)[ >]"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(tags).alias("tag")).groupBy("page_id", F.lower("tag").alias("tag")).agg(F.count("*").alias("n_tags"))


# ---- checks


@query("""
WITH n AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
b AS (SELECT l_orderkey, l_linenumber AS n, lag(l_linenumber, 1, 0) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM n)
SELECT l_orderkey, unnest(range(before + 1, n)) AS missing FROM b WHERE n - before > 1""")
def numbering_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers that orders lack below their largest one."""
    return checks.numbering_gaps(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", 1)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that occur twice."""
    return checks.repeated(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that no large order names."""
    return checks.dangling(table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "orders").filter("o_totalprice > 250000"), "o_custkey").select("c_custkey", "c_name")


@query("""
SELECT doc_id, element_id, is_repeat FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY source || '#' || lang ORDER BY doc_id) AS n, source || '#' || lang AS path,
    CASE WHEN n = 1 THEN path ELSE path || '-' || n END AS element_id, n > 1 AS is_repeat FROM documents)""")
def element_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers from paths, repeats numbered in order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("#", "source", "lang").alias("path"))
    return checks.suffixed_ids(docs, "path", "doc_id", part=F.floor(F.col("doc_id") / 4096)).select("doc_id", "element_id", "is_repeat")


@query("""
SELECT p_partkey, p_brand FROM part WHERE NOT EXISTS (
  SELECT 1 FROM supplier WHERE lower(replace(s_name, ' ', '')) = lower(replace('Supplier#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0'), ' ', '')))""")
def list_vs_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed names that nothing cites, compared without white space and case."""
    listed = table(spark, sf_dir, "part").withColumn("name", F.concat(F.lit("Supplier#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")))
    return checks.unmatched(listed, "name", table(spark, sf_dir, "supplier"), "s_name").select("p_partkey", "p_brand")


@query("""
WITH listed AS (SELECT DISTINCT replace(p_type, ' ', '.') AS k FROM part WHERE p_size = 1 AND p_brand = 'Brand#11'),
rows AS (SELECT p_partkey, replace(p_type, ' ', '.') AS k FROM part)
SELECT p_partkey, k AS type_key FROM rows r WHERE NOT EXISTS (
  SELECT 1 FROM listed l WHERE r.k = l.k OR starts_with(r.k, l.k || '.') OR starts_with(l.k, r.k || '.'))""")
def prefix_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited keys that no listed key equals, begins or extends."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_type", " ", ".").alias("type_key"), "p_size", "p_brand")
    return checks.uncovered(part.drop("p_size", "p_brand"), "type_key", part.filter("p_size = 1 AND p_brand = 'Brand#11'").select("type_key"), "type_key")


@query("""
SELECT o_custkey, count(*) AS n_citations, arg_min(o_orderpriority, o_orderkey) AS first_version, min(o_orderkey) AS first_order,
  CASE WHEN bool_or(o_orderstatus = 'F') THEN 'normative' ELSE 'informative' END AS nature FROM orders GROUP BY o_custkey""")
def six_tuple_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations summed up by target: first seen wins, one normative citation makes it normative."""
    orders = table(spark, sf_dir, "orders").withColumn("normative", F.col("o_orderstatus") == "F")
    return checks.summary_by_target(orders, "o_custkey", "o_orderkey", "o_orderpriority", "normative")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS subject, 'ORDER-TOTAL' AS rule_id, 'must' AS priority, 'total is not positive' AS message, 'fail' AS status FROM orders WHERE o_totalprice <= 0
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'LINE-DISCOUNT', 'should', 'discount over a tenth', 'warning' FROM lineitem WHERE l_discount >= 0.1
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'CUSTOMER-BALANCE', 'must', 'balance is negative', 'fail' FROM customer WHERE c_acctbal < 0""")
def union_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of several rules; only a must fails."""
    return checks.findings(
        (table(spark, sf_dir, "orders").filter("o_totalprice <= 0"), "o_orderkey", "ORDER-TOTAL", "must", F.lit("total is not positive")),
        (table(spark, sf_dir, "lineitem").filter("l_discount >= 0.1"), "l_orderkey", "LINE-DISCOUNT", "should", F.lit("discount over a tenth")),
        (table(spark, sf_dir, "customer").filter("c_acctbal < 0"), "c_custkey", "CUSTOMER-BALANCE", "must", F.lit("balance is negative")),
    )


@query("""
WITH e(position, element) AS (VALUES (0, 'en'), (1, 'de'), (2, 'zh'), (3, 'es'), (4, 'fr'), (5, 'pt'))
SELECT position, element, count(lang) > 0 AS present, count(lang) AS n_rows FROM e LEFT JOIN documents ON lang = element GROUP BY ALL""")
def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which expected languages the documents have."""
    return checks.coverage(table(spark, sf_dir, "documents"), "lang", ["en", "de", "zh", "es", "fr", "pt"])


@query("""
SELECT l_suppkey, list_sort(list(l_quantity))[CAST(least(count(*), floor(0.8 * count(*)) + 1) AS INTEGER)] AS demand, count(*) AS n_values FROM lineitem GROUP BY l_suppkey""")
def percentile_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value at the rank of four fifths, not interpolated."""
    return checks.rank_percentile(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity").withColumn("n_values", F.col("n_values").cast("long"))


@query("""
SELECT o_custkey, list_sort(list(o_totalprice))[CAST(floor(count(*) / 2) + 1 AS INTEGER)] AS median, count(*) AS n_values FROM orders GROUP BY o_custkey""")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper median of order totals."""
    return checks.upper_median(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice").withColumn("n_values", F.col("n_values").cast("long"))


@query("""
(SELECT n_regionkey AS k, 'left' AS side FROM nation EXCEPT ALL SELECT r_regionkey, 'left' FROM region)
UNION ALL (SELECT r_regionkey, 'right' FROM region EXCEPT ALL SELECT n_regionkey, 'right' FROM nation)""")
def schema_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What either list has over the other, repeats counted."""
    return checks.set_difference(table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k")), table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k")))


# ---- trees, graphs and catalogues


_EVENTS = "SELECT user_id, event_id AS pos, CASE event_type WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'view' THEN 1 ELSE NULL END AS depth FROM events"


@query(f"""
WITH e AS ({_EVENTS})
SELECT user_id, pos, (SELECT max(p.pos) FROM e p WHERE p.user_id = e.user_id AND p.pos < e.pos AND p.depth IS NOT NULL AND (e.depth IS NULL OR p.depth < e.depth)) AS parent_pos FROM e""")
def asof_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest earlier row of smaller depth, for every event of a user."""
    depth = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "view", 1)
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("pos"), depth.alias("depth"))
    return tree.parents(rows, "depth", "user_id", "pos", 3).drop("depth")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation, supplier = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    named = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    return graph.nodes_of(
        (region.withColumn("id", named("r", "r_regionkey")), "region", "id", F.lit(None), F.col("r_name")),
        (nation.withColumn("id", named("n", "n_nationkey")), "nation", "id", named("r", "n_regionkey"), F.col("n_name")),
        (supplier.withColumn("id", named("s", "s_suppkey")), "supplier", "id", named("n", "s_nationkey"), F.col("s_name")),
    )


_NODES = """
SELECT 'r' || r_regionkey AS id, 'region' AS kind, NULL AS parent, substring(r_name, 1, 400) AS title FROM region
UNION ALL SELECT 'n' || n_nationkey, 'nation', 'r' || n_regionkey, n_name FROM nation
UNION ALL SELECT 's' || s_suppkey, 'supplier', 'n' || s_nationkey, s_name FROM supplier"""


@query(_NODES)
def kg_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph nodes of three tables."""
    return _places(spark, sf_dir)


@query(f"SELECT DISTINCT parent AS source, id AS target, 'HAS_CHILD' AS type FROM ({_NODES}) WHERE parent IS NOT NULL")
def kg_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from parents."""
    return graph.edges_of(_places(spark, sf_dir))


@query(f"""
SELECT kind AS name, count(*) AS n, 'node' AS what FROM ({_NODES}) GROUP BY kind
UNION ALL SELECT 'HAS_CHILD', count(*), 'edge' FROM (SELECT DISTINCT parent, id FROM ({_NODES}) WHERE parent IS NOT NULL)""")
def kg_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by kind and edges by type."""
    nodes = _places(spark, sf_dir)
    return graph.counts(nodes, graph.edges_of(nodes))


@query(f"SELECT DISTINCT e.parent AS source, e.id AS target, 'HAS_CHILD' AS type FROM ({_NODES}) e WHERE e.parent IS NOT NULL AND e.kind <> 'supplier'")
def kg_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the graph without suppliers."""
    nodes = _places(spark, sf_dir)
    return graph.core(nodes, graph.edges_of(nodes), ["supplier"])[1]


@query(f"""
WITH RECURSIVE n AS ({_NODES}), up AS (
  SELECT id AS node, parent AS ancestor, 1 AS distance FROM n WHERE parent IS NOT NULL
  UNION ALL SELECT up.node, n.parent, distance + 1 FROM up JOIN n ON n.id = up.ancestor WHERE n.parent IS NOT NULL)
SELECT node, ancestor, distance FROM up""")
def ancestor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ancestors of every node, from materialized paths."""
    return tree.ancestors(tree.paths(_places(spark, sf_dir), "id", "parent", deepest=4), "id")


@query(f"WITH n AS ({_NODES}) SELECT id, (SELECT count(*) FROM n c WHERE c.parent = n.id) AS child_count FROM n")
def children_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many children every node has."""
    return tree.child_counts(_places(spark, sf_dir), "id", "parent").select("id", "child_count")


@query("""
SELECT doc_id, list_transform(string_split(n, '.'), lambda x: TRY_CAST(x AS INTEGER)) AS segments
FROM (SELECT doc_id, (n_chars % 7) || '.' || (doc_id % 13) || '.' || source AS n FROM documents)""")
def number_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted numbers as integers to sort by."""
    number = F.concat_ws(".", (F.col("n_chars") % 7).cast("string"), (F.col("doc_id") % 13).cast("string"), "source")
    return table(spark, sf_dir, "documents").select("doc_id", tree.segments(number).alias("segments"))


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, lag(o_orderkey) OVER w AS before, lag(o_orderpriority) OVER w AS old FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, before AS replaces, old <> o_orderpriority AS changed FROM o WHERE before IS NOT NULL""")
def version_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version with the one it replaces, and whether its title changed."""
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.lag("o_orderkey").over(w).alias("replaces"), (F.lag("o_orderpriority").over(w) != F.col("o_orderpriority")).alias("changed"))
    return rows.filter("replaces IS NOT NULL")


@query("""
WITH n AS (SELECT o_custkey, o_orderpriority, CAST(row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS INTEGER) AS pos, o_orderstatus FROM orders)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.pos, b.pos) AS pos, a.o_orderpriority AS old_title, b.o_orderpriority AS new_title
FROM (SELECT * FROM n WHERE o_orderstatus = 'F') a FULL JOIN (SELECT * FROM n WHERE o_orderstatus = 'O') b ON a.o_custkey = b.o_custkey AND a.pos = b.pos
WHERE a.o_orderpriority IS DISTINCT FROM b.o_orderpriority""")
def outline_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outlines of each key side by side, where they differ."""
    n = F.row_number().over(W.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey"))
    rows = table(spark, sf_dir, "orders").withColumn("pos", n)
    return tree.outline_differences(rows.filter("o_orderstatus = 'F'"), rows.filter("o_orderstatus = 'O'"), "o_custkey", "pos", "o_orderpriority")


@query("""
SELECT c_custkey, c_name, n_orders, n_open, total FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, count_if(o_orderstatus = 'O') AS n_open, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def document_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional counts beside each identity."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return table(spark, sf_dir, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_name", "n_orders", "n_open", "total")


# ---- joins that aren't on equal keys


@query("""
WITH i AS (SELECT user_id, event_id AS id, event_type, value * 10 AS x0, value * 10 + 30 AS x1 FROM events),
m AS (SELECT a.user_id, a.id AS left_id, b.id AS right_id, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS overlap, b.x0, a.x1 - a.x0 AS wide
  FROM i a JOIN i b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'view')
SELECT user_id, left_id, right_id, round(overlap, 6) AS overlap FROM m WHERE overlap > 0 AND overlap >= 0.5 * wide
QUALIFY row_number() OVER (PARTITION BY user_id, left_id ORDER BY overlap DESC, x0, right_id) = 1""")
def range_overlap_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each interval the one it overlaps most, if by half."""
    i = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("id"), "event_type", (F.col("value") * 10).alias("x0"), (F.col("value") * 10 + 30).alias("x1"))
    return joins.best_overlap(i.filter("event_type = 'click'"), i.filter("event_type = 'view'"), "user_id", 0.5, 100.0).withColumn("overlap", F.round("overlap", 6))


@query("""
WITH g AS (SELECT user_id, event_id, value, CASE WHEN value - lag(value) OVER (PARTITION BY user_id ORDER BY value) > 5 THEN 1 ELSE 0 END AS new FROM events)
SELECT user_id, event_id, CAST(1 + sum(new) OVER (PARTITION BY user_id ORDER BY value) AS BIGINT) AS cluster FROM g""")
def baseline_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-dimensional clusters by gap."""
    return joins.clusters(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], "value", 5.0).select("user_id", "event_id", "cluster")


@query("""
WITH a AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT o_custkey, o_orderpriority AS body, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders WHERE o_orderstatus = 'O')
SELECT a.o_custkey, a.o_orderkey, coalesce(b.body, a.o_orderpriority) AS o_orderpriority, b.body IS NOT NULL AS replaced FROM a LEFT JOIN b USING (o_custkey, n, c)""")
def ordinal_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n-th body of one source in place of the other's, where both count alike."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    return joins.spliced(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), orders.filter("o_orderstatus = 'O'"), ["o_custkey"], "o_orderkey", "o_orderpriority")
