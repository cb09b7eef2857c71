"""A corpus of Markdown documents as tables: what the command line and other jobs call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import citations, titles
from sheaf.functions.naming import escaped_number
from sheaf.operators import content, graph, markdown, references, repair, rules, tree
from sheaf.sources import markdown as source
from sheaf.sources import sinks


@dataclass
class Corpus:
    """The tables of a corpus; each is lazy."""

    documents: DataFrame
    rejected: DataFrame
    blocks: DataFrame
    nodes: DataFrame

    def tables(self) -> DataFrame:
        """Tables with their number from the caption before them."""
        own = markdown.folded_units(self.blocks).filter("kind = 'table'")
        number = F.regexp_extract("caption", r"^表\s*(\S+)", 1)
        return own.withColumn("number", F.when(number != "", number))

    def citations(self) -> DataFrame:
        """Citations of other standards with the chapter each stands in."""
        chapters = self.nodes.filter("kind = 'heading'").select("doc_id", F.col("pos").alias("parent_pos"), F.col("number").alias("clause_number"), F.col("title").alias("clause_title"))
        guide = self.documents.select("doc_id", F.coalesce(F.try_element_at("meta", F.lit("title")), F.lit("")).rlike("指南|导则").alias("guide"))
        carriers = self.nodes.filter("kind IN ('paragraph', 'list', 'note', 'footnote', 'example', 'table')").join(chapters, ["doc_id", "parent_pos"], "left").join(guide, "doc_id")
        carriers = carriers.withColumns({"presentation": content.presentation_of(F.col("kind")), "example": F.col("kind") == "example"})
        found = citations.external(carriers, ["doc_id", "pos", "clause_number", "clause_title"])
        return found.withColumn("in_list", citations.is_reference_chapter(F.col("clause_number"), F.col("clause_title"))).drop("clause_number", "clause_title")

    def mentions(self) -> DataFrame:
        """Mentions of a document's own tables, figures, formulas and clauses."""
        return citations.internal(self.blocks.filter("kind IN ('paragraph', 'list', 'note')"), ["doc_id", "pos"])

    def findings(self) -> DataFrame:
        """What the rules find."""
        cited = self.citations()
        uncited, unlisted = references.listed_but_uncited(cited), references.cited_but_unlisted(cited)
        return rules.verdicts(
            rules.cover_fields(self.documents), rules.element_order(self.nodes), rules.annex_letters(self.nodes), rules.numbering(self.nodes), rules.list_numbering(markdown.items(self.blocks)),
            rules.confusable_numbers(self.nodes.filter("kind = 'heading'")), rules.sibling_titles(self.nodes), rules.hanging_paragraphs(self.nodes), rules.note_leads(self.blocks),
            rules.limits_without_unit(self.blocks), content.reference_chapter(self.nodes, self.nodes), content.standard_names(self.documents),
            rules.unresolved(self.mentions(), self.tables().filter("number IS NOT NULL"), "internalTable", "GBT-X01"),
            rules.finding(uncited, F.col("standard_id"), "GBT-C06", "should", "listed but not cited"), rules.finding(unlisted, F.col("standard_id"), "GBT-C06", "should", "cited but not listed"),
        )

    def graph(self) -> tuple[DataFrame, DataFrame]:
        """Nodes and edges over all documents."""
        key = lambda pos: F.concat_ws("#", F.col("doc_id").cast("string"), pos.cast("string"))
        heads = self.nodes.filter("node_type IS NOT NULL").withColumn("id", key(F.col("pos")))
        bodies = self.nodes.filter("node_type IS NULL").withColumn("id", key(F.col("pos")))
        parent = F.coalesce(F.when(F.col("parent_pos").isNotNull(), key(F.col("parent_pos"))), F.col("doc_id").cast("string"))
        made = [(self.documents.withColumn("title", F.try_element_at("meta", F.lit("title"))), "document", "doc_id", F.lit(None), F.col("title"))]
        made += [(heads.filter(F.col("node_type") == k), k, "id", parent, F.concat_ws(" ", "number", "title")) for k in ("section", "clause", "subClause", "annex", "annexSection", "documentBlock")]
        nodes = graph.nodes_of(*made, (bodies, "content", "id", parent, F.col("text")))
        edges = graph.edges_of(nodes.filter("kind <> 'content'")).unionByName(graph.edges_of(nodes.filter("kind = 'content'"), "CONTAINS_ELEMENT"))
        return nodes, edges

    def catalogue(self) -> DataFrame:
        """One row for each document: identity, kind of standard, counts."""
        title = F.try_element_at("meta", F.lit("title"))
        counts = self.nodes.groupBy("doc_id").agg(F.count_if(F.col("node_type").isNotNull()).alias("node_count"), F.count_if(F.col("node_type").isNull()).alias("ce_count"))
        own = self.documents.select("doc_id", F.try_element_at("meta", F.lit("standard-number")).alias("standard_number"), title.alias("title"), titles.kind_of(title)["kind"].alias("kind"), "sha256")
        return own.withColumn("standard_id", escaped_number(F.col("standard_number"))).join(counts, "doc_id", "left")

    def structure(self) -> DataFrame:
        """Structure rows with their path from the root."""
        heads = self.nodes.filter("node_type IS NOT NULL").select("doc_id", "pos", "parent_pos", "node_type", "number", "title", "start_line")
        return tree.paths(heads, "pos", "parent_pos", ["doc_id"])


def punctuated(body: str) -> Column:
    """Texts with wide punctuation; only those with ASCII punctuation and other than ASCII characters go to Python."""
    has_both = F.col(body).rlike("[^\\x00-\\x7F]") & F.col(body).rlike("[,.:;!?()]")
    return F.coalesce(repair.body_punctuation(F.when(has_both, F.col(body))), F.col(body))


def parse(files: DataFrame, repaired: bool = True) -> Corpus:
    """The corpus of files given as doc_id and content."""
    read = source.decoded(files)
    documents = source.completed(source.with_front_matter(read.filter("NOT fatal")))
    body = documents.select("doc_id", (punctuated("body") if repaired else F.col("body")).alias("text"))
    blocks = markdown.blocks(body)
    if repaired:
        for step in (repair.guide_phrase, repair.spaced_numbers, repair.bracketed_entries, repair.raised_levels, repair.demoted_sentences, repair.lost_markers):
            blocks = step(blocks)
    return Corpus(documents, read.filter("fatal"), blocks, markdown.sections(blocks))


def read(spark: SparkSession, path: str, repaired: bool = True) -> Corpus:
    """The corpus of all Markdown files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(path)
    return parse(files.select(F.col("path").alias("doc_id"), "content"), repaired)


def replay(docs: DataFrame, change, text: str = "text") -> DataFrame:
    """doc_id, the text before and after a change, and the lines that either side has over the other.

    What a replay over a corpus may apply is for the caller to decide; nothing
    is written here.
    """
    both = docs.select("doc_id", F.col(text).alias("before")).join(change(docs).select("doc_id", F.col(text).alias("after")), "doc_id")
    cut = {k: F.split(k, "\n") for k in ("before", "after")}
    return both.withColumns({"removed": F.array_except(cut["before"], cut["after"]), "added": F.array_except(cut["after"], cut["before"])}).filter(~F.col("before").eqNullSafe(F.col("after")))


def write(corpus: Corpus, out: str) -> None:
    """All tables of a corpus below a folder.

    Files are parsed once: documents, blocks and nodes are written first, and
    all other tables come from what was written.
    """
    spark = corpus.blocks.sparkSession

    def put(name: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{out}/{name}")

    blocks = put("blocks", corpus.blocks)
    own = Corpus(put("documents", corpus.documents), put("rejected", corpus.rejected), blocks, put("nodes", markdown.sections(blocks)))
    nodes, edges = own.graph()
    for name, table in {"structure": own.structure(), "citations": own.citations(), "findings": own.findings(), "kg_nodes": nodes, "kg_edges": edges, "catalogue": own.catalogue(), "markdown": sinks.plain_markdown(own.blocks), "html": sinks.html(own.blocks)}.items():
        put(name, table)
