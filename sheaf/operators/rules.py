"""Quality rules over structure tables, and declared checks run as data.

Nodes have doc_id, pos, parent_pos, node_type, number and title. Each rule
returns its findings: doc_id, subject, rule_id, priority, message. ``verdicts``
adds the status; only a must fails.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.operators.checks import counted

FINDING = ["doc_id", "subject", "rule_id", "priority", "message"]
#: Lead-ins that notes and examples may have, units and counters
#: that a limit may carry.
NOTE_LEAD = r"(?U)^注\s*\d*\s*[:：]"
EXAMPLE_LEAD = r"(?U)^示例\s*\d*\s*[:：]?"
UNIT = r"(?:mm|cm|m|km|g|kg|s|min|h|d|%|‰|℃|°C|K|Pa|kPa|MPa|V|kV|mV|A|mA|W|kW|Hz|kHz|MHz|Ω|MΩ|N|dB|r/min|L|mL|m²|m³|mm²|倍|个|次|片|只|根|条|号)"
LIMIT = rf"(?U)(?:不大于|不小于|不超过|≥|≤)[^。；;\n]*?\d+(?:\.\d+)?(?![\d.])(?!\s*{UNIT})"
REQUIRED_META = ("standard-number", "title", "title-en", "ics", "ccs", "publication-date", "effective-date")


def finding(rows: DataFrame, subject: Column, rule: str, priority: str, message: Column | str) -> DataFrame:
    said = F.lit(message) if isinstance(message, str) else message
    return rows.select("doc_id", subject.cast("string").alias("subject"), F.lit(rule).alias("rule_id"), F.lit(priority).alias("priority"), said.alias("message"))


def cover_fields(meta: DataFrame) -> DataFrame:
    """Required metadata that is missing or blank; meta has doc_id and a map."""
    each = meta.select("doc_id", "meta", F.explode(F.array(*map(F.lit, REQUIRED_META))).alias("field"))
    return finding(each.filter(F.trim(F.coalesce(F.try_element_at("meta", F.col("field")), F.lit(""))) == ""), F.col("field"), "GBT-C01", "must", "required field is missing")


def element_order(nodes: DataFrame) -> DataFrame:
    """A foreword and a scope exist, and numbering begins with 1."""
    title = F.regexp_replace("title", r"(?U)\s+", "")
    facts = nodes.groupBy("doc_id").agg(
        F.count_if(title.startswith("前言")).alias("forewords"),
        F.count_if(title.contains("范围") & (F.length(title) <= 6)).alias("scopes"),
        F.min_by(F.when(F.col("node_type") == "section", F.col("number")), F.when(F.col("node_type") == "section", F.col("pos"))).alias("first"),
    )
    return reduce(DataFrame.unionByName, [
        finding(facts.filter("forewords = 0"), F.lit("foreword"), "GBT-E03", "must", "no foreword"),
        finding(facts.filter("scopes = 0"), F.lit("scope"), "GBT-E05", "must", "no scope"),
        finding(facts.filter("first <> '1'"), F.col("first"), "GBT-C05", "must", "first chapter is not 1"),
    ])


def annex_letters(nodes: DataFrame) -> DataFrame:
    """Letters missing between the first and the last annex."""
    code = nodes.filter("node_type = 'annex'").select("doc_id", F.ascii("number").alias("n")).distinct()
    gaps = code.withColumn("_before", F.lag("n").over(W.partitionBy("doc_id").orderBy("n"))).filter("n - _before > 1")
    each = gaps.select("doc_id", F.explode(F.sequence(F.col("_before") + 1, F.col("n") - 1)).alias("missing"))
    return finding(each, F.char("missing"), "GBT-C15", "must", "annex letter is skipped")


def numbering(nodes: DataFrame) -> DataFrame:
    """Gaps, repeats and foreign prefixes among the numbers of siblings, counted from the first one there.

    A node stands beside its siblings and, as their parent, before its children;
    one pass over the siblings by number finds all three.
    """
    last = F.element_at(F.split("number", r"\."), -1).try_cast("int")
    sibling = F.col("number").isNotNull() & (F.col("node_type") != "annex") & last.isNotNull()
    prefix = F.regexp_replace("number", r"\.?[^.]*$", "")
    as_child = F.when(sibling, F.struct(F.col("parent_pos").cast("long").alias("_at"), last.alias("_n"), prefix.alias("_prefix")))
    as_parent = F.when(F.col("number").isNotNull() & F.col("pos").isNotNull(), F.struct(F.col("pos").cast("long").alias("_at"), F.lit(None).cast("int").alias("_n"), F.lit(None).cast("string").alias("_prefix")))
    own = nodes.select("doc_id", "number", F.explode(F.array_compact(F.array(as_child, as_parent))).alias("_s")).select("doc_id", "number", "_s.*")
    family = W.partitionBy("doc_id", "_at")
    own = own.withColumn("_parent", F.max(F.when(F.col("_n").isNull(), F.col("number"))).over(family)).filter("_n IS NOT NULL")
    w = W.partitionBy("doc_id", "_at", "_prefix").orderBy("_n", "number")
    same = lambda k: F.coalesce((F.lag("_n", k).over(w) == F.col("_n")) & (F.lag("number", k).over(w) == F.col("number")), F.lit(False))
    held = own.withColumns({"_before": F.lag("_n").over(w), "_second": same(1) & ~same(2)})
    finding_of = lambda message, first, stop: F.struct(F.lit(message).alias("_message"), first.alias("_from"), stop.alias("_to"))
    found = F.array_compact(F.array(
        F.when(F.col("_n") - F.col("_before") > 1, finding_of("number is skipped", F.col("_before") + 1, F.col("_n") - 1)),
        F.when(F.col("_second"), finding_of("number is repeated", F.col("_n"), F.col("_n"))),
        F.when((F.col("_prefix") != "") & (F.col("_prefix") != F.col("_parent")), finding_of("number does not continue its parent's", F.col("_n"), F.col("_n"))),
    ))
    each = counted(held.select("doc_id", "number", "_prefix", F.explode(found).alias("_f")).select("doc_id", "number", "_prefix", "_f.*"), F.col("_from"), F.col("_to"), "_k")
    dotted = F.when(F.col("_prefix") == "", F.col("_k").cast("string")).otherwise(F.concat_ws(".", "_prefix", F.col("_k").cast("string")))
    return finding(each, F.when(F.col("_message") == "number is skipped", dotted).otherwise(F.col("number")), "GBT-H03", "must", F.col("_message"))


def list_numbering(items: DataFrame) -> DataFrame:
    """Gaps in lists whose markers are all letters or all digits, counted from the first one there."""
    bare = F.regexp_replace("marker", "[)）]$", "")
    n = F.when(F.col("marker_kind") == "digit", bare.try_cast("int")).when((F.col("marker_kind") == "letter") & (F.length(bare) == 1), F.ascii(F.lower(bare)) - 96)
    pure = F.size(F.collect_set("marker_kind").over(W.partitionBy("doc_id", "pos"))) == 1
    own = items.withColumn("_n", n).withColumn("_pure", pure).filter("_pure AND _n IS NOT NULL").select("doc_id", "pos", "_n").distinct()
    gaps = own.withColumn("_before", F.lag("_n").over(W.partitionBy("doc_id", "pos").orderBy("_n"))).filter("_n - _before > 1")
    return finding(counted(gaps, F.col("_before") + 1, F.col("_n") - 1, "_m"), F.concat_ws(":", F.col("pos").cast("string"), F.col("_m").cast("string")), "GBT-C14", "should", "list marker is skipped")


def confusable_numbers(nodes: DataFrame) -> DataFrame:
    """Numbers that mix digits with the letters O, I and l; the first three of a document are named."""
    odd = nodes.withColumn("_lead", F.regexp_extract(F.concat_ws(" ", "number", "title"), "^([0-9OIl.．]+)", 1)).filter(F.col("_lead").rlike("[OIl]") & F.col("_lead").rlike("[0-9]"))
    made = odd.groupBy("doc_id").agg(F.array_join(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_lead"))), lambda s: s["_lead"]), 1, 3), ", ").alias("first"), F.count("*").alias("n"))
    return finding(made, F.col("first"), "GBT-C16", "should", F.format_string("%d numbers mix digits and letters", "n"))


def sibling_titles(nodes: DataFrame) -> DataFrame:
    """Siblings of which some have a title and some none."""
    own = nodes.filter("node_type IN ('clause', 'subClause', 'annexSection')").groupBy("doc_id", "parent_pos").agg(F.count_if(F.coalesce("title", F.lit("")) == "").alias("bare"), F.count("*").alias("n"))
    return finding(own.filter("bare > 0 AND bare < n"), F.col("parent_pos"), "GBT-H04", "should", "titled and untitled siblings are mixed")


def hanging_paragraphs(blocks: DataFrame) -> DataFrame:
    """Nodes with both sub-nodes and paragraphs of their own; blocks and nodes are one table with parent_pos."""
    own = blocks.filter("parent_pos IS NOT NULL").groupBy("doc_id", "parent_pos").agg(F.count_if(F.col("node_type").isNotNull()).alias("nodes"), F.count_if(F.col("kind") == "paragraph").alias("paragraphs"))
    return finding(own.filter("nodes > 0 AND paragraphs > 0"), F.col("parent_pos"), "GBT-H05", "should", F.format_string("%d hanging paragraphs", "paragraphs"))


def note_leads(blocks: DataFrame) -> DataFrame:
    """Notes and examples that don't begin with their lead-in."""
    inner = F.regexp_replace("text", r"(?U)^>\s*", "")
    return finding(blocks.filter((F.col("kind") == "note") & ~inner.rlike(NOTE_LEAD)), F.col("pos"), "GBT-X03", "should", "note has no lead-in").unionByName(
        finding(blocks.filter((F.col("kind") == "example") & ~inner.rlike(EXAMPLE_LEAD)), F.col("pos"), "GBT-X05", "should", "example has no lead-in")
    )


def sequence_breaks(rows: DataFrame, number: str, rule: str, scope: list[str] | None = None) -> DataFrame:
    """The first row of each document, or scope, whose number isn't its rank from 1."""
    keys = ["doc_id", *(scope or [])]
    ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy("pos"))).filter(~F.col(number).cast("string").eqNullSafe(F.col("_rank").cast("string")))
    first = ranked.groupBy(*keys).agg(F.min_by(number, "pos").alias("_found"), F.min("_rank").alias("_want"))
    return finding(first, F.col("_found"), rule, "must", F.format_string("expected %d", "_want"))


def missing_numbers(blocks: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Blocks of some kinds without a number; kinds maps a kind to its rule."""
    rule = F.element_at(F.create_map(*(F.lit(v) for kv in kinds.items() for v in kv)), F.col("kind"))
    rows = blocks.filter(F.col("kind").isin(*kinds) & (F.coalesce("number", F.lit("")) == ""))
    return rows.select("doc_id", F.col("pos").cast("string").alias("subject"), rule.alias("rule_id"), F.lit("must").alias("priority"), F.concat(F.col("kind"), F.lit(" has no number")).alias("message"))


def limits_without_unit(blocks: DataFrame) -> DataFrame:
    """Limits that end in a bare number."""
    each = blocks.withColumn("_n", F.size(F.regexp_extract_all("text", F.lit(LIMIT), F.lit(0)))).groupBy("doc_id").agg(F.sum("_n").alias("n")).filter("n > 0")
    return finding(each, F.lit("limits"), "GBT-P10-R02", "should", F.format_string("%d limits without a unit", "n"))


def unresolved(mentions: DataFrame, targets: DataFrame, target_type: str, rule: str) -> DataFrame:
    """Mentions of a type whose number no target has; a dash counts as a dot."""
    known = targets.select("doc_id", F.translate("number", "-", ".").alias("_n")).distinct()
    own = mentions.filter(F.col("target_type") == target_type).withColumn("_n", F.translate("number", "-", ".")).join(known, ["doc_id", "_n"], "left_anti")
    return finding(own.select("doc_id", "number").distinct(), F.col("number"), rule, "must", "mentioned but not there")


def verdicts(*found: DataFrame) -> DataFrame:
    """All findings with their status."""
    return reduce(DataFrame.unionByName, (f.select(*FINDING) for f in found)).withColumn("status", F.when(F.col("priority") == "must", "fail").otherwise("warning"))


# ---- declared checks

#: Operators that a declared check may name. Each gives a condition on a document, or the documents that
#: pass (True) or fail (False) it as rows, of which a document may have several.
Check = Callable[[dict[str, DataFrame], dict], Column | tuple[bool, DataFrame]]


def _titles(tables: dict[str, DataFrame], words: list[str]) -> DataFrame:
    return tables["nodes"].filter(reduce(lambda a, b: a | b, (F.col("title").contains(w) for w in words)))


def _meta(name: str) -> Column:
    return F.coalesce(F.try_element_at("meta", F.lit(name)), F.lit(""))


def _mirrored(tables: dict[str, DataFrame], spec: dict) -> tuple[bool, DataFrame]:
    """Numbers under one chapter against those under another, chapter number aside."""
    chapter = F.split("number", r"\.")[0]
    sides = tables["nodes"].filter(chapter.isin(*spec["expected"][:2]) & F.col("number").contains(".")).select("doc_id", F.regexp_replace("number", r"^[^.]+\.?", "").alias("tail"), chapter.alias("_side"))
    if spec["expected"][0] == spec["expected"][1]:
        return False, sides.filter(F.lit(False))
    return False, sides.groupBy("doc_id", "tail").agg(F.min("_side").alias("_a"), F.max("_side").alias("_b")).filter("_a = _b")


OPERATORS: dict[str, Check] = {
    "non_empty": lambda t, s: F.trim(_meta(s["target"])) != "",
    "equals": lambda t, s: _meta(s["target"]) == s["expected"],
    "contains_node_title": lambda t, s: (True, _titles(t, [s["expected"]])),
    "contains_node_title_any": lambda t, s: (True, _titles(t, s["expected"])),
    "classification_marking_rules_present": lambda t, s: (True, _titles(t, s.get("expected") or ["分类", "标记"])),
    "first_numbered_node_equals": lambda t, s: (True, t["nodes"].filter("number IS NOT NULL").groupBy("doc_id").agg(F.min_by("number", "pos").alias("n")).filter(F.col("n") == s["expected"])),
    "sibling_numbers_contiguous": lambda t, s: (False, numbering(t["nodes"])),
    "clause_parent_exists": lambda t, s: (False, _orphans(t["nodes"])),
    "annex_kind_declared": lambda t, s: (False, t["nodes"].filter((F.col("node_type") == "annex") & ~F.coalesce(F.col("title").rlike("规范性|资料性"), F.lit(False)))),
    "internal_clause_references_resolve": lambda t, s: (False, unresolved(t["mentions"], t["nodes"].filter("number IS NOT NULL"), "internalClause", "x")),
    "table_references_resolve": lambda t, s: (False, unresolved(t["mentions"], t["tables"], "internalTable", "x")),
    "figure_references_resolve": lambda t, s: (False, unresolved(t["mentions"], t["figures"], "internalFigure", "x")),
    "each_has_source_anchor": lambda t, s: (False, t["nodes"].filter("start_line IS NULL OR end_line IS NULL")),
    "test_method_numbering_mirrors_requirements": _mirrored,
    "numeric_requirements_carry_units": lambda t, s: (False, limits_without_unit(t["blocks"])),
    "quantitative_requirements_have_test_methods": lambda t, s: (False, t["blocks"].filter(F.col("text").rlike("不大于|不小于|不超过|≥|≤")).select("doc_id").distinct().join(_titles(t, ["试验", "检验"]).select("doc_id").distinct(), "doc_id", "left_anti")),
}


def _orphans(nodes: DataFrame) -> DataFrame:
    """Dotted numbers whose parent number no node of the document has."""
    known = nodes.select("doc_id", F.col("number").alias("_up")).distinct()
    return nodes.filter(F.col("number").contains(".")).withColumn("_up", F.regexp_replace("number", r"\.[^.]*$", "")).join(known, ["doc_id", "_up"], "left_anti")


def audited(tables: dict[str, DataFrame], checks: list[dict]) -> DataFrame:
    """doc_id, check_id, operator and state of each declared check on each document.

    A check is {id, operator, target?, expected?, severity?, applies?}; one whose
    operator is unknown, or whose tables are not there, is unresolved, one that
    ``applies`` (a column) excludes not-applicable. What the checks find is
    gathered once for each document, so that one join serves all of them.
    """
    own, parts, states = tables["documents"], [], []
    for k, check in enumerate(checks):
        try:
            decided = OPERATORS[check["operator"]](tables, check)
        except KeyError:
            states.append(F.lit("unresolved"))
            continue
        fails = "fail" if check.get("severity", "must") == "must" else "warning"
        if isinstance(decided, Column):
            passed = F.coalesce(decided, F.lit(False))
        else:
            when, rows = decided
            parts.append(rows.select("doc_id", F.lit(k).alias("_check")))
            found = F.coalesce(F.col(f"_found{k}"), F.lit(False))
            passed = found if when else ~found
        state = F.when(passed, "pass").otherwise(fails)
        states.append(F.when(~F.coalesce(check["applies"], F.lit(False)), "not-applicable").otherwise(state) if "applies" in check else state)
    if parts:
        gathered = [F.bool_or(F.col("_check") == k).alias(f"_found{k}") for k in range(len(checks))]
        own = own.join(reduce(DataFrame.unionByName, parts).groupBy("doc_id").agg(*gathered), "doc_id", "left")
    each = [F.struct(F.lit(c["id"]).alias("check_id"), F.lit(c["operator"]).cast("string").alias("operator"), state.alias("state")) for c, state in zip(checks, states, strict=True)]
    return own.select("doc_id", F.explode(F.array(*each)).alias("_c")).select("doc_id", "_c.check_id", "_c.operator", "_c.state")
