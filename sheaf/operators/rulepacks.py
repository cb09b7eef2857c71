"""Rule packs: declared checks in YAML files, layers that override each other, and audits that follow them.

A pack is a mapping with id and rules; a rule has id, category, requirement
(obligation, applicability), target (path), check (operator, expected) and
severity. Rules are rows, so that packs are joined, compared and overridden by
ordinary operators; only the rules in force, a file's worth, reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.operators import rules as ruled

RULES = "pack string, pack_version string, rule_id string, category string, operator string, target string, expected string, severity string, obligation string, applicability string, fault string"

# What a rule may demand of a document before it applies, and the default severity.
ALWAYS = "always"
STANDARD = "document.documentType == standard"
FACTS = ("has_numbered_sections", "has_numbered_clauses", "has_annexes", "has_internal_references", "has_table_references", "has_figure_references", "has_unknown_content")
SEVERITY = "warning"


def parsed(files: DataFrame, text: str = "text") -> DataFrame:
    """The rules of packs given as texts; a text that is no pack, or a rule without id or operator, is a row with a fault."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            out = []
            for body in batch[text]:
                try:
                    pack = yaml.safe_load(body or "")
                    listed = pack["rules"]
                except (yaml.YAMLError, KeyError, TypeError):
                    out.append([None] * 10 + ["no rule pack"])
                    continue
                default = (pack.get("execution-policy") or {}).get("default-severity", SEVERITY)
                for rule in listed or []:
                    rule = rule if isinstance(rule, dict) else {}
                    check, requirement = rule.get("check") or {}, rule.get("requirement") or {}
                    fault = None if rule.get("id") and check.get("operator") else "no id or operator"
                    expected = None if "expected" not in check else json.dumps(check["expected"], ensure_ascii=False)
                    out.append([pack.get("id"), str(pack.get("version", "")), rule.get("id"), rule.get("category"), check.get("operator"), (rule.get("target") or {}).get("path"), expected, rule.get("severity", default), requirement.get("obligation"), requirement.get("applicability", ALWAYS), fault])
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RULES.split(", ")])

    return files.select(text).mapInPandas(rows, RULES)


def read_packs(spark: SparkSession, path: str) -> DataFrame:
    """The rules of all packs below a folder."""
    return parsed(spark.read.text(path, wholetext=True, pathGlobFilter="*.yaml", recursiveFileLookup=True).withColumnRenamed("value", "text"))


def layered(rules: DataFrame, precedence: list[str]) -> DataFrame:
    """The rules in force: of several with one id, that of the pack named last; packs that aren't named come first."""
    rank = F.array_position(F.array(*map(F.lit, precedence)), F.col("pack")) if precedence else F.lit(0)
    best = F.row_number().over(W.partitionBy("rule_id").orderBy(F.coalesce(rank, F.lit(0)).desc(), F.col("pack").desc_nulls_last()))
    return rules.filter("fault IS NULL").withColumn("_n", best).filter("_n = 1").drop("_n")


def _with_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """doc_id, meta and facts: the rows of all tables are gathered once for each document."""
    kinds = {"internalClause": FACTS[3], "internalTable": FACTS[4], "internalFigure": FACTS[5]}
    told = [
        tables["nodes"].select("doc_id", F.explode(F.array_compact(F.array(F.when(F.col("number").isNotNull(), FACTS[0]), F.when(F.col("number").contains("."), FACTS[1]), F.when(F.col("node_type") == "annex", FACTS[2])))).alias("_fact")),
        *(tables["mentions"].filter(F.col("target_type") == kind).select("doc_id", F.lit(name).alias("_fact")) for kind, name in kinds.items()),
        tables["blocks"].filter("kind = 'unknown'").select("doc_id", F.lit(FACTS[6]).alias("_fact")),
    ]
    gathered = reduce(DataFrame.unionByName, told).groupBy("doc_id").agg(*(F.bool_or(F.col("_fact") == name).alias(name) for name in FACTS))
    standard = F.coalesce(F.try_element_at("meta", F.lit("document-type")) == "standard", F.lit(False))
    there = [F.when(F.col(name), F.lit(name)) for name in FACTS]
    own = tables["documents"].join(gathered, "doc_id", "left")
    return own.select(*tables["documents"].columns, F.array_compact(F.array(F.lit(ALWAYS), F.when(standard, F.lit(STANDARD)), *there)).alias("facts"))


def facts(tables: dict[str, DataFrame]) -> DataFrame:
    """doc_id and what holds for it, of the conditions that rules name."""
    return _with_facts(tables).select("doc_id", "facts")


def _key(path: str | None) -> str:
    """The front matter's key that a target names: the last name of its path, in the front matter's spelling."""
    name = (path or "").rsplit(".", 1)[-1]
    return "".join(f"-{c.lower()}" if c.isupper() else c for c in name)


def audit(tables: dict[str, DataFrame], rules: DataFrame) -> DataFrame:
    """doc_id, check_id, operator, state, category, severity and obligation of every rule in force on every document.

    States: pass, fail (severity must), warning, not-applicable (the document
    lacks what the rule presumes), unresolved (an unknown operator or condition).
    """
    found = _with_facts(tables)
    known = {ALWAYS, STANDARD, *FACTS}
    checks, in_force = [], rules.collect()  # a rule pack is a file that people write
    for rule in in_force:
        holds: Column = F.array_contains("facts", rule["applicability"])
        operator = rule["operator"] if rule["applicability"] in known else None
        check = {"id": rule["rule_id"], "operator": operator, "target": _key(rule["target"]), "severity": rule["severity"], "applies": holds}
        if rule["expected"] is not None:
            check["expected"] = json.loads(rule["expected"])
        checks.append(check)
    states = ruled.audited(tables | {"documents": found}, checks).drop("operator")
    own = found.sparkSession.createDataFrame([tuple(r[c] for c in ("rule_id", "operator", "category", "severity", "obligation")) for r in in_force], "check_id string, operator string, category string, severity string, obligation string")
    return states.join(F.broadcast(own), "check_id")
