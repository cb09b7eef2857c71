"""The list of references against what the text cites, and look-ups among citations.

Citations have doc_id, pos (document order), standard_id, version, kind and
nature, and in_list, which tells entries of the reference chapter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheaf.functions.citations import number_core, same_file_key
from sheaf.operators.checks import comparison_key, prefixes


def summary(citations: DataFrame) -> DataFrame:
    """One row for each standard that a document cites: times, first version and kind, nature, and all versions."""
    order = F.struct("pos", "match_no")
    return (
        citations.groupBy("doc_id", "standard_id")
        .agg(
            F.count("*").alias("n_citations"),
            F.min_by("version", F.when(F.col("version").isNotNull(), order)).alias("first_version"),
            F.min_by("kind", order).alias("first_kind"),
            F.when(F.bool_or(F.col("nature") == "normative"), "normative").otherwise("informative").alias("nature"),
            F.array_sort(F.collect_set("version")).alias("versions"),
            F.min("pos").alias("first_pos"),
        )
        .orderBy("doc_id", "standard_id")
    )


def list_entries(citations: DataFrame) -> DataFrame:
    """The first citation of each standard in the reference chapter."""
    rank = F.row_number().over(W.partitionBy("doc_id", "standard_id").orderBy("pos", "match_no"))
    return citations.filter("in_list").withColumn("_n", rank).filter("_n = 1").drop("_n").withColumn("key", same_file_key(F.col("standard_id")))


def listed_but_uncited(citations: DataFrame, normative_only: bool = False) -> DataFrame:
    """List entries that the body never cites, with citations of the same number under another designator."""
    body = citations.filter("NOT in_list").withColumn("key", same_file_key(F.col("standard_id")))
    used = body.filter("nature = 'normative'") if normative_only else body
    missing = list_entries(citations).join(used.select("doc_id", "key").distinct(), ["doc_id", "key"], "left_anti").withColumn("core", number_core(F.col("standard_id")))
    near = body.withColumn("core", number_core(F.col("standard_id"))).groupBy("doc_id", "core").agg(F.array_sort(F.collect_set("standard_id")).alias("near_misses"))
    return missing.join(near, ["doc_id", "core"], "left").select("doc_id", "standard_id", "pos", F.coalesce("near_misses", F.array().cast("array<string>")).alias("near_misses"))


def cited_but_unlisted(citations: DataFrame) -> DataFrame:
    """Normative citations of the body that no list entry covers, be it by key, by series or as all parts.

    A series covers its parts and a part its series; both sides explode their
    dotted beginnings, so the test is an equi-join.
    """
    entries = list_entries(citations).select("doc_id", "key").distinct()
    body = citations.filter("NOT in_list AND nature = 'normative' AND NOT coalesce(example, false)") if "example" in citations.columns else citations.filter("NOT in_list AND nature = 'normative'")
    rank = F.row_number().over(W.partitionBy("doc_id", "standard_id").orderBy("pos", "match_no"))
    own = body.withColumn("_n", rank).filter("_n = 1").withColumn("key", same_file_key(F.col("standard_id")))
    below = own.select("doc_id", "key", F.explode(prefixes(F.col("key"))).alias("_p")).join(entries.withColumnRenamed("key", "_p"), ["doc_id", "_p"]).select("doc_id", "key")
    above = entries.select("doc_id", F.explode(prefixes(F.col("key"))).alias("key"))
    return own.join(below.unionByName(above).distinct(), ["doc_id", "key"], "left_anti").select("doc_id", "standard_id", "pos")


def citing(citations: DataFrame, needle: str) -> DataFrame:
    """Citations of a standard given by its number or identifier, white space and case aside."""
    clean = F.lower(F.regexp_replace(F.lit(needle), r"(?U)[\s_/]", ""))
    raw = F.lower(F.regexp_replace("raw", r"(?U)[\s_/]", "")) if "raw" in citations.columns else F.lit("")
    return citations.filter((F.lower(F.regexp_replace("standard_id", r"(?U)[\s_/]", "")) == clean) | (raw == clean))


def resolved(mentions: DataFrame, registry: DataFrame) -> DataFrame:
    """Internal mentions with the target of their type and number, a dash counting as a dot; the first of each number.

    mentions have doc_id, pos, target_type, number; the registry doc_id,
    target_type, number and target_id.
    """
    clean = lambda d: d.withColumn("_n", F.translate("number", "-", "."))
    rank = F.row_number().over(W.partitionBy("doc_id", "target_type", "number", "source_id").orderBy("pos", "match_no"))
    first = clean(mentions.withColumn("_r", rank).filter("_r = 1").drop("_r"))
    targets = clean(registry).groupBy("doc_id", "target_type", "_n").agg(F.min("target_id").alias("target_id"))
    return first.join(targets, ["doc_id", "target_type", "_n"], "left").withColumn("status", F.when(F.col("target_id").isNull(), "unresolved").otherwise("resolved")).drop("_n")


def graph_references(citations: DataFrame) -> DataFrame:
    """doc_id and the reference chapter's standards by first hit, sorted by number."""
    return list_entries(citations).select("doc_id", "standard_id", "pos").orderBy("doc_id", comparison_key(F.col("standard_id")))
