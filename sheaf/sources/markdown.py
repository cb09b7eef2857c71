"""Markdown documents: files in, text with its front matter out; what can't be read is set aside."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULTS = {"csm-version": "0.3", "document-type": "standard", "rendering-profile": "default"}


def read_markdown(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """path, sha256, text, encoding issues and whether the file is fatal, of all files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return decoded(files.select(F.col("path").alias("doc_id"), "content"))


def decoded(files: DataFrame) -> DataFrame:
    """doc_id, sha256, text, fatal and issues of files given as doc_id and content.

    A byte order mark and CR line ends are repaired and reported; bytes that
    aren't UTF-8 make a file fatal, with a null text.
    """
    text = F.make_valid_utf8(F.col("content").cast("string"))
    bad = ~F.is_valid_utf8(F.col("content").cast("string"))
    marked, returned = text.startswith("﻿"), text.contains("\r")
    issues = F.filter(F.array(F.when(marked, "CSM-ENC-001"), F.when(returned, "CSM-ENC-002"), F.when(bad, "CSM-ENC-000")), lambda c: c.isNotNull())
    clean = F.regexp_replace(F.regexp_replace(text, "^﻿", ""), "\r\n?", "\n")
    return files.select("doc_id", F.sha2("content", 256).alias("sha256"), F.when(~bad, clean).alias("text"), bad.alias("fatal"), issues.alias("issues"))


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def parse_yaml(front: pd.Series) -> pd.Series:
    """A mapping's leaves as strings, nested keys dotted; null where the text is no mapping."""
    import yaml

    def flat(value: object, prefix: str) -> dict[str, str]:
        if isinstance(value, dict):
            return {k: v for name, x in value.items() for k, v in flat(x, f"{prefix}.{name}" if prefix else str(name)).items()}
        if isinstance(value, list):
            return {k: v for i, x in enumerate(value) for k, v in flat(x, f"{prefix}.{i}").items()}
        return {prefix: "" if value is None else str(value)}

    def one(text: str | None) -> dict[str, str] | None:
        try:
            got = yaml.load(text or "", Loader=yaml.BaseLoader)
        except yaml.YAMLError:
            return None
        return flat(got, "") if isinstance(got, dict) else None

    return front.map(one)


def with_front_matter(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds meta, body and body_line; front matter that is no mapping is an empty one and an issue."""
    fenced = F.col(text).rlike(r"(?s)\A---\n.*?\n---(?:\n|\z)")
    front = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)
    body = F.when(fenced, F.regexp_replace(text, r"(?s)\A---\n.*?\n---(?:\n|\z)", "")).otherwise(F.col(text))
    held = docs.withColumns({"_front": F.when(fenced, front), "body": body}).withColumn("meta", parse_yaml("_front"))
    lost = F.col("meta").isNull() & F.col("_front").isNotNull()
    skipped = F.when(F.col("_front").isNotNull(), F.size(F.split("_front", "\n")) + 2).otherwise(0)
    out = held.withColumns({"body_line": skipped + 1, "meta": F.coalesce("meta", F.create_map().cast("map<string,string>"))})
    if "issues" in docs.columns:
        out = out.withColumn("issues", F.when(lost, F.concat("issues", F.array(F.lit("CSM-META-001")))).otherwise(F.col("issues")))
    return out.drop("_front")


def completed(docs: DataFrame) -> DataFrame:
    """meta with what it lacks filled in, and a code for each filling; docs have meta and body.

    The title is the first heading's; the language is zh-CN where the body has
    Han characters, else und.
    """
    heading = F.regexp_extract("body", r"(?mU)^#\s+(.+?)\s*$", 1)
    language = F.when(F.col("body").rlike("[一-鿿]"), "zh-CN").otherwise("und")
    wanted = {**{k: F.lit(v) for k, v in DEFAULTS.items()}, "title": heading, "language": language}
    lacks = {k: F.coalesce(F.trim(F.try_element_at("meta", F.lit(k))), F.lit("")) == "" for k in wanted}
    added = F.map_from_entries(F.filter(F.array(*(F.when(lacks[k] & (v != ""), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in wanted.items())), lambda e: e.isNotNull()))
    codes = F.map_keys(added)
    kept = F.map_filter("meta", lambda k, v: ~F.array_contains(codes, k))
    return docs.withColumns({"filled": codes, "meta": F.map_concat(kept, added)})


def images(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, position, alt text and address of images; remote ones are marked."""
    pattern = r"!\[(.*?)\]\((.*?)\)"
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("alt"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("url"))
    return docs.select("doc_id", F.posexplode(pairs).alias("position", "_i")).select("doc_id", "position", "_i.alt", "_i.url", F.col("_i.url").rlike("^https?://").alias("remote"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """standard_number and title from CSV files in UTF-8 or GBK, told apart file by file."""
    files = spark.read.format("binaryFile").load(path)
    utf8 = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(utf8), utf8).otherwise(F.decode("content", "GBK"))
    rows = files.select(F.explode(F.split(F.regexp_replace(text, "^﻿|\r", ""), "\n")).alias("_l")).filter(F.trim("_l") != "")
    row = F.from_csv("_l", "standard_number string, title string", {"sep": ","})
    return rows.select(row.alias("r")).select("r.*").filter("standard_number <> 'standard_number'")
