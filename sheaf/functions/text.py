"""Texts that need a scan of their own: LaTeX, emphasis, glued words; and small cover functions."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.naming import GREEK, GREEK_VARIANTS

#: LaTeX commands that stand for one character, and banner texts by prefix.
SYMBOLS = {"times": "×", "cdot": "·", "div": "÷", "pm": "±", "le": "≤", "leq": "≤", "ge": "≥", "geq": "≥", "ne": "≠", "neq": "≠", "approx": "≈", "infty": "∞", "sum": "∑", "prod": "∏", "int": "∫", "partial": "∂", "sqrt": "√", "degree": "°", "circ": "°", "to": "→", "rightarrow": "→", "in": "∈", "ldots": "…", "cdots": "…", "quad": " ", "qquad": " ", "percent": "%"}
SUPERSCRIPTS = str.maketrans("0123456789+-=()n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿ")
SUBSCRIPTS = str.maketrans("0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎")
BANNERS = (("GB", "中华人民共和国国家标准"), ("DB", "地方标准"), ("T/", "团体标准"), ("Q/", "企业标准"), ("JB", "中华人民共和国机械行业标准"))


def pandas_function(kind: T.DataType) -> Callable:
    """A function of one value as a column function over Arrow batches; null stays null."""

    def wrap(f: Callable) -> Callable:
        @F.pandas_udf(kind)
        def run(values: pd.Series) -> pd.Series:
            return values.map(f, na_action="ignore")

        return run

    return wrap


def braced(text: str, at: int) -> tuple[str, int]:
    """The group that begins at a position, or the one character there, and where it ends."""
    if at < len(text) and text[at] == "{":
        depth = 0
        for i in range(at, len(text)):
            depth += (text[i] == "{") - (text[i] == "}")
            if not depth:
                return text[at + 1 : i], i + 1
        return text[at + 1 :], len(text)
    if at < len(text) and text[at] == "\\" and (m := re.compile(r"\\[A-Za-z]+").match(text, at)):
        return m[0], m.end()
    return text[at : at + 1], at + 1


def readable_latex(latex: str) -> str:
    """Fractions, scripts, Greek letters and operators of a formula as Unicode text."""
    greek = {g: chr(c) for g, c in zip(GREEK, (c for c in range(0x3B1, 0x3CA) if c not in (0x3BF, 0x3C2)), strict=True)}  # neither omicron nor the final sigma
    greek |= {variant: greek[name.lower()] for variant, name in GREEK_VARIANTS.items()}
    out, at, text = [], 0, latex.strip().strip("$").strip()
    while at < len(text):
        c = text[at]
        if c == "\\":
            m = re.compile(r"\\([A-Za-z]+|.)").match(text, at)
            if not m:
                break
            name, at = m[1], m.end()
            if name in ("frac", "dfrac", "tfrac"):
                top, at = braced(text, at)
                bottom, at = braced(text, at)
                top, bottom = readable_latex(top), readable_latex(bottom)
                wrap = lambda s: f"({s})" if re.search(r"[+\-·× ]", s) else s
                out.append(f"{wrap(top)}/{wrap(bottom)}")
            elif name == "sqrt":
                inner, at = braced(text, at)
                out.append(f"√({readable_latex(inner)})")
            elif name in ("mathrm", "text", "mathbf", "mathit", "operatorname", "overline", "bar", "vec", "hat"):
                inner, at = braced(text, at)
                out.append(inner if name in ("text", "mathrm", "operatorname") else readable_latex(inner))
            elif name in ("left", "right", ",", ";", "!", " ", "tag"):
                if name == "tag":
                    at = braced(text, at)[1]
            elif name.lower() in greek and name not in SYMBOLS:
                letter = greek[name.lower()]
                out.append(letter.upper() if name[0].isupper() else letter)
            else:
                out.append(SYMBOLS.get(name, name))
        elif c in "^_":
            inner, at = braced(text, at + 1)
            inner = readable_latex(inner)
            table = SUPERSCRIPTS if c == "^" else SUBSCRIPTS
            out.append(inner.translate(table) if all(ord(x) in table for x in inner) else f"{c}{inner}" if len(inner) == 1 else f"{c}({inner})")
        elif c in "{}":
            at += 1
        else:
            out.append(c)
            at += 1
    return re.sub(r"\s+", " ", "".join(out)).strip()


def emphasis_tags(text: str) -> str:
    """Runs of one to three asterisks as HTML where they pair; the others stay."""
    tags = {1: ("<em>", "</em>"), 2: ("<strong>", "</strong>"), 3: ("<strong><em>", "</em></strong>")}
    runs = [(m.start(), m.end()) for m in re.finditer(r"\*+", text)]
    open_: dict[int, int] = {}
    put: dict[int, str] = {}
    for k, (a, b) in enumerate(runs):
        n = b - a
        if n not in tags:
            continue
        if n in open_ and a > 0 and not text[a - 1].isspace():
            put[open_.pop(n)], put[k] = tags[n]
        elif b < len(text) and not text[b].isspace():
            open_[n] = k
    out, last = [], 0
    for k, (a, b) in enumerate(runs):
        out += [text[last:a], put.get(k, text[a:b])]
        last = b
    return "".join([*out, text[last:]])


latex_text = pandas_function(T.StringType())(readable_latex)
emphasis = pandas_function(T.StringType())(emphasis_tags)


def split_words(word: str, known: frozenset[str], least: int = 3, most: int = 24) -> str:
    """A glued lower-case word as the fewest known words; itself if there is no such split."""
    n = len(word)
    if n > most or word in known or not word.isalpha():
        return word
    best: list[list[str] | None] = [[]] + [None] * n
    for end in range(least, n + 1):
        for start in range(end - least, -1, -1):
            before = best[start]
            if before is not None and word[start:end] in known and (best[end] is None or len(before) + 1 < len(best[end])):
                best[end] = [*before, word[start:end]]
    return " ".join(best[n]) if best[n] else word


def unglued(titles: DataFrame, column: str, lexicon: list[str]) -> DataFrame:
    """Titles with glued words split; the lexicon is a bounded list that goes to every task."""
    sent = titles.sparkSession.sparkContext.broadcast(frozenset(lexicon))

    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        known = sent.value
        return values.map(lambda t: re.sub(r"[a-z]{6,}", lambda m: split_words(m[0], known), t), na_action="ignore")

    return titles.withColumn(column, run(column))


def banner(number: Column) -> Column:
    """The cover's banner for a number; null for prefixes without one."""
    out = F.lit(None).cast("string")
    for prefix, text in reversed(BANNERS):
        out = F.when(number.startswith(prefix), text).otherwise(out)
    return out


def emblems(documents: DataFrame, table: DataFrame) -> DataFrame:
    """Each document's emblem: that of the longest prefix of its number; table has prefix and emblem."""
    longest = table.agg(F.max(F.length("prefix"))).first()[0] or 1
    own = documents.withColumn("_p", F.explode(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.substring("standard_number", 1, n)))).distinct()
    best = own.join(table, F.col("_p") == F.col("prefix")).groupBy("doc_id").agg(F.max_by("emblem", F.length("prefix")).alias("emblem"))
    return documents.join(best, "doc_id", "left")


def cover_facts(text: Column) -> Column:
    """Number, titles, dates, issuer and replaced standard from the text before the second-level headings."""
    cover = F.split(text, r"(?m)^##\s", 2)[0]
    pick = lambda pattern, k=1: F.when(F.regexp_extract(cover, pattern, k) != "", F.trim(F.regexp_extract(cover, pattern, k)))
    return F.struct(
        pick(r"(?mU)^\s*((?:GB|JB|DB|SJ|QB|T/|Q/)[/A-Z0-9]*\s*\d[\d.]*\s*[—-]\s*\d{4})\s*$").alias("number"),
        pick(r"(?mU)^#\s+(.+?)\s*$").alias("title"),
        pick(r"(?m)^([A-Z][A-Za-z0-9 ,\-:()]{8,})$").alias("title_en"),
        pick(r"(\d{4}-\d{2}-\d{2})\s*发布").alias("published"),
        pick(r"(\d{4}-\d{2}-\d{2})\s*实施").alias("effective"),
        pick(r"代替\s*([^\n]+)").alias("replaces"),
        pick(r"(?mU)^\s*(\S+(?:委员会|总局|部|协会|公司))\s*(?:发布)?\s*$").alias("issuer"),
    )
