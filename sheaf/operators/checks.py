"""Sequences, identities and references: checks as anti-joins, windows and aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Numbers of a gap that are laid out at a time.
AT_ONCE = 4096


def counted(rows: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """rows with each number from first to last, where there are any; wide ranges are laid out in parts, never as one array."""
    parts = rows.withColumns({"_first": first.cast("long"), "_last": last.cast("long")}).filter("_first <= _last")
    parts = parts.withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(AT_ONCE).cast("long"))))
    return parts.withColumn(name, F.explode(F.sequence("_from", F.least(F.col("_from") + AT_ONCE - 1, "_last")))).drop("_first", "_last", "_from")


def numbering_gaps(rows: DataFrame, group: str, number: str, start: int | None = None) -> DataFrame:
    """group and the numbers missing between its first (or ``start``) and its largest one.

    The gap before each number is found from the number before it. Every
    missing number is a row; wide gaps are laid out in parts.
    """
    own = rows.select(group, F.col(number).cast("long").alias("_n")).filter("_n IS NOT NULL").distinct()
    before = F.lag("_n", 1, None if start is None else start - 1).over(W.partitionBy(group).orderBy("_n"))
    gaps = own.withColumn("_before", before).filter("_n - _before > 1")
    return counted(gaps, F.col("_before") + 1, F.col("_n") - 1, "missing").select(group, "missing")


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, and how many."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def dangling(rows: DataFrame, ref: str, targets: DataFrame, target: str) -> DataFrame:
    """Rows whose reference is set but names no target."""
    known = targets.select(F.col(target).alias("_target")).distinct()
    return rows.filter(F.col(ref).isNotNull()).join(known, F.col(ref) == F.col("_target"), "left_anti")


def suffixed_ids(rows: DataFrame, path: str, *order: str, name: str = "element_id", part: Column | None = None) -> DataFrame:
    """Identifiers from paths; a path's second and later rows get -2, -3 and so on.

    ``part`` is a coarse form of the order (its rows don't interleave), such as
    the document's number by thousands: rows are then numbered within their part
    and parts by their sizes, so that a path with very many rows is no one
    task's.
    """
    keys = [path] if part is None else [path, "_part"]
    own = rows if part is None else rows.withColumn("_part", part)
    numbered = own.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    if part is not None:
        before = F.sum("count").over(W.partitionBy(path).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
        sizes = own.groupBy(*keys).count().select(*(F.col(k).alias(f"_{k}") for k in keys), F.coalesce(before, F.lit(0)).alias("_before"))
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
        numbered = numbered.join(sizes, same).withColumn("_n", F.col("_n") + F.col("_before")).drop("_part", "_before", *(f"_{k}" for k in keys))
    return numbered.withColumn(name, F.when(F.col("_n") == 1, F.col(path)).otherwise(F.concat_ws("-", path, F.col("_n").cast("string")))).withColumn("is_repeat", F.col("_n") > 1).drop("_n")


def comparison_key(column: Column) -> Column:
    """White space and dashes don't tell identifiers apart, nor does case."""
    return F.lower(F.regexp_replace(F.regexp_replace(column, r"(?U)\s+", ""), "[—–−]", "-"))


def unmatched(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of left whose comparison key no row of right has."""
    keys = right.select(comparison_key(F.col(right_key)).alias("_k")).distinct()
    return left.withColumn("_own", comparison_key(F.col(left_key))).join(keys, F.col("_own") == F.col("_k"), "left_anti").drop("_own")


def prefixes(column: Column, separator: str = r"\.") -> Column:
    """All leading parts of a dotted key, itself included."""
    parts = F.split(column, separator)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))


def uncovered(rows: DataFrame, key: str, listed: DataFrame, listed_key: str, separator: str = r"\.") -> DataFrame:
    """Rows whose key is not listed, begins with no listed key and is the beginning of none.

    Prefixes are exploded on both sides, so the test is an equi-join however
    long the lists are.
    """
    own = rows.withColumn("_row", F.col(key))
    names = listed.select(F.col(listed_key).alias("_listed")).distinct()
    below = own.select("_row", F.explode(prefixes(F.col(key), separator)).alias("_part")).distinct().join(names, F.col("_part") == F.col("_listed")).select("_row")
    above = names.select(F.explode(prefixes(F.col("_listed"), separator)).alias("_row")).distinct()
    covered = below.unionByName(above).distinct()
    return own.join(covered, "_row", "left_anti").drop("_row")


def summary_by_target(refs: DataFrame, target: str, order: str, version: str, normative: str) -> DataFrame:
    """One row for each target cited: times, first-seen version, nature (normative if any citation is)."""
    made = refs.groupBy(target).agg(
        F.count("*").alias("n_citations"),
        F.min_by(version, order).alias("first_version"),
        F.min(order).alias("first_order"),
        F.bool_or(F.col(normative)).alias("_normative"),
    )
    return made.withColumn("nature", F.when(F.col("_normative"), "normative").otherwise("informative")).drop("_normative")


def findings(*checks: tuple[DataFrame, str, str, str, Column]) -> DataFrame:
    """All findings of checks (rows, subject column, rule, priority, message); only a must fails."""
    parts = [rows.select(F.col(subject).cast("string").alias("subject"), F.lit(rule).alias("rule_id"), F.lit(priority).alias("priority"), message.cast("string").alias("message"), F.lit("fail" if priority == "must" else "warning").alias("status")) for rows, subject, rule, priority, message in checks]
    return reduce(DataFrame.unionByName, parts)


def coverage(rows: DataFrame, value: str, expected: list[str]) -> DataFrame:
    """Each expected value, whether any row has it, and how many do."""
    wanted = rows.sparkSession.createDataFrame([(k, v) for k, v in enumerate(expected)], "position int, element string")
    counts = rows.groupBy(F.col(value).alias("element")).agg(F.count("*").alias("n_rows"))
    return wanted.join(counts, "element", "left").select("position", "element", F.col("n_rows").isNotNull().alias("present"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """What either side has and the other lacks, repeats counted, with the side."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def rank_percentile(rows: DataFrame, group: str, value: str, share: float = 0.8, name: str = "demand") -> DataFrame:
    """The value at rank floor(share * n) of a group's sorted values, without interpolation.

    Ranks come from running counts of each distinct value, so no group is
    collected.
    """
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    w = W.partitionBy(group).orderBy(value)
    upto = counts.withColumn("_upto", F.sum("n").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).withColumn("_all", F.sum("n").over(W.partitionBy(group)))
    rank = F.least(F.col("_all"), F.floor(F.lit(share) * F.col("_all")) + 1)
    return upto.filter(F.col("_upto") >= rank).groupBy(group).agg(F.min(value).alias(name), F.max("_all").alias("n_values"))


def upper_median(rows: DataFrame, group: str, value: str, name: str = "median") -> DataFrame:
    """The value at place n // 2 of a group's sorted values."""
    return rank_percentile(rows, group, value, 0.5, name)
