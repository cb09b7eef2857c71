"""Places of cited strings in a document's text."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _patterns(needle: str) -> list[re.Pattern[str]]:
    """As it stands, then with any white space or none where it has some."""
    parts = [re.escape(p) for p in needle.split()]
    exact, loose = re.escape(needle), r"\s*".join(parts)
    return [] if not parts else [re.compile(p) for p in dict.fromkeys((exact, loose))]


class _Places:
    """Searches one text; each owner's next search begins where its last hit ended."""

    def __init__(self, text: str, owners: dict[str, tuple[int, int]]):
        self.text, self.owners, self.after, self.anywhere = text, owners, {}, {}

    def find(self, owner: str | None, needle: str) -> tuple[int | None, int | None, str]:
        patterns = _patterns(needle)
        start, end = self.owners.get(owner, (None, None))
        if start is not None:
            for p in patterns:
                if hit := p.search(self.text, self.after.get(owner, start), end) or p.search(self.text, start, end):
                    self.after[owner] = hit.end()
                    return hit.start(), hit.end(), "resolved"
        if needle not in self.anywhere:  # the whole text is read once for each such string
            self.anywhere[needle] = next((m.span() for p in patterns if (m := p.search(self.text))), (None, None))
        at = self.anywhere[needle]
        return *(at if at[0] is not None else (start, end)), "partiallyResolved"


def located(mentions: DataFrame, fragments: DataFrame, texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, mention, start_char, end_char and status of every mention, in code points.

    mentions: key, mention (their order), owner, needle. fragments: key, owner,
    start_char, end_char of the owner's part of the text (as a ledger gives them).
    texts: key, text. A string is
    looked for in its owner's fragment from the last hit on, then from its
    start, first exactly, then with other white space (resolved); then in the
    whole text, else the fragment itself is given (partiallyResolved). Null or
    empty strings have their fragment; unknown owners and texts give null.
    A document's mentions meet its text once; hits carry no text.
    """

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        text, owners = "", {}
        for row in right.to_pylist():
            if row["owner"] is None:
                text = row["text"] or ""
            else:
                owners[row["owner"]] = (row["start_char"], row["end_char"])
        places = _Places(text, owners)
        rows = left.sort_by("mention")
        out = [places.find(owner, needle or "") for owner, needle in zip(rows.column("owner").to_pylist(), rows.column("needle").to_pylist(), strict=True)]
        at = {name: pa.array([x[i] for x in out], t) for i, (name, t) in enumerate((("start_char", pa.int64()), ("end_char", pa.int64()), ("status", pa.string())))}
        return pa.table({key: rows.column(key), "mention": rows.column("mention"), **at})

    known = fragments.select(F.col(key).alias(key), F.col("owner").alias("owner"), F.col("start_char").cast("long").alias("start_char"), F.col("end_char").cast("long").alias("end_char"), F.lit(None).cast("string").alias("text"))
    whole = texts.select(F.col(key).alias(key), F.lit(None).cast("string").alias("owner"), F.lit(None).cast("long").alias("start_char"), F.lit(None).cast("long").alias("end_char"), "text")
    asked = mentions.select(F.col(key).alias(key), F.col("mention").cast("long").alias("mention"), F.col("owner").alias("owner"), F.col("needle").alias("needle"))
    schema = f"{key} {mentions.schema[key].dataType.simpleString()}, mention long, start_char long, end_char long, status string"
    return asked.groupBy(key).cogroup(known.unionByName(whole).groupBy(key)).applyInArrow(find, schema)
