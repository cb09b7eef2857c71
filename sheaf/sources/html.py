"""HTML fragments: tables as grids of cells."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELLS = "table_no int, row int, col int, cell string, rowspan int, colspan int, is_header boolean"
DASHES = frozenset("-–—―一")


class _Tables(HTMLParser):
    """Collects the rows of every table as (text, rowspan, colspan) cells."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[list]]] = []
        self.open = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open += 1
            if self.open == 1:
                self.tables.append([])
        elif self.open and tag == "tr":
            self.tables[-1].append([])
        elif self.open and tag in ("td", "th"):
            if not self.tables[-1]:
                self.tables[-1].append([])
            spans = [max(1, int(v)) if (v := dict(attrs).get(k) or "1").isdigit() else 1 for k in ("rowspan", "colspan")]
            self.tables[-1][-1].append(["", *spans])
            self.cell = self.tables[-1][-1][-1]
        elif self.open and tag == "br" and getattr(self, "cell", None):
            self.cell[0] += "\n"

    def handle_endtag(self, tag: str) -> None:
        if tag == "table":
            self.open = max(0, self.open - 1)
        if tag in ("td", "th", "table"):
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.open and getattr(self, "cell", None):
            self.cell[0] += data


def grids(html: str) -> Iterator[tuple]:
    """Cells of every table on absolute rows and columns, places covered by a span left out."""
    parser = _Tables()
    parser.feed(html or "")
    for number, rows in enumerate(parser.tables):
        taken: set[tuple[int, int]] = set()
        placed = []
        for r, row in enumerate(rows):
            c = 0
            for text, down, across in row:
                while (r, c) in taken:
                    c += 1
                taken.update((r + i, c + j) for i in range(down) for j in range(across))
                text = " ".join(text.split())
                placed.append([number, r, c, "—" if len(text) == 1 and text in DASHES else text, down, across])
                c += across
        if not placed:
            continue
        # a last column that only holds blanks is no column
        last = max(c + across for _, _, c, _, _, across in placed) - 1
        if last and all(not t for _, _, c, t, _, across in placed if c == last and across == 1) and not any(c < last <= c + across - 1 for _, _, c, _, _, across in placed):
            placed = [p for p in placed if p[2] != last]
        header = min(max((p[4] for p in placed if p[1] == 0), default=1), max(1, len(rows) - 1))
        yield from ((*p, p[1] < header) for p in placed)


def table_cells(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key and the cells of all tables in each row's HTML."""
    names = [x.split()[0] for x in CELLS.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, *cell) for k, text in zip(frame[key], frame[html], strict=True) for cell in grids(text)]
            yield pd.DataFrame(rows, columns=[key, *names])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, {CELLS}")


def restored_markers(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells whose footnote marker was lost get it back.

    A footnote row ``a text`` belongs to the longest other cell whose text its
    own contains; on a tie, to the first.
    """
    notes = cells.withColumn("marker", F.regexp_extract("cell", r"(?U)^([a-z])\s+\S", 1)).filter("marker <> ''").select(*keys, "marker", F.col("row").alias("_note"), F.col("cell").alias("_text"))
    near = cells.filter(F.length("cell") > 1).join(notes, keys).filter((F.col("row") != F.col("_note")) & F.col("_text").contains(F.col("cell")))
    best = F.row_number().over(W.partitionBy(*keys, "_note").orderBy(F.length("cell").desc(), "row", "col"))
    owners = near.withColumn("_n", best).filter("_n = 1").groupBy(*keys, "row", "col").agg(F.array_join(F.array_sort(F.collect_set("marker")), "").alias("marker"))
    return cells.join(owners, [*keys, "row", "col"], "left").withColumn("cell", F.when(F.col("marker").isNotNull(), F.concat("cell", F.col("marker"))).otherwise(F.col("cell")))


def header_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows of each table are header: the largest span in the first row."""
    return cells.filter("row = 0").groupBy(*keys).agg(F.max("rowspan").alias("header_rows"))
