"""Tables inside HTML documents (the reference reads '.xls' files that are
really HTML). Files or a text column are spread over tasks by Spark; each task
parses its documents with the standard-library HTML parser in `mapInPandas`."""

from __future__ import annotations

from html.parser import HTMLParser

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# ship this module's parser with the task, so executors need no install of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_SCHEMA = "doc string, table_no int, row_no int, cells array<string>"


class _Table:
    """One open <table>: its number, next row number, and cells carried down by rowspan."""

    def __init__(self, number: int):
        self.number = number
        self.next_row = 0
        self.carry: dict[int, tuple[str, int]] = {}   # column -> (text, rows still to fill)
        self.raw: list[tuple[str, int, int]] | None = None  # cells of the open row: (text, colspan, rowspan)


class _TableParser(HTMLParser):
    """Collects the text of <td>/<th> cells per <tr> per <table>. Nested tables
    are numbered in document order. colspan / rowspan are expanded the way
    pandas.read_html does: the value is repeated in every spanned cell."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str]]] = []
        self._open: list[_Table] = []
        self._count = 0
        self._cell: list[str] | None = None
        self._span = (1, 1)
        self._saved: list[tuple[list[str] | None, tuple[int, int]]] = []  # open cells around nested tables

    @staticmethod
    def _int(attrs, name) -> int:
        try:
            return max(1, int(dict(attrs).get(name) or 1))
        except ValueError:
            return 1

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._saved.append((self._cell, self._span))  # an enclosing cell keeps its text
            self._cell = None
            self._open.append(_Table(self._count))
            self._count += 1
        elif not self._open:
            return
        elif tag == "tr":
            self._close_row()
            self._open[-1].raw = []
        elif tag in ("td", "th"):
            t = self._open[-1]
            if t.raw is None:
                t.raw = []
            self._close_cell()
            self._cell = []
            self._span = (self._int(attrs, "colspan"), self._int(attrs, "rowspan"))

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._close_cell()
        elif tag == "tr":
            self._close_row()
        elif tag == "table" and self._open:
            self._close_row()
            self._open.pop()
            if self._saved:
                self._cell, self._span = self._saved.pop()

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)

    def _close_cell(self):
        if self._cell is not None and self._open and self._open[-1].raw is not None:
            text = " ".join("".join(self._cell).split())
            self._open[-1].raw.append((text, *self._span))
        self._cell = None

    def _close_row(self):
        self._close_cell()
        if not self._open or self._open[-1].raw is None:
            return
        t = self._open[-1]
        row: list[str] = []
        raw = iter(t.raw)
        col = 0
        while True:
            if col in t.carry:
                text, left = t.carry.pop(col)
                if left > 1:
                    t.carry[col] = (text, left - 1)
                row.append(text)
                col += 1
                continue
            nxt = next(raw, None)
            if nxt is None:
                if t.carry and max(t.carry) > col:  # a carried cell further right: pad the gap
                    row.append("")
                    col += 1
                    continue
                break
            text, colspan, rowspan = nxt
            for _ in range(colspan):
                row.append(text)
                if rowspan > 1:
                    t.carry[col] = (text, rowspan - 1)
                col += 1
        self.rows.append((t.number, t.next_row, row))
        t.next_row += 1
        t.raw = None

    def close(self):
        super().close()
        self._close_row()


def parse_tables(html: str) -> list[tuple[int, int, list[str]]]:
    p = _TableParser()
    p.feed(html or "")
    p.close()
    return p.rows


def _rows_of(batches, doc_col: str, text_col: str, binary: bool):
    for pdf in batches:
        out_doc, out_t, out_r, out_c = [], [], [], []
        for doc, text in zip(pdf[doc_col], pdf[text_col]):
            if text is None:
                continue
            if binary:
                text = bytes(text).decode("utf-8", errors="replace")
            for t, r, cells in parse_tables(text):
                out_doc.append(str(doc))
                out_t.append(t)
                out_r.append(r)
                out_c.append(cells)
        if out_doc:
            yield pd.DataFrame({"doc": out_doc, "table_no": out_t, "row_no": out_r, "cells": out_c})


def html_table_rows(df: DataFrame, doc_col: str, html_col: str) -> DataFrame:
    """Rows of every table in an HTML text column: (doc, table_no, row_no, cells)."""
    src = df.select(F.col(doc_col).cast("string").alias("d"), F.col(html_col).alias("h"))
    return src.mapInPandas(lambda it: _rows_of(it, "d", "h", False), ROW_SCHEMA)


def read_html_tables(spark: SparkSession, path: str, glob: str = "*.xls") -> DataFrame:
    """Rows of every table in every matching file; `doc` is the file path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    src = files.select(F.col("path").alias("d"), F.col("content").alias("h"))
    return src.mapInPandas(lambda it: _rows_of(it, "d", "h", True), ROW_SCHEMA)


def first_table(rows: DataFrame, header: list[str]) -> DataFrame:
    """Table 0 of each document as named text columns, header row removed."""
    body = rows.filter((F.col("table_no") == 0) & (F.col("row_no") > 0))
    return body.select("doc", "row_no", *[F.element_at("cells", i + 1).alias(h) for i, h in enumerate(header)])
