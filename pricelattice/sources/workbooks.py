"""Spreadsheet files to sheet rows.

A workbook is a zip archive of XML parts.  Each task opens the workbooks of its own
partition and emits the first sheet's cells as text; everything after that is
DataFrame work (see ``sheets``).
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

ROWS_SCHEMA = "path string, row_idx long, cells array<string>, error string"
_ROWS_PER_BATCH = 5_000


def read_cells(files: DataFrame) -> DataFrame:
    """Files (path, content) to one row per sheet row; an unreadable file gives one row with its error."""

    # local functions, so they travel to the tasks by value
    def local(tag: str) -> str:
        return tag.rsplit("}", 1)[-1]

    def text_of(node) -> str:
        return "".join(t.text or "" for t in node.iter() if local(t.tag) == "t")

    def first_sheet(book: zipfile.ZipFile) -> str:
        sheet = next(n for n in ElementTree.parse(book.open("xl/workbook.xml")).iter() if local(n.tag) == "sheet")
        wanted = next(v for k, v in sheet.attrib.items() if local(k) == "id")
        links = ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()
        target = next(n.attrib["Target"] for n in links if n.attrib["Id"] == wanted)
        return target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)

    def rows_of(content: bytes):
        with zipfile.ZipFile(io.BytesIO(content)) as book:
            shared: list[str] = []
            if "xl/sharedStrings.xml" in book.namelist():
                shared = [text_of(n) for n in ElementTree.parse(book.open("xl/sharedStrings.xml")).getroot()]
            position = -1
            with book.open(first_sheet(book)) as sheet:
                for _, node in ElementTree.iterparse(sheet):
                    if local(node.tag) != "row":
                        continue
                    position = int(node.attrib["r"]) - 1 if "r" in node.attrib else position + 1
                    cells: list[str | None] = []
                    for cell in node:
                        column = len(cells)
                        if "r" in cell.attrib:
                            column = 0
                            for letter in re.match("[A-Z]+", cell.attrib["r"]).group():
                                column = column * 26 + ord(letter) - 64
                            column -= 1
                        cells.extend([None] * (column + 1 - len(cells)))
                        parts = {local(c.tag): c for c in cell}
                        if "is" in parts:
                            cells[column] = text_of(parts["is"])
                        elif "v" in parts and parts["v"].text is not None:
                            raw = parts["v"].text
                            cells[column] = shared[int(raw)] if cell.attrib.get("t") == "s" else raw
                    node.clear()
                    yield position, cells

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(path, rows):
            return pd.DataFrame({"path": path, "row_idx": [r for r, _ in rows], "cells": [c for _, c in rows], "error": None})

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    pending = []
                    for row in rows_of(content):
                        pending.append(row)
                        if len(pending) == _ROWS_PER_BATCH:
                            yield frame(path, pending)
                            pending = []
                    if pending:
                        yield frame(path, pending)
                except Exception as e:  # a bad file must not stop the run; it is recorded as failed
                    yield pd.DataFrame({"path": [path], "row_idx": [-1], "cells": [None], "error": [f"{type(e).__name__}: {e}"]})

    return files.select("path", "content").mapInPandas(read, ROWS_SCHEMA)


def read_workbooks(spark: SparkSession, root: str) -> DataFrame:
    """Cells of every workbook below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[xX][lL][sS][xX]")
    return read_cells(found.load(root))
