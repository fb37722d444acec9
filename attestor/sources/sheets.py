"""Reviewer sheets as XLSX: one table a sheet, cells of text, numbers and truth values.

Sheets are small by nature, a sample that a person reads; each file is read or made by one task.  Only what such sheets need
is known: shared and inline texts, numbers, booleans; formulas give their stored value.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
CELLS = "path string, row_no int, cells map<string,string>"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def read_bytes(content: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """Rows of a sheet, the first by default, as texts; KeyError for a name that no sheet has."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        sheets = {s.get("name"): s.get(LINK) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{MAIN}sheet")}
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[sheets[sheet] if sheet is not None else next(iter(sheets.values()))].lstrip("/")
        rows: list[list[str | None]] = []
        for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{MAIN}row"):
            while len(rows) < int(row.get("r", len(rows) + 1)) - 1:  # rows without cells may be left out
                rows.append([])
            cells: list[str | None] = []
            for c in row.iter(f"{MAIN}c"):
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at + 1 - len(cells))
                kind, v = c.get("t", "n"), c.find(f"{MAIN}v")
                if kind == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(f"{MAIN}t"))
                elif v is not None and v.text is not None:
                    cells[at] = shared[int(v.text)] if kind == "s" else {"1": "true", "0": "false"}[v.text] if kind == "b" else v.text
            rows.append(cells)
    return rows


def write_bytes(header: list[str], rows: list[tuple], sheet: str = "Review") -> bytes:
    """A workbook of one sheet with a header; None is an empty cell."""

    def cell(x: object) -> str:
        if x is None:
            return "<c/>"
        if isinstance(x, bool):
            return f'<c t="b"><v>{int(x)}</v></c>'
        if isinstance(x, (int, float)) and x == x and abs(x) != float("inf"):
            return f"<c><v>{x!r}</v></c>"
        text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(x))
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'

    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [tuple(header), *rows])
    head, ns = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>', "http://schemas.openxmlformats.org"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{ns}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{ns}/spreadsheetml/2006/main" xmlns:r="{ns}/officeDocument/2006/relationships"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="r1" Type="{ns}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{ns}/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, head + text)
    return out.getvalue()


def read_sheets(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(path, row_no, cells) of all workbooks below ``path``: each row below the header as a map by the header's names."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in batch.itertuples(index=False):
                rows = read_bytes(bytes(content), sheet)
                header = rows[0] if rows else []
                made = [(name, i, {h: v for h, v in zip(header, r) if h}) for i, r in enumerate(rows[1:], 1) if any(v is not None for v in r)]
                yield pd.DataFrame(made, columns=["path", "row_no", "cells"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", "content").mapInPandas(read, CELLS)


def labels(sheets: DataFrame, uid: str = "row_uid", correct: str = "correct") -> DataFrame:
    """(row_uid, correct, record_seq) of reviewers' rows, as ``evaluate.labels`` takes them; later rows and files count more."""
    get = lambda k: F.try_element_at("cells", F.lit(k))
    return sheets.select(get(uid).alias("row_uid"), get(correct).alias("correct"), F.struct("path", "row_no").alias("record_seq"))


def sheet_files(rows: DataFrame, by: str, columns: list[str], order: str, sheet: str = "Review") -> DataFrame:
    """(name, content): a workbook for each value of ``by``, such as a reviewer, of its rows in order; a group has to fit a sheet."""

    def make(group: pd.DataFrame) -> pd.DataFrame:
        got = group.sort_values(order)
        cells = got[columns].astype(object).where(got[columns].notna(), None)
        return pd.DataFrame([(str(got[by].iloc[0]), write_bytes(columns, list(cells.itertuples(index=False, name=None)), sheet))], columns=["name", "content"])

    return rows.select(by, order, *[c for c in columns if c not in (by, order)]).groupBy(by).applyInPandas(make, "name string, content binary")
