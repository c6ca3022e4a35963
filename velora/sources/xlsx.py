"""Workbooks as tables of texts, by a pull parser over the sheet's XML; no other library is needed.

Workbooks are read where Spark's file source reaches them, one row a file; a sheet is parsed row by row and leaves the
task in batches.  Values are those of a reader that takes all cells as texts: whole numbers without a point, dates as
``yyyy-mm-dd hh:mm:ss``, and cells that are empty or mean "not available" as empty texts.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.session import workers_find_package

#: Texts that stand for no value.
NOT_AVAILABLE = {"", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"}
#: Number formats of dates and times that a workbook need not spell out.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
BATCH_ROWS = 5000


def _name(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _pull(z: zipfile.ZipFile, member: str, wanted: str) -> Iterator:
    """The elements of one name as they end; each is emptied after use, so a part of any size takes one element's memory."""
    with z.open(member) as f:
        root = None
        for event, e in ElementTree.iterparse(f, events=("start", "end")):
            root = e if root is None else root
            if event == "end" and _name(e) == wanted:
                yield e
                e.clear()
                if wanted in ("row", "si"):
                    for parent in root:
                        if _name(parent) == "sheetData":
                            parent.clear()
                    if wanted == "si":
                        root.clear()


def _text(element) -> str:
    """The runs of a text, without readings (rPh)."""
    out = []
    for e in element:
        if _name(e) == "t":
            out.append(e.text or "")
        elif _name(e) == "r":
            out.extend(t.text or "" for t in e if _name(t) == "t")
    return "".join(out)


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """The cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(e.get("numFmtId")): e.get("formatCode") or "" for e in root.iter() if _name(e) == "numFmt"}
    plain = lambda code: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)  # noqa: E731 - without literals, colours and conditions
    dates = DATE_FORMATS | {i for i, code in own.items() if re.search("[ymdhsYMDHS]", plain(code))}
    cells = next((e for e in root if _name(e) == "cellXfs"), ())
    return {i for i, x in enumerate(cells) if int(x.get("numFmtId") or 0) in dates}


def _first_sheet(z: zipfile.ZipFile) -> tuple[str, bool]:
    """The first sheet's part, and whether days are counted from 1904."""
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    sheet = next(e for e in book.iter() if _name(e) == "sheet")
    key = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    links = ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(e.get("Target") for e in links if e.get("Id") == key)
    late = any(_name(e) == "workbookPr" and e.get("date1904") in ("1", "true") for e in book.iter())
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}", late


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _value(cell, shared: Sequence[str], dates: set[int], late: bool) -> str:
    kind, v = cell.get("t", "n"), next((e.text or "" for e in cell if _name(e) == "v"), "")
    if kind == "s":
        return shared[int(v)] if v else ""
    if kind == "inlineStr":
        return next((_text(e) for e in cell if _name(e) == "is"), "")
    if kind == "b":
        return "True" if v == "1" else "False"
    if kind == "e":
        return ""
    if kind in ("str", "d") or not v:
        return v
    number = float(v)
    if int(cell.get("s") or 0) in dates:
        # the year 1900 was no leap year, though its day 60 is counted
        start = datetime(1904, 1, 1) if late else datetime(1899, 12, 31) if number < 60 else datetime(1899, 12, 30)
        return (start + timedelta(seconds=round(number * 86400))).isoformat(" ")
    return str(int(number)) if number == int(number) else str(number)


def sheet_rows(raw: bytes) -> Iterator[list[str]]:
    """The rows of the first sheet in order, empty ones inside it too; cells that mean no value are empty texts."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        shared = [_text(e) for e in _pull(z, "xl/sharedStrings.xml", "si")] if "xl/sharedStrings.xml" in z.namelist() else []
        dates, (sheet, late) = _date_styles(z), _first_sheet(z)
        due, waiting = 1, 0
        for row in _pull(z, sheet, "row"):
            cells: list[str] = []
            for n, c in enumerate(e for e in row if _name(e) == "c"):
                at = _column(c.get("r")) if c.get("r") else max(n, len(cells))
                cells.extend([""] * (at - len(cells)))
                v = _value(c, shared, dates, late)
                cells.append("" if v in NOT_AVAILABLE else v)
            number = int(row.get("r") or due)
            waiting, due = waiting + number - due, number + 1
            if any(cells):
                yield from ([] for _ in range(waiting))
                waiting = 0
                yield cells
            else:  # empty rows count only if another follows
                waiting += 1


def header_names(cells: Sequence[str]) -> list[str]:
    """Names of columns: those without one are numbered, repeated ones get a suffix."""
    seen: dict[str, int] = {}
    out = []
    for i, c in enumerate(cells):
        name = c or f"Unnamed: {i}"
        seen[name] = seen.get(name, -1) + 1
        out.append(name if not seen[name] else f"{name}.{seen[name]}")
    return out


def read_xlsx(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The first sheets of all workbooks under a path as texts, with ``columns`` or, without them, all names of their first
    rows in order of appearance.  A column that a workbook lacks is empty there."""
    workers_find_package(spark)
    schema = "path string, seq long, cells map<string,string>"

    def rows(batches: Iterator) -> Iterator:
        arrow = pa.schema([("path", pa.string()), ("seq", pa.int64()), ("cells", pa.map_(pa.string(), pa.string()))])
        for b in batches:
            for p, raw in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                names, part = None, []
                for seq, cells in enumerate(sheet_rows(raw.as_py())):
                    if names is None:
                        names = header_names(cells)
                        cells = names
                    part.append({"path": p, "seq": seq, "cells": list(zip(names, [*cells, *[""] * (len(names) - len(cells))], strict=False))})
                    if len(part) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(part, schema=arrow)
                        part = []
                yield pa.RecordBatch.from_pylist(part, schema=arrow)

    read = spark.read.format("binaryFile").load(path).select("path", "content").repartition("path").mapInArrow(rows, schema)
    if columns is None:
        heads = read.where("seq = 0").select("path", F.map_keys("cells").alias("names")).orderBy("path").collect()  # one row a workbook
        columns = list(dict.fromkeys(n for h in heads for n in h.names))
    return read.where("seq > 0").select(*(F.coalesce(F.col("cells")[c], F.lit("")).alias(c) for c in columns))
