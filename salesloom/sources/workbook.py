"""Workbook (.xlsx) scan: Spark reads and places the files, tasks unpack the XML.

A sheet holds at most 1,048,576 rows by format and its zip stream cannot be split,
so one file is one unit of work; rows leave the task in Arrow batches as they are
parsed.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from functools import partial
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from salesloom.operators.grid import GRID_SCHEMA
from salesloom.sources.cells import NULL_TEXTS

BATCH_ROWS = 2048
LEADING_ROWS = 16
ERROR_ROW = -1
CELL = pa.struct([("v", pa.string()), ("kind", pa.string())])
GRID = pa.schema(
    [
        ("file_path", pa.string()),
        ("sheet", pa.string()),
        ("row_idx", pa.int64()),
        ("cells", pa.list_(CELL)),
    ]
)
# Built-in number formats that show a date or a time.
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _children(archive: zipfile.ZipFile, member: str, name: str):
    """Elements called ``name`` anywhere in a small member."""
    if member not in archive.namelist():
        return []
    return [e for e in ElementTree.fromstring(archive.read(member)).iter() if _tag(e) == name]


def _text(element) -> str:
    """Text of a rich or plain string, leaving phonetic hints out."""
    if element is None:
        return ""
    parts = []
    for child in element:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts.extend(t.text or "" for t in child if _tag(t) == "t")
    return "".join(parts)


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Cell style numbers whose format shows a date or a time."""
    custom = {
        int(e.get("numFmtId"))
        for e in _children(archive, "xl/styles.xml", "numFmt")
        if re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", e.get("formatCode", "").lower()))
    }
    formats = _children(archive, "xl/styles.xml", "cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in formats[0]] if formats else []
    return {i for i, number in enumerate(ids) if number in DATE_FORMATS or number in custom}


def _sheets(archive: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, member) in workbook order."""
    targets = {
        e.get("Id"): e.get("Target")
        for e in _children(archive, "xl/_rels/workbook.xml.rels", "Relationship")
    }
    found = []
    for sheet in _children(archive, "xl/workbook.xml", "sheet"):
        target = targets[sheet.get(RELATION)]
        found.append((sheet.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return found


def _number(text: str, is_date: bool, epoch: dt.datetime) -> tuple[str, str]:
    value = float(text)
    if is_date:
        moment = epoch + dt.timedelta(microseconds=round(value * 86400) * 1000000)
        if epoch.year == 1899 and 0 < value < 60:
            moment += dt.timedelta(days=1)
        return (str(moment.time()), "str") if 0 <= value < 1 else (str(moment), "datetime")
    if re.fullmatch("[+-]?[0-9]+", text):
        return str(int(text)), "num"
    return (str(int(value)) if value.is_integer() else repr(value)), "num"


def _cell(element, strings: list[str], dates: set[int], epoch: dt.datetime):
    kind = element.get("t", "n")
    raw = next((c.text for c in element if _tag(c) == "v"), None)
    if kind == "inlineStr":
        text = _text(next((c for c in element if _tag(c) == "is"), None))
    elif raw is None or kind == "e":
        return None
    elif kind == "s":
        text = strings[int(raw)]
    elif kind == "b":
        return {"v": str(raw == "1"), "kind": "bool"}
    elif kind == "n":
        value, kind = _number(raw, int(element.get("s", 0)) in dates, epoch)
        return {"v": value, "kind": kind}
    elif kind == "d":
        return {"v": raw.replace("T", " ").removesuffix("Z"), "kind": "datetime"}
    else:
        text = raw
    return None if text in NULL_TEXTS else {"v": text, "kind": "str"}


def _column(reference: str | None, following: int) -> int:
    if not reference:
        return following
    index = 0
    for char in reference:
        if char.isdigit():
            break
        index = index * 26 + ord(char) - 64
    return index - 1


def _rows(archive, member, strings, dates, epoch) -> Iterator[tuple[int, list]]:
    """(row index, cells) without trailing blanks; blank rows only near the top."""
    blank, index = [], -1
    with archive.open(member) as stream:
        for _, element in ElementTree.iterparse(stream):
            if _tag(element) != "row":
                continue
            following = index + 1
            index = int(element.get("r", index + 2)) - 1
            cells: list = []
            for item in element:
                if _tag(item) != "c":
                    continue
                value = _cell(item, strings, dates, epoch)
                if value is not None:
                    column = _column(item.get("r"), len(cells))
                    cells.extend([None] * (column - len(cells)))
                    cells.append(value)
                elif item.get("r") is None:
                    cells.append(None)
            element.clear()
            while cells and cells[-1] is None:
                cells.pop()
            blank.extend(i for i in range(following, index) if i < LEADING_ROWS)
            if cells:
                yield from ((i, []) for i in blank)
                blank = []
                yield index, cells
            elif index < LEADING_ROWS:
                blank.append(index)


def _chosen(sheets: list[tuple[str, str]], sheet: int | str | None):
    """(label, member) of the sheets asked for; the label is the selector as text."""
    if sheet is None:
        return sheets
    if isinstance(sheet, int):
        return [(str(sheet), sheets[sheet][1])]
    return [(sheet, dict(sheets)[sheet])]


def parse_workbook(path: str, content: bytes, sheet: int | str | None) -> Iterator[dict]:
    """Grid rows of one workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        strings = [_text(e) for e in _children(archive, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(archive)
        props = _children(archive, "xl/workbook.xml", "workbookPr")
        old = bool(props) and props[0].get("date1904") in ("1", "true")
        epoch = dt.datetime(1904, 1, 1) if old else dt.datetime(1899, 12, 30)
        for label, member in _chosen(_sheets(archive), sheet):
            for index, cells in _rows(archive, member, strings, dates, epoch):
                yield {"file_path": path, "sheet": label, "row_idx": index, "cells": cells}


def _parse_files(batches, sheet) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            name, rows = path.as_py(), []
            try:
                for row in parse_workbook(name, content.as_py(), sheet):
                    rows.append(row)
                    if len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, GRID)
                        rows = []
            except Exception as problem:  # one broken file must not stop the others
                note = {"v": f"{type(problem).__name__}: {problem}", "kind": "error"}
                rows.append(
                    {"file_path": name, "sheet": str(sheet), "row_idx": ERROR_ROW, "cells": [note]}
                )
            if rows:
                yield pa.RecordBatch.from_pylist(rows, GRID)


def binary_files(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Files as (path, modificationTime, length, content)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def grid_of_workbooks(files: DataFrame, sheet: int | str | None = 0) -> DataFrame:
    """Grid of a ``binaryFile`` DataFrame (batch or stream).

    ``sheet`` is an index, a name, or None for all sheets.  An unreadable file
    yields one row with ``row_idx`` -1 that carries the reason.
    """
    return files.select("path", "content").mapInArrow(
        partial(_parse_files, sheet=sheet), GRID_SCHEMA
    )


def read_workbooks(
    spark: SparkSession,
    path: str | list[str],
    sheet: int | str | None = 0,
    pattern: str = "*.xlsx",
) -> DataFrame:
    """Grid of every workbook under ``path``."""
    return grid_of_workbooks(binary_files(spark, path, pattern), sheet)
