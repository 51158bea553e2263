"""Spreadsheet (xlsx) scan: ``binaryFile`` + ``mapInPandas`` over the standard library.

A workbook is a zip of XML parts and can only be parsed as a whole, so each workbook is
parsed by one task; workbooks are spread over tasks by the ``binaryFile`` scan (a split
holds whole files up to ``spark.sql.files.maxPartitionBytes``). Rows are streamed out in
batches with ``iterparse``; nothing is collected to the driver.

Semantics follow a headerless, non-inferring read from A1: every cell is a string, empty
cells are ``''`` (not NULL), rows are numbered 1..last row densely (missing rows come out
as empty rows) and every row has the sheet's width. Limits: numbers are written as stored
(integral values without ``.0``); dates stay serial numbers and cell styles are not applied.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from xml.etree.ElementTree import iterparse, parse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MISSING_FILE, IntakeError
from ..operators.stamp import FILE_COL, ROW_COL
from .files import split_existing

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
GRID_SCHEMA = (f"{FILE_COL} string, filename string, sheet string, {ROW_COL} long, "
               "cells array<string>")
BATCH_ROWS = 4096
ERROR_COL = "_error"
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _sheet_part(zf: zipfile.ZipFile, sheet) -> tuple[str, str]:
    wb = parse(zf.open("xl/workbook.xml")).getroot()
    sheets = [(s.get("name"), s.get(_REL_NS + "id")) for s in wb.iter(_NS + "sheet")]
    if not sheets:
        raise ValueError("workbook has no sheets")
    if isinstance(sheet, int):
        if not -len(sheets) <= sheet < len(sheets):
            raise ValueError(f"workbook has {len(sheets)} sheets, no index {sheet}")
        name, rid = sheets[sheet]
    else:
        found = [s for s in sheets if s[0] == sheet]
        if not found:
            raise ValueError(f"sheet {sheet!r} not found; sheets: {[s[0] for s in sheets]}")
        name, rid = found[0]
    rels = parse(zf.open("xl/_rels/workbook.xml.rels")).getroot()
    target = next(r.get("Target") for r in rels.iter(_PKG_REL + "Relationship")
                  if r.get("Id") == rid)
    part = target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)
    return name, part


def _rich_text(el) -> str:
    """Text of a string item (``si`` / ``is``): its own ``t`` or its runs' ``t``; phonetic
    guides (``rPh``) are not part of the value."""
    parts = []
    for child in el:
        if child.tag == _NS + "t":
            parts.append(child.text or "")
        elif child.tag == _NS + "r":
            parts.extend(t.text or "" for t in child.findall(_NS + "t"))
    return "".join(parts)


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in zf.namelist():
        return []
    out = []
    for _, el in iterparse(zf.open("xl/sharedStrings.xml")):
        if el.tag == _NS + "si":
            out.append(_rich_text(el))
            el.clear()
    return out


def _cell_text(c, shared: list[str]) -> str:
    t = c.get("t")
    if t == "inlineStr":
        inline = c.find(_NS + "is")
        return _rich_text(inline) if inline is not None else ""
    v = c.find(_NS + "v")
    raw = v.text if v is not None and v.text is not None else ""
    if t == "s":
        return shared[int(raw)] if raw else ""
    if t == "b":
        return "TRUE" if raw == "1" else "FALSE"
    if t in ("str", "e", "d"):
        return raw
    if raw:
        try:
            f = float(raw)
            if f.is_integer() and "e" not in raw.lower():
                return str(int(f))
        except ValueError:
            pass
    return raw


def _dimension_width(ref: str | None) -> int | None:
    """Width from a used-range reference such as ``A1:F120`` (read from column A)."""
    if not ref:
        return None
    m = _REF.match(ref.split(":")[-1])
    return _col_index(m.group(1)) + 1 if m else None


def iter_sheet_rows(content: bytes, sheet=0):
    """Yield ``(sheet_name, row_number, cells)`` for every row 1..last, width-padded.

    When the sheet declares its used range (``<dimension>``, written by spreadsheet
    programs) rows stream straight through; otherwise the sheet's rows are held until its
    width is known (a sheet is bounded by the format's row limit).
    """
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        name, part = _sheet_part(zf, sheet)
        shared = _shared_strings(zf)
        width = None
        held: list[tuple[int, dict[int, str]]] = []
        seen_width = 0
        expected = 1
        prev_r = 0
        for event, el in iterparse(zf.open(part), events=("start", "end")):
            if event == "start":
                if el.tag == _NS + "dimension":
                    width = _dimension_width(el.get("ref"))
                continue
            if el.tag != _NS + "row":
                continue
            r = int(el.get("r")) if el.get("r") else prev_r + 1
            prev_r = r
            cells: dict[int, str] = {}
            pos = -1
            for c in el.iter(_NS + "c"):
                ref = c.get("r")
                pos = _col_index(_REF.match(ref).group(1)) if ref else pos + 1
                cells[pos] = _cell_text(c, shared)
            el.clear()
            if width is None:
                if cells:
                    seen_width = max(seen_width, max(cells) + 1)
                held.append((r, cells))
                continue
            w = max(width, max(cells) + 1) if cells else width
            while expected < r:
                yield name, expected, [""] * width
                expected += 1
            yield name, r, [cells.get(i, "") for i in range(w)]
            expected = r + 1
    for r, cells in held:
        while expected < r:
            yield name, expected, [""] * seen_width
            expected += 1
        yield name, r, [cells.get(i, "") for i in range(seen_width)]
        expected = r + 1


def _parse_batches(sheet):
    from urllib.parse import unquote

    cols = [FILE_COL, "filename", "sheet", ROW_COL, "cells", ERROR_COL]

    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                fname = unquote(path.rsplit("/", 1)[-1])   # paths are URI-encoded
                buf = []
                try:
                    for name, r, cells in iter_sheet_rows(bytes(content), sheet):
                        buf.append((path, fname, name, r, cells, None))
                        if len(buf) >= BATCH_ROWS:
                            yield pd.DataFrame(buf, columns=cols)
                            buf = []
                except Exception as exc:  # noqa: BLE001 - reported per file
                    buf.append((path, fname, None, None, None, f"{type(exc).__name__}: {exc}"))
                if buf:
                    yield pd.DataFrame(buf, columns=cols)
    return run


def scan_workbooks(spark: SparkSession, paths, sheet=0, on_missing: str = "raise") -> DataFrame:
    """Rows of one sheet (index or name) of each workbook, and for a workbook that cannot be
    parsed one row whose ``_error`` says why (rows parsed before the fault may come first)."""
    found, missing = split_existing(spark, paths)
    if missing and (on_missing == "raise" or not found):
        raise IntakeError(MISSING_FILE, "input object not found", ",".join(missing))
    bins = spark.read.format("binaryFile").load(found).select("path", "content")
    return bins.mapInPandas(_parse_batches(sheet), f"{GRID_SCHEMA}, {ERROR_COL} string")


def read_workbooks(spark: SparkSession, paths, sheet=0, on_missing: str = "raise") -> DataFrame:
    """``(_file, filename, sheet, _temp_row_num, cells)`` of the workbooks that can be parsed;
    :func:`scan_workbooks` also names the others."""
    rows = scan_workbooks(spark, paths, sheet, on_missing)
    broken = rows.filter(F.col(ERROR_COL).isNotNull()).select(FILE_COL)
    return rows.join(broken, FILE_COL, "left_anti").select(
        FILE_COL, "filename", "sheet", ROW_COL, "cells")
