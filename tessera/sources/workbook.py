"""Cells of XLSX and ODS workbooks as text, from their XML parts; no library beside Python's own."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

_XLSX = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_TABLE = "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}"
_TEXT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}"
_OFFICE = "{urn:oasis:names:tc:opendocument:xmlns:office:1.0}"
#: Repeated blank cells and rows beyond this are padding of the sheet, not data.
_PADDING = 1_000


def sheets(content: bytes) -> dict[str, list[list[str]]]:
    """Rows of cells by sheet, in order; empty cells are empty texts."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return _xlsx(z) if "xl/workbook.xml" in z.namelist() else _ods(z)


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]*", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _xlsx(z: zipfile.ZipFile) -> dict[str, list[list[str]]]:
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{_XLSX}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_XLSX}si")]
    target = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    out = {}
    for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_XLSX}sheet"):
        path = target[sheet.get(_REL)]
        rows = []
        for row in ElementTree.fromstring(z.read(path.lstrip("/") if path.startswith("/") else f"xl/{path}")).iter(f"{_XLSX}row"):
            cells: list[str] = []
            for c in row.iter(f"{_XLSX}c"):
                at = _column(c.get("r", "")) if c.get("r") else len(cells)
                cells += [""] * (at + 1 - len(cells))
                v = c.find(f"{_XLSX}v")
                if c.get("t") == "s" and v is not None:
                    cells[at] = shared[int(v.text)]
                elif c.get("t") == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(f"{_XLSX}t"))
                elif v is not None:
                    cells[at] = re.sub(r"\.0$", "", v.text or "")
            rows.append(cells)
        out[sheet.get("name")] = [r for r in rows if any(x.strip() for x in r)]
    return out


def _ods(z: zipfile.ZipFile) -> dict[str, list[list[str]]]:
    out = {}
    for table in ElementTree.fromstring(z.read("content.xml")).iter(f"{_TABLE}table"):
        rows = []
        for row in table.iter(f"{_TABLE}table-row"):
            cells: list[str] = []
            for c in row:
                if c.tag not in (f"{_TABLE}table-cell", f"{_TABLE}covered-table-cell"):
                    continue
                value = "\n".join("".join(p.itertext()) for p in c.iter(f"{_TEXT}p")) or c.get(f"{_OFFICE}value", "")
                n = int(c.get(f"{_TABLE}number-columns-repeated", "1"))
                cells += [value] * (n if value or n <= _PADDING else 0)
            n = int(row.get(f"{_TABLE}number-rows-repeated", "1"))
            if any(x.strip() for x in cells):
                rows += [cells] * n
        out[table.get(f"{_TABLE}name")] = rows
    return out
