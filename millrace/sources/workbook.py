"""Workbooks (.xlsx) as a Spark data source: one task per file, rows as text columns.

The named sheet is read, else the active one; row 1 is the header. A sheet holds at most about a
million rows, so a file is a bounded piece of work. Cells are streamed from the zipped XML.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from io import BytesIO
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def _column_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as fh:
        for _, el in ET.iterparse(fh):
            if el.tag == _MAIN + "si":
                out.append("".join(t.text or "" for t in el.iter(_MAIN + "t")))
                el.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indices of the cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    own = {
        int(f.get("numFmtId")): re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", f.get("formatCode", ""))
        for f in root.findall(f"{_MAIN}numFmts/{_MAIN}numFmt")
    }
    # fixed values: the built-in date and time formats
    dated = {*range(14, 23), *range(45, 48), *(n for n, code in own.items() if re.search("[ymdhs]", code, re.I))}
    return {i for i, x in enumerate(root.findall(f"{_MAIN}cellXfs/{_MAIN}xf")) if int(x.get("numFmtId", "0")) in dated}


def _as_date(serial: str) -> str:
    """A day count as the text of its date and time."""
    return str((datetime(1899, 12, 30) + timedelta(seconds=round(float(serial) * 86400))))


def _sheet_member(book: zipfile.ZipFile, sheet: str) -> str:
    root = ET.fromstring(book.read("xl/workbook.xml"))
    sheets = root.findall(f"{_MAIN}sheets/{_MAIN}sheet")
    named = [s for s in sheets if s.get("name") == sheet]
    view = root.find(f"{_MAIN}bookViews/{_MAIN}workbookView")
    active = int(view.get("activeTab", "0")) if view is not None else 0
    chosen = named[0] if named else sheets[active]
    rels = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.findall(_PKG + "Relationship") if r.get("Id") == chosen.get(_REL + "id"))
    return target.lstrip("/") if target.startswith("/") else "xl/" + target


def sheet_rows(data: bytes, sheet: str) -> Iterator[list[str | None]]:
    """Rows of one sheet as lists of text, header first."""
    with zipfile.ZipFile(BytesIO(data)) as book:
        strings, dated = _shared_strings(book), _date_styles(book)
        with book.open(_sheet_member(book, sheet)) as fh:
            for _, el in ET.iterparse(fh):
                if el.tag != _MAIN + "row":
                    continue
                row: list[str | None] = []
                for i, cell in enumerate(el.findall(_MAIN + "c")):
                    at = _column_index(cell.get("r")) if cell.get("r") else i
                    row.extend([None] * (at + 1 - len(row)))
                    kind, value = cell.get("t"), cell.find(_MAIN + "v")
                    if kind == "inlineStr":
                        row[at] = "".join(t.text or "" for t in cell.iter(_MAIN + "t"))
                    elif value is not None and value.text is not None:
                        if kind == "s":
                            row[at] = strings[int(value.text)]
                        elif kind == "b":
                            row[at] = str(value.text == "1")
                        elif kind in (None, "n") and int(cell.get("s", "0")) in dated:
                            row[at] = _as_date(value.text)
                        else:
                            row[at] = value.text
                yield row
                el.clear()


def read_workbook(spark: SparkSession, path: str, sheet: str, columns=None, glob: str = "*.xlsx") -> DataFrame:
    """All workbooks under `path` as text columns named by the header of the first (or `columns`).

    Files come through Spark's own binary reader, so any file system works and each file is a task;
    a column a file lacks is NULL. A folder whose sheets are all empty gives no columns and no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    if columns is None:
        # listing alone finds the first path; only that file is then opened
        first = files.select("path").orderBy("path").first()
        if first is None:
            raise FileNotFoundError(f"no workbook under {path}")
        content = spark.read.format("binaryFile").load(first["path"]).select("content").first()[0]
        columns = next((["" if h is None else str(h) for h in r] for r in sheet_rows(bytes(content), sheet)), [])
        if not columns:
            return spark.createDataFrame([], "struct<>")
    names = list(columns)

    def rows_of(batches):
        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                rows = sheet_rows(bytes(content), sheet)
                header = next(rows, None)
                if header is None:
                    continue
                at = {h: i for i, h in enumerate(header)}
                picks = [at.get(n) for n in names]
                chunk = []
                for row in rows:
                    chunk.append([row[i] if i is not None and i < len(row) else None for i in picks])
                    if len(chunk) == 10000:
                        yield pd.DataFrame(chunk, columns=names, dtype=object)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=names, dtype=object)

    schema = ", ".join(f"`{n}` string" for n in names)
    return files.select("content").mapInPandas(rows_of, schema)


def workbook_bytes(header: list[str], rows, sheet: str) -> bytes:
    """A one-sheet workbook with inline text cells."""

    def line(cells) -> str:
        return "<row>" + "".join(
            "<c/>" if c is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(c))}</t></is></c>'
            for c in cells
        ) + "</row>"

    main, rel = _MAIN[1:-1], _REL[1:-1]
    body = "".join(line(r) for r in [header, *rows])
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{_PKG[1:-1]}"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PKG[1:-1]}"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()
