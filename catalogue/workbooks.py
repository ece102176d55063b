"""Workbooks made from a frame, for queries and tests that read them."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Name spaces and parts of a workbook.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
KINDS = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def letters(n: int) -> str:
    """The name of a column by position: A, B, … Z, AA."""
    name = ""
    n += 1
    while n:
        n, rest = divmod(n - 1, 26)
        name = chr(65 + rest) + name
    return name


def book(sheets: dict[str, str], shared: list[str] = (), styles: str = "", properties: str = "") -> bytes:
    """A workbook of sheets given as the XML of their rows; shared texts as the XML inside ``si``."""
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{TYPES}"><Default Extension="rels" '
        'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{KINDS}.sheet.main+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{PACKAGE}"><Relationship Id="rId1" Type="{DOCUMENT}/officeDocument" '
        'Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{DOCUMENT}">{properties}<sheets>'
        + "".join(f'<sheet name="{escape(s)}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1))
        + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}">'
        + "".join(
            f'<Relationship Id="rId{n}" Type="{DOCUMENT}/worksheet" Target="worksheets/sheet{n}.xml"/>'
            for n, _ in enumerate(sheets, 1)
        )
        + "</Relationships>",
    }
    if shared:
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>"
    if styles:
        parts["xl/styles.xml"] = f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>'
    for n, rows in enumerate(sheets.values(), 1):
        parts[f"xl/worksheets/sheet{n}.xml"] = f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as packed:
        for name, text in parts.items():
            packed.writestr(name, text.encode("utf-8"))
    return out.getvalue()


def from_rows(names: list[str], rows: list[tuple]) -> bytes:
    """One sheet with a header; texts are shared, numbers are numbers, NULL is no cell."""
    numbers: dict[str, int] = {}

    def cell(at: int, line: int, value) -> str:
        if value is None:
            return ""
        place = f"{letters(at)}{line}"
        if isinstance(value, str):
            return f'<c r="{place}" t="s"><v>{numbers.setdefault(value, len(numbers))}</v></c>'
        return f'<c r="{place}"><v>{value!r}</v></c>'

    lines = [
        f'<row r="{n}">' + "".join(cell(at, n, v) for at, v in enumerate(row)) + "</row>"
        for n, row in enumerate([tuple(names), *rows], 1)
    ]
    return book({"Sheet1": "".join(lines)}, [f'<t xml:space="preserve">{escape(t)}</t>' for t in numbers])


def made_from(df: DataFrame, rows_each: int) -> DataFrame:
    """``path, content``: workbooks of up to so many rows, made where the rows are."""
    names = df.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            for start in range(0, found.num_rows, rows_each):
                rows = [tuple(r.values()) for r in found.slice(start, rows_each).to_pylist()]
                content = from_rows(names, rows)
                yield pa.RecordBatch.from_pydict({"path": ["made.xlsx"], "content": pa.array([content], pa.binary())})

    return df.mapInArrow(each, "path string, content binary")
