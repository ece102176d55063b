"""Worksheets of Office Open XML workbooks (``.xlsx``) as rows of text, without a connector.

Spark lists and reads the files, one row a file; a task parses its files one after another and hands rows on as it meets
them.  Of a file it holds the packed bytes, the table of shared texts (one buffer with offsets) and a batch of rows, never
the sheet's XML tree.  A sheet has at most 1,048,576 rows by its format, so a file is not split.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from array import array
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from decimal import Decimal, InvalidOperation
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the library

# Built-in number formats that show a day, a time or both.
DAY_FORMATS = (14, 15, 16, 17)
CLOCK_FORMATS = (18, 19, 20, 21, 45, 46, 47)
MOMENT_FORMATS = (22,)

_BATCH_CELLS = 20_000
_NOT_LETTERS = re.compile(r'"[^"]*"|\\.|_.|\*.|\[[^\]]*\]')  # quoted text, escapes, colours and locales of a format
_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _children(element: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [e for e in element if _local(e.tag) == name]


def _text_of(element: ElementTree.Element) -> str:
    """The text of a shared or inline string: its runs joined, phonetic hints left out."""
    parts = []
    for child in element:
        if _local(child.tag) == "t":
            parts.append(child.text or "")
        elif _local(child.tag) == "r":
            parts += [t.text or "" for t in _children(child, "t")]
    return _plain("".join(parts))


def _plain(text: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


class _Texts:
    """Shared texts by number, in one buffer."""

    def __init__(self) -> None:
        self.buffer, self.ends = bytearray(), array("q", [0])

    def add(self, text: str) -> None:
        self.buffer += text.encode("utf-8", "surrogatepass")
        self.ends.append(len(self.buffer))

    def __getitem__(self, n: int) -> str:
        return self.buffer[self.ends[n] : self.ends[n + 1]].decode("utf-8", "replace")


def _elements(book: zipfile.ZipFile, part: str, name: str) -> Iterator[ElementTree.Element]:
    """Each element of a name, of whose part no more than it is held."""
    with book.open(part) as stream:
        open_elements: list[ElementTree.Element] = []
        for event, element in ElementTree.iterparse(stream, ("start", "end")):
            if event == "start":
                open_elements.append(element)
                continue
            open_elements.pop()
            if _local(element.tag) == name:
                yield element
                if open_elements:
                    open_elements[-1].remove(element)


def _small_part(book: zipfile.ZipFile, part: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(book.read(part)) if part in book.namelist() else None


def _targets(book: zipfile.ZipFile) -> dict[str, str]:
    """Relation id to part, for the workbook's relations."""
    relations = _small_part(book, "xl/_rels/workbook.xml.rels")
    found = {}
    for relation in relations if relations is not None else ():
        target = relation.get("Target", "")
        found[relation.get("Id", "")] = target[1:] if target.startswith("/") else f"xl/{target}"
    return found


def _sheet_part(book: zipfile.ZipFile, sheet: str | int) -> tuple[str, bool]:
    """The part that holds a sheet, by name or position, and whether days count from 1904."""
    root = _small_part(book, "xl/workbook.xml")
    if root is None:
        raise ValueError("no workbook in it")
    sheets = [s for group in _children(root, "sheets") for s in group]
    names = [s.get("name", "") for s in sheets]
    if isinstance(sheet, str):
        chosen = next((s for s, n in zip(sheets, names) if n.lower() == sheet.lower()), None)
    else:
        chosen = sheets[sheet] if 0 <= sheet < len(sheets) else None
    if chosen is None:
        raise ValueError(f"no sheet {sheet!r} among {names}")
    relation = next(v for k, v in chosen.attrib.items() if _local(k) == "id")
    from_1904 = any(p.get("date1904") in ("1", "true") for p in _children(root, "workbookPr"))
    return _targets(book)[relation], from_1904


def _shows(code: str) -> str:
    """What a number format shows: ``day``, ``clock``, ``moment`` or nothing of that kind."""
    letters = _NOT_LETTERS.sub("", code.split(";")[0]).lower()
    day, clock = bool(re.search("[yd]", letters)), bool(re.search("[hs]", letters)) or "[h" in code.lower()
    if not day and not clock and re.fullmatch(r"[\s/.-]*m+[\s/.-]*", letters):
        day = True
    return {(True, True): "moment", (True, False): "day", (False, True): "clock"}.get((day, clock), "")


def _styles(book: zipfile.ZipFile) -> list[str]:
    """What cells of each style show."""
    root = _small_part(book, "xl/styles.xml")
    if root is None:
        return []
    shown = dict.fromkeys(DAY_FORMATS, "day") | dict.fromkeys(CLOCK_FORMATS, "clock") | dict.fromkeys(MOMENT_FORMATS, "moment")
    for group in _children(root, "numFmts"):
        shown |= {int(f.get("numFmtId", -1)): _shows(f.get("formatCode", "")) for f in group}
    return [shown.get(int(x.get("numFmtId", 0)), "") for group in _children(root, "cellXfs") for x in group]


def _number(value: str, shown: str, from_1904: bool) -> str:
    """A number as plain digits; days and times as ``yyyy-MM-dd`` and ``HH:mm:ss``."""
    try:
        number = Decimal(value)
    except InvalidOperation:
        return value
    if not shown or not 0 <= number < 2958466:  # the format ends with the year 9999
        whole = number == number.to_integral_value() and number.adjusted() < 30
        return str(int(number)) if whole else format(number.normalize(), "f")
    # the format takes 1900 for a leap year
    first = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 31 if number < 60 else 30)
    moment = first + timedelta(seconds=round(number * 86400))
    if shown == "clock":
        return moment.strftime("%H:%M:%S")
    day = f"{moment.year:04d}-{moment.month:02d}-{moment.day:02d}"
    return day if shown == "day" and number == int(number) else f"{day} {moment:%H:%M:%S}"


def _column_number(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def rows_of(content: bytes, width: int, sheet: str | int = 0, header: bool = True) -> Iterator[list[str | None]]:
    """The first ``width`` cells of each row; rows of none but empty cells are passed over, and the first one if a header."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part, from_1904 = _sheet_part(book, sheet)
        styles, texts = _styles(book), _Texts()
        if "xl/sharedStrings.xml" in book.namelist():
            for element in _elements(book, "xl/sharedStrings.xml", "si"):
                texts.add(_text_of(element))
        skip = header
        for row in _elements(book, part, "row"):
            cells: list[str | None] = [None] * width
            filled, at = False, -1
            for cell in _children(row, "c"):
                reference = cell.get("r")
                at = _column_number(reference) if reference else at + 1
                value = _cell(cell, texts, styles, from_1904)
                filled = filled or bool(value)
                if at < width:
                    cells[at] = value or None
            if filled and not skip:
                yield cells
            skip = skip and not filled


def _cell(cell: ElementTree.Element, texts: _Texts, styles: list[str], from_1904: bool) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_text_of(e) for e in _children(cell, "is"))
    value = next((e.text for e in _children(cell, "v")), None)
    if value is None:
        return None
    if kind == "s":
        return texts[int(value)]
    if kind == "b":
        return "TRUE" if value.strip() == "1" else "FALSE"
    if kind == "n":
        style = int(cell.get("s", 0))
        return _number(value, styles[style] if style < len(styles) else "", from_1904)
    return _plain(value)  # text of a formula, an error, an ISO date


def parse(files: DataFrame, names: Sequence[str], sheet: str | int = 0, header: bool = True) -> DataFrame:
    """Rows of the workbooks in a frame of ``path, content``, every column text under the given names, by position.

    Empty cells are NULL, as are those a row lacks; cells beyond the names and rows without a value are left out.  Numbers come as
    plain digits, in full; numbers shown as days or times as such.  A file that cannot be read is an error that names it.
    """
    names = list(names)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    arrow = pa.schema([(f"c{n}", pa.string()) for n in range(len(names))])
    at_once = max(1, _BATCH_CELLS // max(1, len(names)))

    def batch(rows: list[list[str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, pa.string()) for column in zip(*rows)], schema=arrow).rename_columns(names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list[str | None]] = []
        for found in batches:
            for path, content in zip(found.column(0), found.column(1)):
                try:
                    for row in rows_of(content.as_buffer(), len(names), sheet, header):
                        rows.append(row)
                        if len(rows) == at_once:
                            yield batch(rows)
                            rows = []
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError) as error:
                    raise ValueError(f"{path.as_py()} cannot be read as a workbook: {error!r}") from error
        if rows:
            yield batch(rows)

    return files.select("path", "content").mapInArrow(each, schema)


def read(spark: SparkSession, path: str, names: Sequence[str], sheet: str | int = 0, header: bool = True) -> DataFrame:
    """A worksheet of each workbook at a path (file, folder or pattern) that Spark can read; files without bytes are passed over."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!~.]*.xlsx").load(path)
    return parse(files, names, sheet, header)
