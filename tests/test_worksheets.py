"""Worksheets as rows of text."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from catalogue import workbooks
from daybook.plans import load
from daybook.session import new_database
from daybook.sources import files, worksheets

STYLES = (
    '<numFmts count="5"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="[$-409]d/m/yy h:mm"/>'
    '<numFmt numFmtId="166" formatCode="0.00&quot;days&quot;"/><numFmt numFmtId="167" formatCode="[Red]#,##0"/>'
    '<numFmt numFmtId="168" formatCode="[h]:mm:ss"/></numFmts><cellXfs>'
    + "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 22, 20, 164, 165, 166, 167, 168))
    + "</cellXfs>"
)


def cells(*values, r=None):
    return f"<row{f' r=\"{r}\"' if r else ''}>" + "".join(values) + "</row>"


def number(value, style=0):
    return f'<c s="{style}"><v>{value}</v></c>'


def parsed(content, width=3, **settings):
    return list(worksheets.rows_of(content, width, **settings))


def test_kinds_of_cells():
    content = workbooks.book(
        {"S": cells("<c t='s'><v>0</v></c>", "<c t='inlineStr'><is><t>in</t><r><t>line</t></r></is></c>", "<c t='str'><v>f_x000A_g</v></c>")
         + cells("<c t='b'><v>1</v></c>", "<c t='e'><v>#N/A</v></c>", "<c t='d'><v>2024-01-02</v></c>")
         + cells("<c><f>A1+1</f></c>", "<c t='s'><v>1</v></c>", "<c><f>1+1</f><v>2</v></c>")},
        ["<r><t>ri</t></r><r><t>ch &lt;</t></r><rPh><t>no</t></rPh>", "<t/>"],
    )
    assert parsed(content, header=False) == [["rich <", "inline", "f\ng"], ["TRUE", "#N/A", "2024-01-02"], [None, None, "2"]]


@pytest.mark.parametrize(
    ("value", "style", "expected"),
    [
        ("1", 0, "1"), ("1.0", 0, "1"), ("-0.5", 0, "-0.5"), ("1.25E3", 0, "1250"), ("1E-7", 0, "0.0000001"),
        ("0.30000000000000004", 0, "0.30000000000000004"), ("12345678901234567890", 0, "12345678901234567890"),
        ("45306", 1, "2024-01-15"), ("45306.5", 1, "2024-01-15 12:00:00"), ("45306.75", 2, "2024-01-15 18:00:00"),
        ("45306", 2, "2024-01-15 00:00:00"), ("0.25", 3, "06:00:00"), ("45306", 4, "2024-01-15"),
        ("45306.999994", 5, "2024-01-15 23:59:59"), ("3.5", 6, "3.5"), ("45306", 7, "45306"), ("0.5", 8, "12:00:00"),
        ("1", 1, "1900-01-01"), ("59", 1, "1900-02-28"), ("61", 1, "1900-03-01"), ("-3", 1, "-3"), ("9", 99, "9"), ("abc", 0, "abc"),
    ],
)
def test_numbers_days_and_times(value, style, expected):
    assert parsed(workbooks.book({"S": cells(number(value, style))}, styles=STYLES), 1, header=False) == [[expected]]


def test_days_from_1904():
    content = workbooks.book({"S": cells(number("43844", 1))}, styles=STYLES, properties='<workbookPr date1904="1"/>')
    assert parsed(content, 1, header=False) == [["2024-01-15"]]


def test_places_headers_and_empty_rows():
    content = workbooks.book(
        {"First": cells("<c r='B2' t='str'><v>head</v></c>", r=2) + cells(r=3)
         + cells("<c r='C4'><v>3</v></c>", "<c r='AB4'><v>28</v></c>", r=4) + cells("<c r='A5' t='str'><v></v></c>", r=5)
         + cells("<c r='A6'><v>1</v></c>", r=6),
         "Second &amp; last": cells(number(7)), "None": ""},
    )
    assert parsed(content) == [[None, None, "3"], ["1", None, None]]
    assert parsed(content, 28)[0][27] == "28"
    assert parsed(content, 1, sheet=1, header=False) == parsed(content, 1, sheet="second &AMP; LAST", header=False) == [["7"]]
    assert parsed(content, sheet="None") == [] == parsed(content, sheet=1)
    for missing in (3, -1, "Third"):
        with pytest.raises(ValueError, match="Third|no sheet"):
            parsed(content, sheet=missing)


def test_round_trip_of_files(spark, tmp_path):
    draw = random.Random(3)
    texts = ["", " a ", "<&>\"'", "多", "line\nbreak", "same", "x" * 30000, None]
    rows = [(i, draw.choice(texts), draw.choice([0.5, -2.25, None])) for i in range(25_000)]
    for n, part in enumerate((rows[:20_000], rows[20_000:], [])):
        (tmp_path / f"{n}.xlsx").write_bytes(workbooks.from_rows(["a", "b", "c"], part))
    (tmp_path / "~$0.xlsx").write_bytes(b"a lock")
    (tmp_path / "notes.txt").write_text("other")
    df = files.read_excel(spark, str(tmp_path), "id, text, x")
    expected = sorted((str(i), t or None, None if x is None else str(x)) for i, t, x in rows)
    assert df.columns == ["id", "text", "x"]
    assert sorted(tuple(r) for r in df.collect()) == expected
    assert df.where(F.col("text") == "same").count() == sum(t == "same" for _, t, _ in rows)


def test_files_that_are_no_workbooks(spark, tmp_path):
    good = workbooks.from_rows(["a"], [(1,)])
    for name, content in {"torn": good[: len(good) // 2], "old": b"\xd0\xcf\x11\xe0"}.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / f"{name}.xlsx").write_bytes(content)
        with pytest.raises(Exception, match=f"{name}.xlsx cannot be read"):
            files.read_excel(spark, str(folder), "a").collect()
    (tmp_path / "nothing.xlsx").write_bytes(b"")  # Spark passes over files without bytes
    assert files.read_excel(spark, str(tmp_path / "nothing.xlsx"), "a").count() == 0
    broken = workbooks.book({"S": cells("<c t='s'><v>4</v></c>")}, ["<t>only</t>"])
    with pytest.raises(Exception, match="cannot be read"):
        worksheets.parse(spark.createDataFrame([("b", bytearray(broken))], "path string, content binary"), ["a"], header=False).collect()


def test_sheet_load(spark, tmp_path):
    rows = [("a", "2024年1月5日"), ("b", "2024|1|6")]
    (tmp_path / "in.xlsx").write_bytes(workbooks.from_rows(["name", "day"], rows))
    table = f"{new_database(spark, 'test')}.sheet"
    loaded = load.load_sheet(files.read_excel(spark, str(tmp_path / "in.xlsx"), "name,day"), table, "day", "2024-01-05", "2024-01-06")
    assert sorted((r["name"], str(r["dt"])) for r in loaded.collect()) == [("a", "2024-01-05"), ("b", "2024-01-06")]
