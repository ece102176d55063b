"""Fill-in-middle transformation by repeated-capture matching.

Method: one ``fullmatch`` of ``(unit)*`` by the regex library retains every repetition of the group.  ``match.ends(1)``
is the list of all units' ends: its length is the number of units, and the two cuts are looked up in it, so that
nothing steps through a text.  Two numbers drawn from the document's id choose how many units come before each cut.

A text of n units is cut into prefix, middle and suffix and put together again as ``psm`` (prefix, suffix, middle) or
``spm`` (suffix, prefix, middle), each part behind its mark.  ``restored`` takes an output apart at its marks, in
DataFrame functions, and gives the text back.

Memory: a task holds one text at a time, with some 120 bytes for each of its units while it is matched, and hands on
rows of ``_ROW_CHARS`` characters together (one row at least).  There is no shuffle, and no limit on a text's length.

Defined cases: a null text is an empty one.  Texts that are empty, hold one of the marks or are no sequence of units
(with a unit of one's own; n is 0 then) stay ``plain``, as do those that the draw leaves out; these have no prefix or
middle.  A null id draws as the empty text does.  Repeated rows come out alike, a row each.  Extra columns are ignored.
No rows in, no rows out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")  # of prefix, suffix and middle
UNIT = r"(?s:.)"  # a code point
_ROW_CHARS = 4_000_000


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32: the first 8-digit groups of the hex SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def cuts(text: str, units, first: int, second: int) -> tuple[int, int, int] | None:
    """How many units a text has and the code points before its two cuts; ``units`` is a compiled ``(unit)*``."""
    match = units.fullmatch(text)
    if match is None:
        return None
    ends = match.ends(1)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def transform(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", unit: str = UNIT, seed: int = 1,
    plain_from: int = 90, spm_below: int = 20, marks: Sequence[str] = MARKS,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each document; the lengths are in code points.

    A document is transformed if its third draw's last two digits are below ``plain_from``, as ``spm`` if those of its
    fourth are below ``spm_below``.  ``unit`` is a pattern of the regex library without groups.
    """
    of_prefix, of_suffix, of_middle = marks
    h = draws(F.col(id_col), seed)
    picked = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        h[0].alias("first"), h[1].alias("second"),
        F.when(h[2] % 100 >= plain_from, "plain").when(h[3] % 100 < spm_below, "spm").otherwise("psm").alias("form"),
    )
    kind = picked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"

    def one(text: str, first: int, second: int, form: str, units) -> tuple:
        found = cuts(text, units, first, second)
        n = found[0] if found else 0
        if form == "plain" or not n or any(mark in text for mark in marks):
            return n, "plain", None, None, text
        _, low, high = found
        prefix, suffix = of_prefix + text[:low], of_suffix + text[high:]
        parts = (prefix, suffix) if form == "psm" else (suffix, prefix)
        return n, form, low, high - low, "".join((*parts, of_middle, text[low:high]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        units = regex.compile(f"({unit})*")
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            ids, *given = batch.columns
            rows, start, chars = [], 0, 0
            for row in zip(*given):
                rows.append(one(*[x.as_py() for x in row], units))
                chars += len(rows[-1][-1])
                if chars >= _ROW_CHARS or start + len(rows) == batch.num_rows:
                    made = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
                    yield pa.RecordBatch.from_arrays([ids.slice(start, len(rows)), *made], names)
                    start, rows, chars = start + len(rows), [], 0

    return picked.mapInArrow(each, schema)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output was made of: no part holds a mark, so the marks are where it is put together."""
    parts = F.split(output, "|".join(re.escape(mark) for mark in marks), -1)
    prefix = F.when(form == "psm", parts[1]).otherwise(parts[2])
    suffix = F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))
