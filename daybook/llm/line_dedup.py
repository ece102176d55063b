"""Lines that many documents share, dropped from all but one of them.

Method: range-partition line hashes with a secondary sort by document and position, stream the first occurrence
of every key, and hand back one compressed keep bitmap per document; texts do not travel with the lines.
DataFrame functions only.

A line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at its ends and with A-Z in lower case,
hashed to 128 bits.  A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses
all its lines but those of the largest document id that holds it.

Defined cases: a null or empty text is one empty line and is returned empty.  Rows with one document id are one
document when documents are counted; each row keeps its own bitmap, found by id and text, so repeated rows come
out alike.  A null id counts as one more document, smaller than any other.  Other columns pass through untouched
(``apply_bitmaps``), but for ``n_lines`` and ``n_dropped``, whose places the counts take where these are asked for; or
they are ignored.  No rows in, no rows out.

Skew: a key may hold any share of the lines.  Lines of a key are streamed in slices of ``DOCS_PER_SLICE``
document ids, so that no task needs all of them; slices are pre-aggregated before they meet, and decisions go back to the
lines by key and slice.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.staging import Stages

SPACE = " \t\n\x0b\f\r"
DOCS_PER_SLICE = 1024
_BITS = 64


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _lines(column: str) -> Column:
    return F.split(_text(column), "\n", -1)


def _row_key(column: str) -> Column:
    # tells apart rows that share an id but not a text
    return F.xxhash64(_text(column))


def line_hashes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """One row per line with a key of at least ``min_chars``: id, row key, position, two 64-bit hashes."""
    lines = docs.select(
        F.col(id_col).alias("_id"), _row_key(text_col).alias("_row"), F.posexplode(_lines(text_col)).alias("_pos", "_line")
    ).where(F.length("_line") >= min_chars)
    key = F.translate(F.btrim("_line", F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase)
    return (
        lines.select("_id", "_row", "_pos", key.alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select("_id", "_row", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )


def keep_bitmaps(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """``_id, _row, dropped``: for every row that loses lines, a map from word to the 64 bits of its lost lines.

    The bitmap is compressed by leaving out words without a lost line: all lines of an absent word, and of a row
    that is not listed, are kept.
    """
    stages = Stages(docs.sparkSession, "line-dedup")
    hashes = stages.write(
        line_hashes(docs, id_col=id_col, text_col=text_col, min_chars=min_chars).withColumn(
            "_slice", F.coalesce(F.floor(F.col("_id") / DOCS_PER_SLICE), F.lit(-1))
        )
    )
    # Hashes in range partitions, by document and position within a key: the window finds its rows clustered and
    # streams them; the first row of each document in a slice counts it.
    ranged = hashes.repartitionByRange("_h1", "_h2", "_slice")
    occurrence = Window.partitionBy("_h1", "_h2", "_slice").orderBy(F.desc_nulls_last("_id"), "_row", "_pos")
    new_doc = F.when(F.row_number().over(occurrence) == 1, 1).when(
        F.col("_id").eqNullSafe(F.lag("_id").over(occurrence)), 0
    ).otherwise(1)
    runs = stages.write(ranged.select("_h1", "_h2", "_slice", "_id", "_row", "_pos", new_doc.alias("_new_doc")))
    stages.drop(hashes)
    # one row for each key and slice, so that a key with any share of the lines has few; those of shared keys go back to
    # the lines by slice as well, and no task gets all lines of a key
    held = stages.write(
        runs.where("_new_doc = 1").groupBy("_h1", "_h2", "_slice").agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_last"))
    )
    shared = (
        held.groupBy("_h1", "_h2")
        .agg(F.sum("_docs").alias("_docs"), F.max("_last").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
    )
    keepers = held.join(shared.select("_h1", "_h2", "_keeper"), ["_h1", "_h2"]).select("_h1", "_h2", "_slice", "_keeper")
    lost = runs.join(keepers, ["_h1", "_h2", "_slice"]).where(~F.col("_id").eqNullSafe(F.col("_keeper")))
    words = lost.groupBy("_id", "_row", F.expr(f"_pos div {_BITS}").cast("int").alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, _pos % {_BITS})")).alias("_bits")
    )
    bitmaps = words.groupBy("_id", "_row").agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("dropped")
    )
    bitmaps = stages.write(bitmaps)
    stages.drop(runs)
    stages.drop(held)
    return bitmaps


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", counts: bool = True
) -> DataFrame:
    """The documents with ``text_col`` cut to its kept lines, and with ``counts`` ``n_lines`` (before) and ``n_dropped``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    inner_id, inner_text = f"_doc.`{id_col}`", f"_doc.`{text_col}`"
    marks = bitmaps.select(F.col("_id").alias("_mark_id"), F.col("_row").alias("_mark_row"), "dropped")
    joined = rows.join(
        marks,
        F.col(inner_id).eqNullSafe(F.col("_mark_id")) & (_row_key(inner_text) == F.col("_mark_row")),
        "left",
    )
    lines = _lines(inner_text)

    def stays(_, i: Column) -> Column:
        bits = F.coalesce(F.try_element_at("dropped", F.floor(i / _BITS).cast("int")), F.lit(0).cast("long"))
        return F.bit_get(bits, (i % _BITS).cast("int")) == 0

    text = F.when(F.col("dropped").isNull(), _text(inner_text)).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    gone = F.coalesce(
        F.aggregate(F.map_values("dropped"), F.lit(0).cast("long"), lambda n, bits: n + F.bit_count(bits)),
        F.lit(0).cast("long"),
    )
    n_lines = (F.length(_text(inner_text)) - F.length(F.replace(_text(inner_text), F.lit("\n"))) + 1).cast("long")
    numbers = {"n_lines": n_lines, "n_dropped": gone} if counts else {}
    own = [c for c in docs.columns if c.lower() not in numbers]
    return joined.select(
        *[(text if c == text_col else F.col(f"_doc.`{c}`")).alias(c) for c in own], *[n.alias(c) for c, n in numbers.items()]
    )


def dedup_lines(docs: DataFrame, counts: bool = True, **settings) -> DataFrame:
    """Documents without the lines that others keep for them; see the module docstring."""
    columns = {k: v for k, v in settings.items() if k in ("id_col", "text_col")}
    return apply_bitmaps(docs, keep_bitmaps(docs, **settings), counts=counts, **columns)
