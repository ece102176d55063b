from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from daybook.llm import fill_middle
from daybook.llm.queries import op13_fill_middle


def brute(doc_id, text):
    """n, form, prefix, middle and output by the definition."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, suffix + prefix + middle
    return n, "psm", a, b - a, prefix + suffix + middle


def made(docs, **settings):
    rows = fill_middle.transform(docs, **settings)
    return rows.withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()


def test_odd_rows(odd_docs, no_docs):
    expected = sorted((str(r["doc_id"]), *brute(r["doc_id"], r["text"])) for r in odd_docs.collect())
    found = made(odd_docs)
    assert sorted((str(r["doc_id"]), *r[1:6]) for r in found) == expected
    assert sorted(r["again"] for r in found) == sorted(r["text"] or "" for r in odd_docs.collect())
    assert made(no_docs) == []


def test_marks_and_what_looks_like_them(spark):
    texts = ["<P", "S>", "<P>x", "a<S>", "<M>", "<<P", "<P<S<M", ">>", "<", "P>", "<P\n>", "x<S" * 40, "<M" * 40, "é😀" * 50, "퟿"]
    docs = spark.createDataFrame([(i * 100 + j, t) for i, t in enumerate(texts) for j in range(30)], "doc_id long, text string")
    found = made(docs)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    for r in found:
        text = texts[r["doc_id"] // 100]
        assert tuple(r[1:6]) == brute(r["doc_id"], text)
        assert r["again"] == text


def test_other_units(spark):
    docs = spark.createDataFrame([(i, "one two  three\nfour ") for i in range(20)] + [(99, "\x00")], "doc_id long, text string")
    found = made(docs, unit=r"\S+\s+")
    assert {(r["n"], r["form"]) for r in found if r["doc_id"] == 99} == {(0, "plain")}
    whole = [r for r in found if r["form"] != "plain"]
    assert whole and {r["n"] for r in whole} == {4}
    starts = {0, 4, 9, 15, 20}
    assert {r["prefix_chars"] for r in whole} <= starts
    assert {r["prefix_chars"] + r["middle_chars"] for r in whole} <= starts
    assert {r["again"] for r in found if r["doc_id"] != 99} == {"one two  three\nfour "}


def test_long_texts_are_handed_on_apart(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "_ROW_CHARS", 10)
    rows = [(i, "ab" * (i % 17)) for i in range(100)]
    found = made(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted((r["doc_id"], *r[1:6]) for r in found) == sorted((i, *brute(i, t)) for i, t in rows)


@pytest.mark.parametrize("kind", ["string", "int"])
def test_ids_of_other_types(spark, kind):
    docs = spark.createDataFrame([(7, "some text")], "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    assert tuple(made(docs)[0][1:6]) == brute(7, "some text")


def test_query(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op13_fill_middle(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        *shape, output = brute(r["doc_id"], texts[r["doc_id"]])
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (output, texts[r["doc_id"]] or "")]
        assert tuple(r)[1:] == (*shape, *digests)
