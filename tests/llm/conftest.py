from __future__ import annotations

import os

import pytest

SMALL = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no generated tables")
    return SMALL


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, one id with two texts, a clashing column."""
    rows = [
        (1, "a shared line of some length\nown line one", "en", "s", 10, "x"),
        (2, "A SHARED line of some length  \nown line two", "en", "s", 10, "x"),
        (3, "\ta shared line of some length\n\nown line three", None, None, None, None),
        (4, None, "de", "s", None, "x"),
        (5, "", "de", "s", 0, "x"),
        (6, " \n\t ", "de", "s", 4, "x"),
        (7, "wort " * 30_000, "de", "s", 150_000, "x"),
        (8, "z" * 5_000, "en", "s", 5_000, "x"),
        (9, "same text here", "en", "s", 14, "x"),
        (9, "same text here", "en", "s", 14, "x"),
        (9, "another text of the same document", "en", "s", 33, "x"),
        (None, "a text without an id", "en", "s", 20, "x"),
        (12, "漢字 and é, ½ Ⅷ \x1c 😀 \x85 end", "en", "s", 20, "x"),
    ]
    # columns that operators use as names of their own
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
