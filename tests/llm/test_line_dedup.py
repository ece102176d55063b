from __future__ import annotations

import re
from collections import defaultdict

from daybook.llm import line_dedup


def brute(rows, min_chars=20, min_docs=3):
    """Kept text per row, by the definition."""

    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\f\r"))

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(key(line), set())
            keeper = max((x for x in ids if x is not None), default=None)
            if len(ids) < min_docs or i == keeper:
                kept.append(line)
        out.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def found(docs, **settings):
    rows = line_dedup.dedup_lines(docs, **settings).collect()
    return sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_dropped"]) for r in rows)


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs) == brute(rows)
    assert any(r[3] for r in found(odd_docs))


def test_other_columns_pass(odd_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "n_lines", "n_dropped"]
    assert {r["score"] for r in out.collect()} == {"x", None}


def test_nothing(no_docs):
    assert found(no_docs) == []


def test_a_line_in_most_documents_over_many_slices(spark):
    hot = "this line stands in nearly every document"
    rows = [(i * 700, f"{hot}\n{'own ' * 10}{i}\n{hot}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)


def test_upper_case_beyond_ascii_is_another_line(spark):
    rows = [(i, t) for i, t in enumerate(["ÉTÉ a long enough line"] * 2 + ["été a long enough line"] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)
    assert not any(r[3] for r in found(docs))


def test_bitmaps_hold_positions_beyond_a_word(spark):
    shared = [f"shared line number {n:04d} of many" for n in range(150)]
    rows = [(i, "\n".join(shared if i < 3 else shared[:70])) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)
    words = {w for r in line_dedup.keep_bitmaps(docs).collect() for w in r["dropped"]}
    assert words == {0, 1, 2}


def test_columns_with_names_of_the_counts(odd_docs):
    docs = odd_docs.selectExpr("*", "'mine' AS n_lines", "7 AS N_Dropped", "1 AS dropped", "2 AS _doc")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*odd_docs.columns, "dropped", "_doc", "n_lines", "n_dropped"]
    assert {r["n_lines"] for r in out.collect()} == {r["n_lines"] for r in line_dedup.dedup_lines(odd_docs).collect()}
    kept = line_dedup.dedup_lines(docs, counts=False)
    assert kept.columns == docs.columns
    assert {(r["n_lines"], r["N_Dropped"]) for r in kept.collect()} == {("mine", 7)}


def test_null_ids_beside_negative_ones(spark):
    hot = "a line of more than twenty characters"
    rows = [(i, hot) for i in (None, None, -1, -1000, -1025, -3, 5)] + [(None, "another line of twenty and more")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)
