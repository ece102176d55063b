from __future__ import annotations

import numpy as np
import pytest
import xxhash

from daybook.llm import components, simhash
from daybook.llm.staging import Stages


def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, bits):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b", "A b C", "a b c d e f g a b c", "Éa b\x0bc\x1cd e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("extra", [-1, 0, 1, 2, 3])
def test_fingerprint_of_chunks(monkeypatch, extra):
    monkeypatch.setattr(simhash, "_CHUNK", 8)
    text = " ".join(f"w{i % 7}" for i in range(16 + extra))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_has_the_same_hash(spark):
    from pyspark.sql import functions as F

    found = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert found % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_documents_like_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = linked(set(prints.values()), 2)
    smallest = {}
    for i, p in prints.items():
        smallest[roots[p]] = min(i, smallest.get(roots[p], i))
    for r in simhash.near_duplicates(docs).collect():
        assert r["fp"] % 2**64 == prints[r["doc_id"]]
        assert r["component_id"] == smallest[roots[prints[r["doc_id"]]]]


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_of_near_values(spark, bits):
    draw = np.random.default_rng(bits)
    centres = draw.integers(0, 2**63, 12)
    values = {0, *map(int, centres)}
    for c in map(int, centres):
        for _ in range(25):
            for flip in draw.integers(0, 64, int(draw.integers(1, 5))):
                c ^= 1 << int(flip)
            values.add(c)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    nodes = spark.createDataFrame(signed, "fp long")
    pairs = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(nodes, bits).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in pairs)
    assert groups(values, pairs) == partition(linked(values, bits))


def groups(values, pairs):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        parent[find(a)] = find(b)
    return partition({v: find(v) for v in values})


def partition(roots):
    out = {}
    for v, r in roots.items():
        out.setdefault(r, set()).add(v)
    return {frozenset(g) for g in out.values()}


def test_a_full_posting_is_linked_by_lookup():
    base = 0xABCD_EF01_2345_0000
    fps = np.sort(np.array([base | v for v in range(0, 2**16, 3)], np.uint64))
    flips = np.array(simhash._masks(2), np.uint64)
    found = simhash._forest(fps, (0, 1), flips, 2)
    assert len(found) < len(fps)
    few = fps[: 2 * len(flips)]
    pairs = simhash._forest(fps[: 2 * len(flips) + 1], (0, 1), flips, 2)
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    values = {int(v) for v in fps[: 2 * len(flips) + 1]}
    assert groups(values, pairs) == partition(linked(values, 2))
    assert groups({int(v) for v in few}, simhash._forest(few, (0, 1), flips, 2)) == partition(linked({int(v) for v in few}, 2))


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    blank = [r for r in rows if r["fp"] == 0]
    assert {r["doc_id"] for r in blank} == {4, 5, 6} and {r["component_id"] for r in blank} == {4}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_group_stays(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    found = kept.collect()
    # a shared id, or none, does not make one group of two texts
    assert len(found) == len({r["root"] for r in rows})
    assert sorted(r["text"] for r in found if r["doc_id"] == 9) == ["another text of the same document", "same text here"]
    assert [r["doc_id"] for r in found if not (r["text"] or "").strip()] == [4]
    nameless = spark.createDataFrame([(None, "one two three"), (None, "four five six"), (None, None)], "doc_id long, text string")
    assert simhash.keep_one(nameless).count() == 3
    assert simhash.keep_one(no_docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(600, 700)]
    pairs = spark.createDataFrame(chain + star + [(900, 900), (7, 8), (8, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(pairs, Stages(spark, "test")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in [500, *range(600, 700)]}, 7: 7, 8: 7}


def test_rows_equal_in_id_and_text_stay_by_order(spark, odd_docs):
    rows = [(1, "some words to stay", n, "x") for n in (5, 3, 9)] + [(2, "quite another text of words", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _first_id int, _first_mark string").repartition(3)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, "some words to stay", 3, "x"), (2, "quite another text of words", 1, "y")]
    clashing = odd_docs.selectExpr("*", "1 AS _doc", "2 AS id", "3 AS mark", "map('a', 1) AS root")
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns and kept.count() == simhash.keep_one(odd_docs).count()
