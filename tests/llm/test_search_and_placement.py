from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import order_minhash, queries, sharding, topk


def brute_top(rows, k=5, every=50):
    whole = {}
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [int(np.floor(256 * x)) for x in v]
    out = {}
    for q, a in whole.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q and len(a) == len(b))
            for rank, (score, i) in enumerate(scores[:k], 1):
                out[q, rank] = (i, -score)
    return out


def top(df, **sizes):
    rows = topk.top_k(df, F.col("vec_id") % 50 == 0, **sizes).collect()
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "block_rows": 2}])
def test_top_k_with_ties_and_bad_vectors(spark, sizes):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(0, 0.2, 8).tolist()) for i in range(300)]
    rows += [(300 + i, [0.25] * 8) for i in range(80)]  # copies
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (450, [1e12] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    assert top(df, **sizes) == brute_top(rows)


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (7, [1.0, 0.0]), (50, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert top(df) == brute_top(rows)
    assert top(df.limit(0)) == {}
    assert top(df.where("vec_id = 0")) == {}


def test_tree_bounds_hold_all_vectors():
    vectors = np.floor(np.random.default_rng(1).normal(0, 30, (500, 6)))
    tree = topk.build_tree(vectors)
    for (start, stop), centre, radius in zip(tree["runs"], tree["centres"], tree["radii"]):
        own = vectors[tree["order"][start:stop]]
        assert np.sqrt(((own - centre) ** 2).sum(axis=1)).max() <= radius + 1e-9


SHARDS = [f"s{i}" for i in range(10)]


def plain_table(shards, size):
    """Turn by turn, by whole permutations."""
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    orders = []
    for s in shards:
        offset, step = number(f"offset:{s}") % size, number(f"step:{s}") % (size - 1) + 1
        order = [(offset + j * step) % size for j in range(size)]
        assert len(set(order)) == size
        orders.append(iter(order))
    table = {}
    while len(table) < size:
        for n, order in enumerate(orders):
            if len(table) < size:
                table[next(s for s in order if s not in table)] = n
    return [table[i] for i in range(size)]


def test_lookup_table():
    table = sharding.lookup_table(SHARDS, 1009)
    assert table == plain_table(SHARDS, 1009)
    parts = Counter(table).values()
    assert max(parts) - min(parts) <= 1
    without = sharding.lookup_table(SHARDS[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, without) if a != 9)
    assert moved < 0.1 * 1009
    double = Counter(sharding.lookup_table(["a", "b"], 101, {"a": 2}))
    assert double[0] > 1.9 * double[1]
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 101)
    for size in (100, 7):
        with pytest.raises(ValueError):
            sharding.lookup_table(SHARDS, size)


def test_placement(spark, odd_docs, no_docs):
    table = sharding.lookup_table(SHARDS, 1009)
    rows = sharding.place(odd_docs, "doc_id", SHARDS, size=1009).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 1009
        assert (r["slot"], r["shard"]) == (slot, SHARDS[table[slot]])
    assert sharding.place(no_docs, "doc_id", SHARDS).count() == 0
    with pytest.raises(ValueError):
        sharding.place(odd_docs.withColumn("Slot", F.lit(1)), "doc_id", SHARDS)


def test_whole_rows_are_written_by_shard(spark, odd_docs, no_docs, tmp_path):
    back = sharding.write(odd_docs, "doc_id", SHARDS, f"{tmp_path}/odd", size=1009)
    assert back.columns == [*odd_docs.columns, "slot", "shard"]
    as_text = lambda rows: sorted(map(str, map(tuple, rows)))
    assert as_text(back.collect()) == as_text(sharding.place(odd_docs, "doc_id", SHARDS, size=1009).collect())
    for shard in {r["shard"] for r in back.collect()}:
        own = spark.read.parquet(f"{tmp_path}/odd/shard={shard}")
        assert as_text(own.collect()) == as_text(back.where(F.col("shard") == shard).drop("shard").collect())
    assert sharding.write(no_docs, "doc_id", SHARDS, f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError):
        sharding.write(odd_docs, "doc_id", ["a", ""], f"{tmp_path}/bad")


def test_sharding_query_writes_documents(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "new_path", lambda *a: f"{tmp_path}/shards")
    out = queries.op10_sharding(spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert out.columns == ["doc_id", "slot", "shard"]
    assert sorted(out.collect()) == sorted(sharding.place(docs.select("doc_id"), "doc_id", queries.SHARDS).collect())
    written = spark.read.parquet(f"{tmp_path}/shards").select(*docs.columns)
    assert sorted(map(str, written.collect())) == sorted(map(str, docs.collect()))


def plain_signature(text):
    """By the definition, with the operator's element and tuple hashes."""
    items = order_minhash.elements(text)
    out = np.zeros(order_minhash.TUPLES, np.uint64)
    for t, factor in enumerate(order_minhash._FUNCTIONS):
        value = items * factor
        chosen = sorted(sorted(range(len(items)), key=lambda i: (int(value[i]), i))[: order_minhash.CHOSEN])
        mark = np.zeros(1, np.uint64)
        for j, i in enumerate(chosen):
            mark = order_minhash._mix(mark * order_minhash._A + items[i] + np.uint64(j + 1))
        out[t] = mark[0]
    return np.maximum((out >> np.uint64(32)).astype(np.uint32), 1)


def test_signatures():
    for text in ("a", "abcdef", "abcabcabcabc", "the quick brown fox " * 20, "z" * 300):
        assert (order_minhash.signature(text) == plain_signature(text)).all()
    assert (order_minhash.signature(None) == 0).all()
    # the same k-mer comes with a number, so the elements differ
    assert len(set(order_minhash.elements("z" * 300).tolist())) == 295


def test_order_counts():
    a, b = "".join(chr(97 + i % 26) + str(i) for i in range(300)), "".join(chr(65 + i % 26) + str(i) for i in range(300))
    plain, moved = order_minhash.signature(a + b), order_minhash.signature(b + a)
    assert 0 < order_minhash.likeness(plain, moved) < 0.9


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_neighbours(spark, odd_docs, no_docs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [(i * 3, f"text number {i} " * (i % 7)) for i in range(60)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = {r["doc_id"]: r for r in order_minhash.edited_neighbours(docs).collect()}
        for n, (i, text) in enumerate(rows):
            following = rows[(n + 1) % len(rows)][1]
            cut = len(text) // 4
            edited = text[: len(text) - cut] + following[:cut]
            r = found[i]
            assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            own, its = order_minhash.signature(text), order_minhash.signature(following)
            assert r["fingerprint"] == order_minhash.as_text(own)
            assert r["edited_fingerprint"] == order_minhash.as_text(order_minhash.signature(edited))
            assert r["near_next"] == order_minhash.likeness(own, its)
        odd = order_minhash.edited_neighbours(odd_docs).collect()
        assert sorted(str(r["doc_id"]) for r in odd) == sorted(str(r["doc_id"]) for r in odd_docs.collect())
        assert order_minhash.edited_neighbours(no_docs).count() == 0
        alone = order_minhash.edited_neighbours(docs.where("doc_id = 3")).first()
        assert alone["near_next"] == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_placement_beside_columns_of_any_name(spark):
    rows = spark.createDataFrame([(1, "a", "b", 2)], "doc_id long, _slot string, _shard string, _row int")
    placed = sharding.place(rows, "doc_id", ["one", "two"])
    assert placed.columns == [*rows.columns, "slot", "shard"]
    assert tuple(placed.first())[:4] == (1, "a", "b", 2)
