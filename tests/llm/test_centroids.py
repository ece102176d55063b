from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import centroids


def brute(rows, k, rounds, dims, scale=256.0, seed=2):
    """Id, cluster and distance of every vector, and the centroids, in plain integers."""
    kept = [
        (i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    mark = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    found = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(found))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        found = [tuple(sum(x) // len(own[n]) for x in zip(*own[n])) if n in own else c for n, c in enumerate(found)]
    return sorted((str(i), near(v)[1], near(v)[0]) for i, v in kept), [list(c) for c in found]


def dealt(rows, **settings):
    out = centroids.cluster(rows, **settings)
    return sorted((str(r["id"]), r["cluster"], r["distance"]) for r in out.rows.collect()), out


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, cluster string, v int")


@pytest.mark.parametrize("kind", ["double", "float"])
def test_same_as_plain_rounds(spark, kind):
    draw = np.random.default_rng(1)
    vectors = np.concatenate([draw.normal(c, 0.3, (60, 3)) for c in (-1, 0, 2)]).astype(np.float32)
    rows = [(i, [float(x) for x in v], "x", 1) for i, v in enumerate(vectors)]
    found, out = dealt(frame(spark, rows, kind), k=7, rounds=4, dims=3)
    expected, plain = brute([r[:2] for r in rows], 7, 4, 3)
    assert found == expected and out.centroids == plain
    assert sum(out.inertia) == sum(d for *_, d in expected)
    for n, total in enumerate(out.inertia):
        assert total == sum(d for _, c, d in expected if c == n)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [0.0, 1.0], None, None), (1, [0.0, 1.0], "x", 1), (2, [0.0, 1.0], "x", 1), (2, [-0.001, 0.5], "x", 1), (None, [3.0, -3.0], "x", 1),
        (3, None, "x", 1), (4, [], "x", 1), (5, [1.0], "x", 1), (6, [1.0, 2.0, 3.0], "x", 1), (7, [1.0, None], "x", 1),
        (8, [nan, 1.0], "x", 1), (9, [1.0, inf], "x", 1), (10, [-inf, 1.0], "x", 1), (11, [3.0, -3.0], "x", 1), (12, [1e-300, 0.1], "x", 1),
    ]
    for k in (1, 3, 40):  # more centroids than vectors; equal centroids, of which all but the first stay empty
        found, out = dealt(frame(spark, rows), k=k, rounds=3, dims=2)
        expected, plain = brute([r[:2] for r in rows], k, 3, 2)
        assert found == expected and out.centroids == plain
    found, out = dealt(frame(spark, rows).limit(0), dims=2)
    assert found == [] and out.centroids == [] and out.rows.columns == ["id", "cluster", "distance"]
    assert dealt(frame(spark, rows).where("vec_id = 3"), dims=2)[0] == []


def test_a_vector_that_most_rows_hold(spark):
    rows = [(i, [0.25, 0.5] if i % 3 else [i / 100, 1.0], "x", 1) for i in range(400)]
    found, out = dealt(frame(spark, rows).repartition(5), k=5, rounds=5, dims=2)
    assert (found, out.centroids) == brute([r[:2] for r in rows], 5, 5, 2)


def test_large_components(spark):
    rows = [(i, [(-1) ** i * (2.0**19 - 1 - i), float(i)], "x", 1) for i in range(6)]
    assert dealt(frame(spark, rows), k=2, rounds=2, dims=2)[0] == brute([r[:2] for r in rows], 2, 2, 2)[0]
    with pytest.raises(Exception, match="component of"):
        dealt(frame(spark, [(1, [2.0**19, 0.0], "x", 1)]), k=1, rounds=1, dims=2)


def test_no_join_window_or_python(spark, capsys):
    vectors = spark.createDataFrame([(1, [1, 2])], "id long, v array<bigint>")
    near = vectors.select(centroids.nearest(F.col("v"), [[1, 2], [3, 4]])["cluster"].alias("cluster"), "v")
    near.groupBy("cluster").agg(F.sum(F.col("v")[0]).alias("s")).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert not any(word in plan for word in ("Join", "Window", "Python", "Arrow"))
