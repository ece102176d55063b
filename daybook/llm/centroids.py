"""Centroid clustering of integer vectors (Lloyd's rounds) in expressions of the JVM.

Method: the centroids are a literal array of arrays.  For each of them ``zip_with`` and ``aggregate`` compute a vector's
squared distance in integers, and ``array_min`` over the structs (distance, number) chooses the nearest, ties going to
the smaller number.  New centroids come from one aggregation a round: a count and a sum for every component, grouped by
cluster, with a partial step before the shuffle.  No join, no window, no Python in the tasks.

Components become integers ``floor(scale * x)``, so distances, sums and floors are exact and a run does not depend on
how rows are dealt.  What reaches the driver is one row of sums for each cluster, ``k`` x ``dims`` numbers; what goes to
the tasks is a literal of the same size.

The vectors are written once as integers; every round reads them and shuffles at most k rows a task.  A cluster with
any share of the rows is summed up where its rows are.

Defined cases: vectors that are null, have another number of components than ``dims``, or hold a null, NaN or infinite
component take no part.  Rows of equal id are vectors of their own; among the first centroids ties of the hash go to the
vector that sorts first.  A null id is hashed as empty text.  Fewer vectors than ``k`` give as many centroids.  No vectors, no
centroids and no rows.  A component of 2**19 or more in size is an error, since a long may not hold its distances.
Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.staging import Stages

LARGEST = float(1 << 19)


@dataclass
class Clusters:
    rows: DataFrame  # id, cluster, distance
    centroids: list[list[int]]
    inertia: list[int]  # distance summed over each cluster

    def of_cluster(self, values: list, kind: str) -> Column:
        """The value that belongs to a row's cluster."""
        listed = F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
        return F.element_at(listed, F.col("cluster") + 1)


def whole_vectors(rows: DataFrame, *, id_col: str, vector_col: str, dims: int, scale: float) -> DataFrame:
    """``id, v`` of the vectors that take part, as integers."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    kept = rows.where(F.coalesce(F.size(vector) == dims, F.lit(False)) & finite)

    def whole(x: Column) -> Column:
        large = F.raise_error(F.lit(f"a component of {LARGEST:.0f} or more")).cast("long")
        return F.when(F.abs(x) < LARGEST, F.floor(x.cast("double") * F.lit(scale))).otherwise(large)

    return kept.select(F.col(id_col).alias("id"), F.transform(vector, whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose ids, as ``seed:id``, have the smallest SHA-256."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in vectors.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()]


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """A struct of the squared distance to the nearest centroid and its number."""
    listed = ", ".join(f"array({', '.join(f'{x}L' for x in c)})" for c in centroids)

    def distance(centroid: Column) -> Column:
        gaps = F.zip_with(vector, centroid, lambda a, b: a - b)
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap * gap)

    return F.array_min(
        F.transform(F.expr(f"array({listed})"), lambda c, n: F.struct(distance(c).alias("distance"), n.alias("cluster")))
    )


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: every non-empty one is the floor of its vectors' mean."""
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    dealt = vectors.select("v", nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
    after = list(centroids)
    for row in dealt.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(len(sums))]
    return after


def cluster(
    rows: DataFrame, *, k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> Clusters:
    """Every vector's cluster and distance after ``rounds`` rounds, and the final centroids."""
    stages = Stages(rows.sparkSession, "centroids")
    vectors = stages.write(whole_vectors(rows, id_col=id_col, vector_col=vector_col, dims=dims, scale=scale))
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        return Clusters(vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], [])
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    last = stages.write(vectors.select("id", nearest(F.col("v"), centroids).alias("found")))
    stages.drop(vectors)
    dealt = last.select("id", "found.cluster", "found.distance")
    inertia = [0] * len(centroids)
    for row in dealt.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect():
        inertia[row["cluster"]] = row["inertia"]
    return Clusters(dealt, centroids, inertia)
