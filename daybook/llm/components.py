"""Connected components of a graph given as pairs of numbers, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.staging import Stages


def components(pairs: DataFrame, stages: Stages) -> DataFrame:
    """``node, root`` for every node of the pairs ``a, b``; the root is the smallest node that can be reached.

    Each round hangs every node's larger neighbours on its smallest neighbour, then every node and its smaller
    neighbours on the smallest of them; the number of rounds grows with the logarithm of the longest path.  The
    smallest neighbour is an aggregate with a partial step and the rest are equi-joins, so a node with very many
    neighbours is neither gathered nor listed in one task.  Every round is a written table.
    """
    edges = stages.write(
        pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours go to the smallest one
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stages.write(large)
        # each node with its smaller neighbours goes to the smallest of these
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = stages.write(small.distinct())
        # no star has changed once the edges are the same set
        after = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        stages.drop(edges)
        stages.drop(large)
        edges = small
        if tuple(after) == before:
            break
        before = tuple(after)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
