"""Exact top-k search by inner product, with a ball tree per shard.

Method: candidate vectors are dealt into shards; a task builds a ball tree over each (a node is a centre and a radius,
split at the median along the direction of two far points) and packs it into one row.  Queries, in blocks, meet every
shard.  A search keeps a query's nodes in the order of their inner-product upper bound, ``q . centre + |q| radius``,
and stops at the first whose bound is below the query's current kth score.  That score is shared: each query first
searches the shard where its bound is highest, and all other shards start from the kth score it has then.

Components become integers ``floor(scale * x)``, so scores are exact: sums of products are taken in floating point while
the largest possible sum is below 2**53, else in integers of any length; bounds are widened by their rounding error.

A shard holds at most about ``shard_rows`` vectors and a block ``block_rows`` queries: a task's memory follows these and
the number of dimensions.  Every pair of a block and a shard is a piece of work of its own: both halves are dealt by the
pair's number, so that all tasks have equally many pairs, and meet there in sorted order, one pair in memory at a time.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part, neither as queries nor as
candidates; vectors of different lengths are compared over no pair (each length is a search of its own); ties go to
the smaller id; repeated ids are rows of their own, but a query never meets a row with its own id; a query without
candidates has no rows; ids must not be null (such rows take no part).  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.staging import Stages

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF = 64
MOST_TASKS = 10_000  # pairs beyond this number share tasks
_PACK = 1024  # shards whose balls are looked at together, to find a query's first shard


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as arrays:
        return {k: arrays[k] for k in arrays.files}


def _whole(vectors: list, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as floats: whole numbers, exact."""
    return np.floor(np.array(vectors, np.float64) * scale)


def build_tree(vectors: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Nodes as rows of arrays: centre, radius, children (or -1), and their run of the reordered vectors."""
    order = np.arange(len(vectors))
    centres, radii, children, runs = [], [], [], []
    todo = [(0, len(vectors), -1, 0)]
    while todo:
        start, stop, parent, side = todo.pop()
        own = vectors[order[start:stop]]
        centre = own.mean(axis=0)
        distance = np.sqrt(((own - centre) ** 2).sum(axis=1))
        node = len(centres)
        centres.append(centre)
        radii.append(distance.max())
        children.append([-1, -1])
        runs.append((start, stop))
        if parent >= 0:
            children[parent][side] = node
        if stop - start > leaf and distance.max() > 0:
            far = own[distance.argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            rank = np.argsort(own @ (other - far), kind="stable")
            order[start:stop] = order[start:stop][rank]
            middle = (start + stop) // 2
            todo += [(start, middle, node, 0), (middle, stop, node, 1)]
    return {
        "order": order, "centres": np.array(centres), "radii": np.array(radii),
        "children": np.array(children), "runs": np.array(runs),
    }


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray | list[int]:
    if len(vectors) and np.abs(vectors).max() * np.abs(query).max() * vectors.shape[1] < 2**53:
        return (vectors @ query).astype(np.int64)
    whole = [int(x) for x in query]
    return [sum(int(a) * b for a, b in zip(v, whole)) for v in vectors]


def search(tree: dict[str, np.ndarray], query: np.ndarray, query_id: int, k: int, floor: float) -> list[tuple[int, int]]:
    """Up to k pairs ``(score, id)`` of a shard, best first, that can be among the k best given the kth score so far."""
    length = np.sqrt((query**2).sum())
    slack = 1e-9 * (1 + length) * (1 + tree["reach"])
    bounds = tree["centres"] @ query + length * tree["radii"] + slack
    best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        kth = best[0][0] if len(best) == k else -np.inf
        if -bound < max(kth, floor):
            break
        left, right = tree["children"][node]
        if left >= 0:
            for child in (left, right):
                if bounds[child] >= max(kth, floor):
                    heapq.heappush(heap, (-bounds[child], int(child)))
            continue
        start, stop = tree["runs"][node]
        scores = _products(tree["vectors"][start:stop], query)
        for score, i in zip(scores, tree["ids"][start:stop]):
            if int(i) == query_id:
                continue
            if len(best) < k:
                heapq.heappush(best, (int(score), -int(i)))
            elif (int(score), -int(i)) > best[0]:
                heapq.heapreplace(best, (int(score), -int(i)))
    return [(s, -i) for s, i in sorted(best, reverse=True)]


def _valid(vector: Column) -> Column:
    # as double: NaN and infinities have no order with a finite bound on both sides
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def top_k(
    rows: DataFrame, is_query: Column, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: float = 256.0, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates for every row that ``is_query`` selects."""
    stages = Stages(rows.sparkSession, "topk")
    vectors = stages.write(
        rows.where(_valid(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
            F.size(vector_col).alias("dims"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
    )
    n = vectors.count()
    asked = vectors.where("asks").count()
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-asked // block_rows))

    def plant(key, group: pd.DataFrame) -> pd.DataFrame:
        found = _whole(group["v"].tolist(), scale).reshape(len(group), key[1])
        tree = build_tree(found)
        order = tree.pop("order")
        reach = np.sqrt((found**2).sum(axis=1)).max()
        data = _pack(**tree, vectors=found[order], ids=group["id"].to_numpy()[order], reach=reach)
        ball = _pack(centre=tree["centres"][0], radius=tree["radii"][0])
        return pd.DataFrame({"part": [key[0]], "dims": [key[1]], "payload": [data], "ball": [ball]})

    def pack(key, group: pd.DataFrame) -> pd.DataFrame:
        balls = [_unpack(b) for b in group["ball"]]
        data = _pack(
            shards=group["part"].to_numpy(), centres=np.stack([b["centre"] for b in balls]), radii=np.stack([b["radius"] for b in balls])
        )
        return pd.DataFrame({"part": [key[0]], "dims": [key[1]], "payload": [data]})

    def gather(key, group: pd.DataFrame) -> pd.DataFrame:
        found = _whole(group["v"].tolist(), scale).reshape(len(group), key[1])
        return pd.DataFrame({"block": [key[0]], "dims": [key[1]], "payload": [_pack(ids=group["id"].to_numpy(), vectors=found)]})

    part = F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int")
    trees = stages.write(
        vectors.withColumn("part", part).groupBy("part", "dims").applyInPandas(plant, "part int, dims int, payload binary, ball binary")
    )
    packs = stages.write(
        trees.select(F.floor(F.col("part") / _PACK).cast("int").alias("pack"), "part", "dims", "ball")
        .groupBy("pack", "dims").applyInPandas(pack, "part int, dims int, payload binary")
    )
    block = F.pmod(F.xxhash64(F.lit(1), "id", "v"), F.lit(blocks)).cast("int")
    blocked = vectors.where("asks").withColumn("block", block)
    queries = stages.write(blocked.groupBy("block", "dims").applyInPandas(gather, "block int, dims int, payload binary"))

    def all_pairs(parts: DataFrame, lists: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        return parts.select("part", "dims", every).join(lists, ["block", "dims"])

    nothing = F.expr("array()").cast(_WANTED).alias("wanted")
    bounds = _meet(
        all_pairs(packs, queries.select("block", "dims", nothing)), packs, queries, -(-shards // _PACK), blocks, _bounds,
        "query_id long, dims int, shard int, bound double",
    )
    # the shard where a query's bound is highest
    homes = stages.write(bounds.groupBy("query_id", "dims").agg(F.max_by("shard", F.struct("bound", "shard")).alias("home")))
    ids = blocked.select(F.col("id").alias("query_id"), "dims", "block").distinct()

    def searched(pairs: DataFrame, at_home: bool) -> DataFrame:
        def handle(shard: int, dims: int, tree: dict, asked: dict, wanted: list) -> pd.DataFrame:
            floors = {w["query_id"]: w["floor"] for w in wanted if (w["home"] == shard) == at_home}
            return _searched(tree, asked, k, floors)

        return _meet(pairs, trees, queries, shards, blocks, handle, "query_id long, vec_id long, score long")

    # at most block_rows queries in a list
    lowest = F.lit(float("-inf")).alias("floor")
    first = homes.join(ids, ["query_id", "dims"]).groupBy("block", "dims", F.col("home").alias("part")).agg(
        F.collect_list(F.struct("query_id", "home", lowest)).alias("wanted")
    )
    early = stages.write(searched(first, True))
    kth = early.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floor = F.when(F.col("n") >= k, F.col("floor").cast("double")).otherwise(F.lit(float("-inf"))).alias("floor")
    known = homes.join(ids, ["query_id", "dims"]).join(kth, "query_id", "left").groupBy("block", "dims").agg(
        F.collect_list(F.struct("query_id", "home", floor)).alias("wanted")
    )
    late = searched(all_pairs(trees, known), False)
    ranked = early.unionByName(late).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_WANTED = "array<struct<query_id:bigint,home:int,floor:double>>"


def _meet(pairs: DataFrame, parts: DataFrame, queries: DataFrame, n_parts: int, blocks: int, handle, schema: str) -> DataFrame:
    """``handle(part, dims, part's arrays, block's arrays, wanted)`` for every pair of ``pairs``."""
    n = max(1, min(n_parts * blocks, MOST_TASKS))
    number = (F.col("block").cast("long") * n_parts + F.col("part")).alias("pair")
    asked = pairs.join(queries, ["block", "dims"]).select(number, "part", "dims", F.lit(0).alias("kind"), "payload", "wanted")
    held = pairs.select("part", "dims", "block").join(parts, ["part", "dims"]).select(
        number, "part", "dims", F.lit(1).alias("kind"), "payload", F.lit(None).cast(_WANTED).alias("wanted")
    )
    dealt = asked.unionByName(held).repartitionById(n, F.pmod("pair", F.lit(n)).cast("int")).sortWithinPartitions("pair", "dims", "kind")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, wanted = None, None
        for frame in batches:
            for part, dims, kind, payload, listed in zip(*[frame[c] for c in ("part", "dims", "kind", "payload", "wanted")]):
                if kind == 0:
                    block, wanted = _unpack(payload), listed
                else:
                    yield handle(part, dims, _unpack(payload), block, wanted)

    return dealt.mapInPandas(each, schema)


def _bounds(_, dims: int, balls: dict, asked: dict, wanted) -> pd.DataFrame:
    """The highest bound of each query of a block among the shards of a pack."""
    vectors = asked["vectors"]
    bound = vectors @ balls["centres"].T + np.sqrt((vectors**2).sum(axis=1))[:, None] * balls["radii"]
    best = bound.argmax(axis=1)
    return pd.DataFrame(
        {"query_id": asked["ids"], "dims": dims, "shard": balls["shards"][best], "bound": bound[np.arange(len(best)), best]}
    )


def _searched(tree: dict, asked: dict, k: int, floors: dict[int, float]) -> pd.DataFrame:
    found = [
        (int(q), i, score)
        for q, vector in zip(asked["ids"], asked["vectors"])
        if int(q) in floors
        for score, i in search(tree, vector, int(q), k, floors[int(q)])
    ]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})
