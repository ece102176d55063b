"""Placement of keys on shards through a permutation-filled lookup table.

Method: each shard has an order of preference over all slots of a table of prime size, a permutation given by an
offset and a step that are hashed from the shard's name.  Shards take turns, each claiming its next slot that is
still free, until the table is full; a key's shard is the one at slot ``hash(key) mod size``.  Shards get equal
parts to within one slot, and when a shard joins or leaves few other slots change hands.  With ``weights`` a shard
takes so many turns a round.

The table's size is a parameter and does not depend on the rows, so the table is broadcast; placing a row is one
lookup, without a shuffle.  ``write`` places whole rows and writes them, a folder of Parquet files for each shard: one
shuffle by shard, whose large parts are split over several tasks and files, each of which can be split by row groups.

Defined cases: a null key is placed like the empty text; equal keys share a shard; rows are neither added nor lost;
other columns pass through.  No rows in, no rows out.  No shards, a repeated name, a size that is not prime or below
the number of shards, and a weight below 1 are errors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    # 60 bits: what Spark and SQL can read back from hexadecimal as a signed number
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], size: int = SIZE, weights: Mapping[str, int] | None = None) -> list[int]:
    """For each slot the index of the shard that claims it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need different names, and one at least")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the size must be a prime and not below the number of shards")
    turns = [int((weights or {}).get(s, 1)) for s in shards]
    if min(turns) < 1:
        raise ValueError("weights are 1 or more")
    at = [_number(f"offset:{s}") % size for s in shards]
    step = [_number(f"step:{s}") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    free = size
    while free:
        for shard, n in enumerate(turns):
            for _ in range(min(n, free)):
                while table[at[shard]] >= 0:
                    at[shard] = (at[shard] + step[shard]) % size
                table[at[shard]] = shard
                free -= 1
    return table


def slot_of(key: Column, size: int = SIZE) -> Column:
    """The slot of a key: 60 bits of MD5 of its text, modulo the size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % size


def place(
    rows: DataFrame, key: str, shards: Sequence[str], *, size: int = SIZE, weights: Mapping[str, int] | None = None,
    slot_col: str = "slot", shard_col: str = "shard",
) -> DataFrame:
    """The rows with the slot and the shard of their key behind their own columns."""
    taken = {c.lower() for c in rows.columns} & {slot_col.lower(), shard_col.lower()}
    if taken:
        raise ValueError(f"the rows already have columns {sorted(taken)}; give other names")
    spark = rows.sparkSession
    table = lookup_table(shards, size, weights)
    slots = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], "slot long, shard string")
    # the rows' own columns stay in a struct, so that no name of theirs can meet one of the join's
    marked = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), slot_of(F.col(f"`{key}`"), size).alias("slot"))
    # size rows, whatever the number of documents
    placed = marked.join(F.broadcast(slots), "slot")
    return placed.select("_row.*", F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))


def write(
    rows: DataFrame, key: str, shards: Sequence[str], path: str, *, size: int = SIZE, weights: Mapping[str, int] | None = None,
    slot_col: str = "slot", shard_col: str = "shard",
) -> DataFrame:
    """The placed rows as read back from ``path``, where they are written whole, a folder ``shard=...`` for each shard."""
    if "" in shards:
        raise ValueError("a shard that has a folder needs a name")
    placed = place(rows, key, shards, size=size, weights=weights, slot_col=slot_col, shard_col=shard_col)
    placed.hint("rebalance", F.col(shard_col)).write.partitionBy(shard_col).parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)
