"""Key counts and last values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_keys(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Occurrences of each key; counted before the shuffle, so hot keys travel once per task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def word_count(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of each white-space separated word of a text column."""
    words = df.select(F.explode(F.split(F.col(column), r"\s+")).alias("word"))
    return count_keys(words.where(F.col("word") != ""), "word")


def last_value_by_key(df: DataFrame, key: str, value: str, *order_by: str) -> DataFrame:
    """The value of each key's last row in the given order (which should leave no ties)."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order_by)).alias(value))


def latest_rows(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One whole row per key: the last by ``order_by``, then by the other columns.

    An aggregate rather than a ranking window: every task keeps one row per key
    before the shuffle, so a hot key never gathers in one task.
    """

    def row(names: list[str]) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in names])

    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    ranking = [*order_by, *[c for c in df.columns if c not in order_by and c not in maps]]
    # Maps have no order: with one among the columns, the row is carried beside its ranking.
    last = F.max_by(row(df.columns), row(ranking)) if maps else F.max(row(ranking))
    latest = df.groupBy(*keys).agg(last.alias("_latest"))
    return latest.select([F.col(f"_latest.`{c}`").alias(c) for c in df.columns])
