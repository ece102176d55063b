"""Splits by quantiles: every row in exactly one, none much larger than the others."""

from __future__ import annotations

import datetime
import sqlite3
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.sources import relational
from daybook.sources.splits import literal, quantile_splits


def sizes(df, conditions):
    inside = [F.coalesce(F.expr(c).cast("int"), F.lit(0)) for c in conditions]
    total = sum(inside[1:], inside[0])
    assert {r[0] for r in df.select(total).distinct().collect()} <= {1}
    return list(df.agg(*[F.sum(i) for i in inside]).first())


def skewed(spark, n=6000):
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 10 == 1, F.lit(None)).when(F.col("id") % 10 == 2, F.lit(900))
        .otherwise(F.col("id") * F.col("id") % 1009)
    )
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("splits", [2, 7, 16, 40])
def test_even_on_a_skewed_column(spark, splits):
    df = skewed(spark)
    found = sizes(df, quantile_splits(df, "k", splits, "id"))
    assert sum(found) == 6000
    assert max(found) <= 1.5 * 6000 / splits
    assert len(found) <= 2 * splits


def test_a_value_without_a_second_column_is_one_split(spark):
    df = skewed(spark)
    conditions = quantile_splits(df, "k", 16)
    found = sizes(df, conditions)
    assert sum(found) == 6000 and max(found) >= 2000
    assert sorted(found)[-2] <= 1.7 * 6000 / 16


def test_odd_columns(spark):
    one = spark.range(1000).select("id", F.lit(3).alias("k"))
    assert max(sizes(one, quantile_splits(one, "k", 8, "id"))) <= 1.5 * 125
    none = spark.range(1000).select("id", F.lit(None).cast("int").alias("k"))
    assert max(sizes(none, quantile_splits(none, "k", 8, "id"))) <= 1.5 * 125
    ties = spark.range(1000).select(F.lit(None).cast("int").alias("id"), F.lit(1).alias("k"))
    assert sum(sizes(ties, quantile_splits(ties, "k", 8, "id"))) == 1000
    assert quantile_splits(none.limit(0), "k", 8, "id") == ["1 = 1"]
    assert quantile_splits(one, "k", 1) == ["1 = 1"]
    few = spark.range(3).select("id", F.col("id").alias("k"))
    assert sum(sizes(few, quantile_splits(few, "k", 8, "id"))) == 3
    # rows that come later, also with NULL, are in a split
    later = spark.createDataFrame([(1, None), (2, -5), (3, 10**6)], "id long, k long")
    sizes(later, quantile_splits(few, "k", 2, "id"))


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "date", "timestamp"])
def test_kinds(spark, kind):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 97).cast("int"))
    value = {"date": day, "timestamp": F.timestamp_seconds(1700000000 + F.col("id") * 61 % 5000)}.get(kind, (F.col("id") * 7 % 311 / 8).cast(kind))
    df = spark.range(2000).select("id", value.alias("a name"))
    found = sizes(df, quantile_splits(df, "a name", 9, "id"))
    assert sum(found) == 2000 and max(found) <= 1.5 * 2000 / 9


def test_literals():
    assert literal(datetime.date(2024, 1, 2)) == "DATE '2024-01-02'"
    assert literal(Decimal("1.50")) == "1.50" and literal(-3) == "-3" and literal(0.1) == "0.1" and literal(True) == "TRUE"
    with pytest.raises(TypeError):
        literal("text")


def test_another_engine_reads_the_conditions_alike(spark):
    df = skewed(spark, 1500)
    conditions = quantile_splits(df, "k", 6, "id", '"')
    base = sqlite3.connect(":memory:")
    base.execute('CREATE TABLE t (id INTEGER, k INTEGER)')
    base.executemany("INSERT INTO t VALUES (?, ?)", [tuple(r) for r in df.collect()])
    read = [r for c in conditions for r in base.execute(f"SELECT id, k FROM t WHERE {c}")]
    assert sorted(read, key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)


def test_scan_reads_by_even_splits(spark, monkeypatch):
    asked = []

    class Reader:
        def __getattr__(self, name):
            return lambda *a, **b: asked.append((name, a, b)) or (skewed(spark) if name in ("load", "jdbc") else self)

    class Session:
        read = Reader()

    store = relational.mysql("db", "shop", "me", "secret")
    relational.scan(Session(), store, "orders", split_on="k", splits=8, bounds=(0, 1009), even=True, tie_column="id")
    predicates = next(b["predicates"] for name, _, b in asked if name == "jdbc")
    assert sum(sizes(skewed(spark), predicates)) == 6000 and len(predicates) >= 8
