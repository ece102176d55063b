"""Snapshots kept as intervals."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.operators import partitions
from daybook.session import new_database, quoted
from daybook.sinks import history

SCHEMA = "id int, name string, x double, m map<string,int>, l array<int>"


def day(n):
    return f"2024-01-{n:02d}"


def rows_of(rows):
    return Counter(repr(tuple(r)) for r in rows)


def new_table(spark):
    return f"{new_database(spark, 'test')}.states"


def test_any_day_is_what_was_filed(spark):
    draw = random.Random(4)
    table, filed = new_table(spark), {}
    rows = [(i % 7, draw.choice(["a", "b\n", "", None]), draw.choice([0.5, None]), {"k": i % 2}, [i % 3, None]) for i in range(30)]
    for n in range(1, 9):
        if n == 5:
            rows = []
        elif n == 6:
            rows = [(None, None, None, None, None)] * 3
        elif n != 4:  # the fourth day is as the third
            rows = [r for r in rows if draw.random() > 0.2] + [draw.choice(rows or [(n, "n", 1.0, {}, [])]) for _ in range(4)]
            rows.append((n, "new", float(n), {"n": n}, []))
        history.file_snapshot(spark.createDataFrame(rows, SCHEMA).repartition(3), table, day(n))
        filed[n] = rows_of(spark.createDataFrame(rows, SCHEMA).collect())
        if n in (3, 5, 7):  # again
            history.file_snapshot(spark.createDataFrame(rows, SCHEMA), table, day(n))
        for known, expected in filed.items():
            assert rows_of(history.as_of(spark, table, day(known)).collect()) == expected, (n, known)
    assert history.as_of(spark, table, "2023-12-31").count() == 0
    assert rows_of(history.as_of(spark, table, "2030-01-01").collect()) == filed[8]


def test_last_day_with_other_rows_and_earlier_days(spark):
    table = new_table(spark)
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    history.file_snapshot(frame(1, 2, 2), table, day(1))
    history.file_snapshot(frame(2, 3), table, day(2))
    history.file_snapshot(frame(1, 2, 2, 4), table, day(2))
    held = sorted(tuple(r) for r in spark.table(quoted(table)).collect())
    assert held == [(1, 1, day(1), history.OPEN), (2, 2, day(1), history.OPEN), (4, 1, day(2), history.OPEN)]
    assert {r["partition"] for r in partitions.list_partitions(spark, table).collect()} == {f"valid_to={history.OPEN}"}
    with pytest.raises(ValueError):
        history.file_snapshot(frame(1), table, day(1))
    history.file_snapshot(frame(), table, day(3))
    with pytest.raises(ValueError):
        history.file_snapshot(frame(1), table, day(2))
    assert history.as_of(spark, table, day(3)).count() == 0 and history.as_of(spark, table, day(2)).count() == 4


def test_what_is_stored_follows_the_changes(spark):
    table = new_table(spark)
    for n in range(1, 7):
        history.file_snapshot(spark.range(1000).withColumn("v", F.when(F.col("id") == 0, n).otherwise(0)), table, day(n))
    assert spark.table(quoted(table)).count() == 1000 + 5
    assert history.as_of(spark, table, day(2)).where("v = 2").count() == 1


def test_many_copies_of_one_row(spark):
    table = new_table(spark)
    history.file_snapshot(spark.range(150_000).select(F.lit("same").alias("v")), table, day(1))
    assert spark.table(quoted(table)).count() == 1
    assert history.as_of(spark, table, day(1)).count() == 150_000


def test_columns(spark):
    table = new_table(spark)
    history.file_snapshot(spark.createDataFrame([(1, "a", -0.0)], "id int, t string, x double"), table, day(1))
    history.file_snapshot(spark.createDataFrame([("a", 0.0, 1)], "T string, x float, ID bigint"), table, day(2))
    assert spark.table(quoted(table)).collect()[0]["valid_from"] == day(1)
    history.file_snapshot(spark.createDataFrame([(1, None)], "id int, x double"), table, day(3))
    assert [tuple(r) for r in history.as_of(spark, table, day(3)).collect()] == [(1, "", None)]
    with pytest.raises(ValueError):
        history.file_snapshot(spark.createDataFrame([(1, 2)], "id int, more int"), table, day(4))
    for name in ("copies", "VALID_TO"):
        with pytest.raises(ValueError):
            history.file_snapshot(spark.createDataFrame([(1,)], f"`{name}` int"), new_table(spark), day(1))


def test_failure_leaves_the_history(spark):
    table = new_table(spark)
    history.file_snapshot(spark.createDataFrame([(1,)], "v int"), table, day(1))
    broken = spark.range(2).select(F.raise_error(F.lit("source down")).cast("int").alias("v"))
    with pytest.raises(Exception, match="source down"):
        history.file_snapshot(broken, table, day(2))
    assert [tuple(r) for r in spark.table(quoted(table)).collect()] == [(1, 1, day(1), history.OPEN)]


def test_plans(spark, capsys):
    table = new_table(spark)
    history.file_snapshot(spark.range(5), table, day(1))
    history.file_snapshot(spark.range(6), table, day(2))
    history.intervals(spark.table(quoted(table)), spark.range(6), day(3)).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "HashAggregate" in plan and "Sort" not in plan
    history.as_of(spark, table, day(1)).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "PartitionFilters" in plan and f"valid_to" in plan
