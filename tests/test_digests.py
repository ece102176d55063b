"""Days told apart by content."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import digests, partitions
from daybook.plans import export
from daybook.session import new_database, quoted
from daybook.sinks import warehouse

SCHEMA = "a string, b string, x double, m map<string,int>, l array<int>, dt string"


def rows(n=40):
    draw = random.Random(2)
    out = []
    for i in range(n):
        day = None if i % 9 == 0 else f"2024-01-0{i % 3 + 1}"
        out.append((draw.choice("pq"), draw.choice(["q", None]), float(i % 4), {"k": i % 3, "j": 1}, [i % 2, None], day))
    return out


def found(df, **settings):
    return {r["dt"]: tuple(r)[1:] for r in digests.day_digests(df, **settings).collect()}


def test_order_files_and_column_order_do_not_count(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    one = found(df)
    assert set(one) == {"2024-01-01", "2024-01-02", "2024-01-03", partitions.NO_DAY}
    mixed = rows()
    random.Random(5).shuffle(mixed)
    other = spark.createDataFrame(mixed, SCHEMA).repartition(7).select("dt", "x", F.col("m").alias("M"), "l", "b", "a")
    assert found(other) == one
    flipped = df.withColumn("m", F.map_from_entries(F.reverse(F.map_entries("m")))).withColumn("x", F.when(F.col("x") == 0, F.lit(-0.0)).otherwise(F.col("x")))
    assert found(flipped) == one


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.union(df.limit(1)),
        lambda df: df.withColumnRenamed("b", "c"),
        lambda df: df.select("dt", F.col("b").alias("a"), F.col("a").alias("b"), "x", "m", "l"),
        lambda df: df.withColumn("l", F.reverse("l")),
        lambda df: df.withColumn("x", F.col("x") + 1e-9),
        lambda df: df.withColumn("more", F.lit(None).cast("int")),
    ],
)
def test_changes_count(spark, change):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert found(change(df)) != found(df)


def test_values_that_move_between_null_columns_or_rows(spark):
    def one(*values):
        return found(spark.createDataFrame([(*v, "d") for v in values], "a string, b string, dt string"))

    assert one(("x", None)) != one((None, "x"))
    assert one(("x", "y"), ("z", "w")) != one(("x", "w"), ("z", "y"))
    assert one(("x", "y"), ("x", "y")) != one(("x", "y"))
    assert one(("x", ""), ("x", None)) != one(("x", ""), ("x", ""))


def test_left_out_columns(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert found(df.withColumn("loaded", F.rand()), without=("LOADED",)) == found(df)


def test_only_changed_days_are_written(spark):
    database = new_database(spark, "test")
    source, target, state = (f"{database}.{n}" for n in ("source", "target", "state"))
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    base = [(i, f"v{i}", days[i % 3]) for i in range(30)]
    frame = lambda r: spark.createDataFrame(r, "id int, v string, dt string")
    warehouse.replace_days(frame(base), source, days)
    written = []

    def write(df, chosen):
        written.append(chosen)
        return warehouse.replace_days(df, target, chosen)

    def run(writer=write):
        return export.export_changed_content(spark, source, writer, state, days[0], days[-1], run_time="2024-02-01 00:00:00")

    def same():
        key = lambda t: sorted(tuple(r) for r in spark.table(quoted(t)).select("id", "v", "dt").collect())
        return key(source) == key(target)

    assert run() == days and same()
    warehouse.replace_days(frame(base[::-1]).repartition(4), source, days)
    assert run() == [] and written == [days]
    warehouse.replace_days(frame([(1, "other", days[1])]), source, [days[1]])

    def broken(df, chosen):
        raise OSError("store down")

    with pytest.raises(OSError):
        run(broken)
    assert run() == [days[1]] and same()
    warehouse.replace_days(frame([]), source, [days[2]])
    assert run() == [days[2]] and run() == [] and same()
    # days outside the range keep their digests
    assert export.export_changed_content(spark, source, write, state, days[0], run_time="2024-02-01 00:00:00") == []
    assert {r["dt"] for r in spark.table(quoted(state)).collect()} == set(days[:2])


def test_one_partial_aggregate(spark, capsys):
    digests.day_digests(spark.createDataFrame(rows(), SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Sort " not in plan
