"""Days of other types and shapes, safe replacement, and plans without needless shuffles."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from catalogue import queries as catalogue
from daybook.functions import dates
from daybook.model import LoadStrategy, days_between
from daybook.operators import changes, partitions
from daybook.plans import load
from daybook.session import new_database, quoted
from daybook.sinks import upsert as upsert_sink
from daybook.sinks import warehouse
from daybook.sources import extract


@pytest.fixture
def table(spark):
    return f"{new_database(spark, 'paths')}.t"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, table):
    return sorted(tuple(map(str, r)) for r in spark.table(quoted(table)).collect())


def test_date_days_in_frame_and_table(spark, table):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], "id int, dt string")
    by_date = rows.withColumn("dt", F.col("dt").cast("date"))
    warehouse.replace_days(by_date, table, ["2024-01-01", "2024-01-02"])
    assert rows_of(spark, table) == [("1", "2024-01-01"), ("2", "2024-01-02")]
    warehouse.replace_day(rows.withColumn("id", F.col("id") + 10), table, "2024-01-02")  # text into DATE
    warehouse.replace_range(by_date.where("id = 3"), table, "2024-01-03", "2024-01-04")
    assert rows_of(spark, table) == [("1", "2024-01-01"), ("12", "2024-01-02"), ("3", "2024-01-03")]
    warehouse.replace_day(by_date.limit(0), table, "2024-01-01")
    assert rows_of(spark, table) == [("12", "2024-01-02"), ("3", "2024-01-03")]


def test_times_as_days_are_refused(spark, table):
    rows = spark.createDataFrame([(1, "2024-01-01")], "id int, dt string").withColumn("dt", F.col("dt").cast("timestamp"))
    with pytest.raises(ValueError):
        warehouse.replace_day(rows, table, "2024-01-01")


@pytest.mark.parametrize("n", [3, 9])
def test_days_are_dropped_whatever_the_case_and_number(spark, table, n):
    days = days_between("2024-01-01", "2024-01-12")
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, DT string")
    rows.write.partitionBy("DT").saveAsTable(quoted(table))
    assert len(partitions.drop_days(spark, table, days[0], days[n - 1])) == n
    assert spark.table(quoted(table)).count() == 12 - n


def test_rows_without_a_day_can_be_dropped(spark, table):
    rows = spark.createDataFrame([(1, None), (2, "2024-01-01")], "id int, dt string")
    rows.write.partitionBy("dt").saveAsTable(quoted(table))
    partitions.drop_listed_days(spark, table, [partitions.NO_DAY])
    assert rows_of(spark, table) == [("2", "2024-01-01")]


@pytest.mark.parametrize("last", ["2024-01-02", "2024-01-03"])  # adjacent and scattered
def test_text_between_days_is_no_day(spark, table, last):
    texts = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-01 10:00:00", "2024-01-01x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, dt string")
    warehouse.replace_days(rows, table, ["2024-01-01", last])
    assert {d for _, d in rows_of(spark, table)} == {"2024-01-01", last}
    assert {r["dt"] for r in extract.rows_of_days(rows, "2024-01-01", "2024-01-02").collect()} == {"2024-01-01", "2024-01-02"}


@pytest.mark.parametrize("to_second", [False, True])
def test_time_text_is_filed_alike_by_day_and_by_range(spark, to_second):
    texts = [
        "2024-01-05 01:00:00", "2024-01-05 unreadable", "2024-01-05T10:00:00", "2024-01-05 23:00:00-05:00",
        "2024-01-06T23:59:59.5", "2024-01-06 23:59:59", "2024-01-0x", "2024-01-09x", None, "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")

    def loaded(dt, dt1):
        rows = extract.incremental(df, LoadStrategy.NEW, dt, dt1, created="t", to_second=to_second)
        return sorted((r["id"], r["dt"]) for r in rows.collect())

    days = days_between("2024-01-04", "2024-01-10")
    by_day = sorted(row for day in days for row in loaded(day, day))
    assert loaded(days[0], days[-1]) == by_day
    expected = [(0, "2024-01-05"), (1, "2024-01-05"), (2, "2024-01-05"), (3, "2024-01-05"), (5, "2024-01-06"), (7, "2024-01-09")]
    assert by_day == sorted(expected + ([] if to_second else [(4, "2024-01-06")]))


def test_lenient_times_out_of_any_range(spark):
    texts = ["99999999-01-01 00:00:00", "2024-999999999-01 00:00:00", "2024-01-01 00:00:999999999", "2024-13-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(dates.text_to_epoch_ms("t", lenient=True)).collect()]
    assert found[:3] == [0, 0, 0] and found[3] > 0


def test_catalogue_takes_its_days_from_the_data(spark):
    rows = spark.createDataFrame([(1, "2024-01-31"), (2, "2023-06-01"), (3, None)], "id int, dt string")
    assert catalogue._days(rows) == ["2023-06-01", "2024-01-31"]


def failing(spark):
    return spark.range(4).select(F.when(F.col("id") < 9, F.raise_error(F.lit("broken"))).cast("int").alias("a"))


def test_a_failing_replacement_leaves_the_old_table(spark, table):
    spark.sql(f"CREATE TABLE {quoted(table)} (a INT) USING parquet COMMENT 'it''s kept' TBLPROPERTIES ('team' = 'x')")
    spark.sql(f"INSERT INTO {quoted(table)} VALUES (1)")
    with pytest.raises(Exception, match="broken"):
        warehouse.replace_table(failing(spark), table)
    assert rows_of(spark, table) == [("1",)]
    warehouse.replace_table(spark.createDataFrame([(2, "b")], "a int, b string"), table)
    held = partitions.described(spark, table)
    assert held["comment"] == "it's kept" and held["table_properties"]["team"] == "x"
    upsert_sink.upsert(spark.createDataFrame([(2, "c"), (3, "d")], "a int, b string"), table, ["a"], ["a"])
    held = partitions.described(spark, table)
    assert held["comment"] == "it's kept" and held["table_properties"]["team"] == "x"
    assert rows_of(spark, table) == [("2", "c"), ("3", "d")]
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {quoted(table.split('.')[0])}").collect()] == ["t"]


def test_a_failing_swap_gives_the_name_back(spark, table, monkeypatch):
    spark.range(2).write.saveAsTable(quoted(table))
    run = type(spark).sql

    def refuse(self, statement, *args, **kwargs):
        if "__new_" in statement and "RENAME TO" in statement:
            raise RuntimeError("no second rename")
        return run(self, statement, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", refuse)
    with pytest.raises(RuntimeError):
        warehouse.replace_table(spark.range(5), table)
    monkeypatch.undo()
    assert spark.table(quoted(table)).count() == 2


def test_a_table_by_day_is_replaced_at_commit(spark, table):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "a int, dt string")
    warehouse.replace_table(rows, table, partition_by_day=True)
    broken = rows.select(F.when(F.col("a") < 9, F.raise_error(F.lit("broken"))).cast("int").alias("a"), "dt")
    with pytest.raises(Exception, match="broken"):
        warehouse.replace_table(broken, table, partition_by_day=True)
    assert len(rows_of(spark, table)) == 2
    warehouse.replace_table(rows.where("a = 2"), table, partition_by_day=True)
    assert rows_of(spark, table) == [("2", "2024-01-02")]


def test_upsert_touches_only_its_hours(spark, table):
    spark.sql(f"CREATE TABLE {quoted(table)} (id INT, v STRING, dt STRING, dh STRING) USING parquet PARTITIONED BY (dt, dh)")
    held = [(1, "a", "2024-01-01", "05"), (2, "b", "2024-01-01", "06"), (3, "c", "2024-01-02", "05"), (4, "d", "2024-01-02", None)]
    spark.createDataFrame(held, "id int, v string, dt string, dh string").write.insertInto(quoted(table))

    def files():
        return {f for f in spark.table(quoted(table)).inputFiles()}

    before = files()
    batch = spark.createDataFrame([(2, "B", "2024-01-02", "05"), (4, "D", "2024-01-02", None)], "id int, v string, dt string, dh string")
    upsert_sink.upsert(batch, table, ["id"], ["id"])
    assert rows_of(spark, table) == sorted(
        [("1", "a", "2024-01-01", "05"), ("2", "B", "2024-01-02", "05"), ("3", "c", "2024-01-02", "05"), ("4", "D", "2024-01-02", "None")]
    )
    kept = before & files()
    assert len(kept) == 1 and "dt=2024-01-01/dh=05" in next(iter(kept))


def test_absent_tables_get_clean_text(spark, table):
    warehouse.write_if_absent(spark.createDataFrame([("a\nb",)], "v string"), table)
    assert rows_of(spark, table) == [("ab",)]


def test_changed_days_are_not_sorted_inside_an_export(spark):
    view = f"v{uuid.uuid4().hex}"
    spark.createDataFrame([("2024-01-01",)], "dt string").createOrReplaceTempView(view)
    found = changes.found_days(spark, f"SELECT dt AS date FROM {view} WHERE dt = 'do_date'", "2024-01-01")
    assert "rangepartitioning" not in plan_of(found.union(found).distinct())


def test_new_and_changed_rows_push_both_bounds(spark):
    plan = plan_of(catalogue.queries()["load_new_and_change"](spark, "/root/testdata/sf0.001"))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert sum("GreaterThanOrEqual(o_orderdate" in line for line in pushed) >= 1
    assert sum("GreaterThanOrEqual(l_shipdate" in line for line in pushed) >= 1


def test_a_load_without_rebalance_shuffles_nothing(spark, table, monkeypatch):
    plans = []
    overwrite = warehouse.overwrite_days
    monkeypatch.setattr(warehouse, "overwrite_days", lambda df, *a: (plans.append(plan_of(df)), overwrite(df, *a)))
    rows = spark.createDataFrame([(1, "2024-01-01 10:00:00")], "id int, t string")
    database, name = table.split(".")
    for rebalance in (True, False):
        load.load_tables(lambda _: rows, database, name, "2024-01-01", "2024-01-02", created="t", rebalance=rebalance)
    assert "Exchange" in plans[0] and "Exchange" not in plans[1]
