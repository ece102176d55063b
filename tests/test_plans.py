"""Jobs on small frames; above all, that one pass over a range equals a run per day."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybook.model import LoadStrategy, days_between
from daybook.plans import export, load
from daybook.session import new_database, new_path, quoted
from daybook.sinks import files as file_sinks
from daybook.sinks import warehouse
from daybook.sources import files as file_sources
from daybook.sources.extract import incremental


@pytest.fixture
def table(spark):
    return f"{new_database(spark, 'test')}.t"


def content(spark, table, *columns):
    df = spark.table(quoted(table))
    df = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in df.collect()], key=repr)


def times(spark, kind):
    """Rows around the ends of days, some without creation or update time."""
    pick = random.Random(7)
    edges = [
        timedelta(0),
        timedelta(hours=12),
        timedelta(hours=23, minutes=59, seconds=59),
        timedelta(hours=23, minutes=59, seconds=59, microseconds=5),
    ]

    def time():
        if pick.random() < 0.1:
            return None
        moment = datetime(2024, 1, 1) + timedelta(days=pick.randrange(8)) + pick.choice(edges)
        return str(moment) if kind == "string" else moment

    rows = [(n, time(), time()) for n in range(200)]
    return spark.createDataFrame(rows, f"id int, ct {kind}, ut {kind}")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
@pytest.mark.parametrize("to_second", [False, True])
@pytest.mark.parametrize("strategy", [LoadStrategy.NEW, LoadStrategy.NEW_AND_CHANGE])
def test_a_range_equals_its_days(spark, kind, to_second, strategy):
    df = times(spark, kind)

    def rows(dt, dt1):
        found = incremental(df, strategy, dt, dt1, "ct", "ut", to_second).select("id", "dt")
        return [tuple(r) for r in found.collect()]

    per_day = [r for day in days_between("2024-01-03", "2024-01-06") for r in rows(day, day)]
    assert sorted(rows("2024-01-03", "2024-01-06")) == sorted(per_day)
    assert len(set(per_day)) == len(per_day) > 50


def test_row_created_and_updated_on_one_day_comes_once(spark):
    moment = datetime(2024, 1, 3, 5)
    df = spark.createDataFrame([(1, moment, moment)], "id int, ct timestamp, ut timestamp")
    rows = incremental(df, LoadStrategy.NEW_AND_CHANGE, "2024-01-03", None, "ct", "ut")
    assert rows.count() == 1


def test_snapshot_is_stamped_with_the_last_day(spark):
    rows = incremental(spark.range(2), LoadStrategy.ALL, "2024-01-03", "2024-01-05")
    assert [tuple(r) for r in rows.collect()] == [(0, "2024-01-05"), (1, "2024-01-05")]


def test_load_twice(spark, table):
    database, name = table.split(".")
    source = spark.createDataFrame(
        [(1, "a\n", datetime(2024, 1, 1, 5)), (2, "b", datetime(2024, 1, 2, 5))],
        "id int, v string, ct timestamp",
    )
    for _ in range(2):
        load.load_tables(
            lambda _: source, database, "src", "2024-01-01", "2024-01-03", targets=name, created="ct"
        )
        assert content(spark, table, "id", "v", "dt") == [
            (1, "a", "2024-01-01"),
            (2, "b", "2024-01-02"),
        ]


def test_several_tables_only_whole(spark):
    database = new_database(spark, "test")
    with pytest.raises(ValueError):
        load.load_tables(lambda _: spark.range(1), database, "a,b", "2024-01-01", created="ct")
    with pytest.raises(ValueError):
        load.load_tables(lambda _: spark.range(1), database, "a,b", "2024-01-01", targets="x")
    loaded = load.load_tables(lambda _: spark.range(1), database, "a,b", "2024-01-01", prefix="p_")
    assert sorted(loaded) == ["p_a", "p_b"]


def test_mixed_days_without_a_time_column(spark, table):
    load.load_mixed_days(spark.range(1), table, None, "2024-01-01", "2024-01-02")
    assert content(spark, table) == [(0, "2024-01-01"), (0, "2024-01-02")]


def test_sheet(spark, table):
    path = new_path(spark, "sheet")
    text = "u,when,note\n1,2020年7月15日,\\N\n2,2020年7月16日,x\n"
    spark.createDataFrame([(text,)], "value string").write.text(path)
    for _ in range(2):
        sheet = file_sources.read_csv(spark, path, "user_id,fill_in_time,note")
        assert dict(sheet.dtypes) == dict.fromkeys(sheet.columns, "string")
        load.load_sheet(sheet, table, "fill_in_time", "2020-07-15", "2020-07-16")
        assert content(spark, table, "user_id", "note", "dt") == [
            ("1", None, "2020-07-15"),
            ("2", "x", "2020-07-16"),
        ]


def test_exports_hand_over_rows_and_days(spark, table):
    rows = [(n, f"2024-01-0{n}") for n in range(1, 6)]
    df = spark.createDataFrame(rows, "id int, dt string")
    warehouse.replace_range(df, table, "2024-01-01", "2024-01-05")
    seen = []

    def write(exported, days):
        seen.append((exported.columns, sorted(r["id"] for r in exported.collect()), days))

    run_time = "2024-02-01 00:00:00"
    export.export_days(spark, table, write, "2024-01-02", "2024-01-03", run_time=run_time)
    assert seen.pop() == (["id", "dt", "last_update_time"], [2, 3], ["2024-01-02", "2024-01-03"])
    export.export_days(spark, table, write, "2024-01-02", run_time=run_time, stamp_first=True)
    assert seen.pop()[0][0] == "last_update_time"
    export.export_days(
        spark, table, write, "2024-01-02", "2024-01-04", run_time=run_time, last_day_only=True
    )
    assert seen.pop()[1:] == ([4], ["2024-01-04"])
    query = f"SELECT date_sub(dt, 2) AS date FROM {quoted(table)} WHERE dt = 'do_date'"
    days = export.export_changed_days(
        spark, table, write, "2024-01-03", "2024-01-05", run_time=run_time, changed_days_query=query
    )
    assert days == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert seen.pop()[1:] == ([1, 2, 3], days)
    assert export.export_changed_days(spark, table, write, "2024-01-05", run_time=run_time) == [
        "2024-01-05"
    ]
    assert seen.pop()[1] == [5]


def test_changed_day_without_rows_is_emptied(spark, table):
    source, target = table, f"{table}_out"
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, dt string")
    warehouse.replace_range(df, source, "2024-01-01", "2024-01-02")
    old = df.withColumn("last_update_time", F.lit("old"))
    warehouse.replace_range(old, target, "2024-01-01", "2024-01-02")
    warehouse.replace_day(df.limit(0), source, "2024-01-01")
    export.export_changed_days(
        spark,
        source,
        lambda rows, days: warehouse.replace_days(rows, target, days),
        "2024-01-02",
        run_time="new",
        changed_days_query="SELECT '2024-01-01' AS date WHERE 'do_date' = '2024-01-02'",
    )
    assert content(spark, target, "id", "last_update_time") == [(2, "old")]


def test_csv_files_all_carry_a_header(spark):
    path = new_path(spark, "csv")
    df = spark.range(10).repartition(3)
    file_sinks.export_csv(df, path)
    file_sinks.export_csv(df, path)
    assert spark.read.option("header", True).csv(path).count() == 20
    file_sinks.export_csv(df, path, mode="overwrite")
    assert spark.read.option("header", True).csv(path).count() == 10


def test_documents_keep_null_fields(spark):
    path = new_path(spark, "docs")
    df = spark.createDataFrame([(1, None)], "id int, v string")
    file_sinks.export_json_docs(df, path)
    assert [r["value"] for r in spark.read.text(path).collect()] == ['{"id":1,"v":null}']
