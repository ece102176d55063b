"""Key filters: no partition that holds a key is missed, and others are not read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daybook.operators import partitions
from daybook.session import new_database, quoted
from daybook.sinks import keyfilter, upsert, warehouse

DAYS = [f"2024-01-{d:02d}" for d in range(1, 11)]


@pytest.fixture
def table(spark):
    name = f"{new_database(spark, 'test')}.t"
    rows = spark.range(2000).select(
        (F.col("id") * 7 % 2000).alias("id"), F.lit("old").alias("v"), F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 10 + 1).cast("string"), 2, "0")).alias("dt")
    )
    warehouse.replace_days(rows, name, DAYS)
    return name


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, dt string")


def by_key(spark, table):
    return {r["id"]: (r["v"], r["dt"]) for r in spark.table(quoted(table)).collect()}


def test_filters_name_every_partition_with_a_key(spark, table):
    assert keyfilter.possible(batch(spark, [(1, "", "")]), table, ["id"], ["dt"]) is None
    assert keyfilter.refresh(spark, table, ["id"], ["dt"]) == [f'["{d}"]' for d in DAYS]
    assert keyfilter.refresh(spark, table, ["id"], ["dt"]) == []
    days = {r["id"]: r["dt"] for r in spark.table(quoted(table)).collect()}
    extra = 0
    for start in range(0, 2000, 97):
        found = keyfilter.possible(batch(spark, [(start, "", ""), (start + 1, "", "")]), table, ["id"], ["dt"])
        wanted = {days[start], days[start + 1]} if start + 1 in days else {days[start]}
        assert wanted <= {f[0] for f in found}
        extra += len(found) - len(wanted)
    assert extra <= 10
    assert keyfilter.possible(batch(spark, [(10**9, "", ""), (-5, "", "")]), table, ["id"], ["dt"]) == []


def test_upsert_reads_only_possible_partitions(spark, table, monkeypatch):
    upsert.upsert(batch(spark, [(0, "first", DAYS[0])]), table, ["id"], ["v"], key_filter=True)
    read = []
    inner = keyfilter.of_partitions

    def noted(target, by, chosen):
        found = inner(target, by, chosen)
        read.append(sorted({f.split("/")[-2] for f in found.inputFiles()}))
        return found

    monkeypatch.setattr(keyfilter, "of_partitions", noted)
    before = by_key(spark, table)
    key = 21  # its day is neither the first nor the last
    files = set(spark.table(quoted(table)).inputFiles())
    upsert.upsert(batch(spark, [(key, "new", DAYS[9])]), table, ["id"], ["v"], key_filter=True)
    day = before[key][1]
    assert read[0] == [f"dt={day}"]
    assert all(set(r) <= {f"dt={day}", f"dt={DAYS[9]}"} for r in read)
    assert by_key(spark, table) == before | {key: ("new", DAYS[9])}
    kept = {f for f in files if f"dt={day}/" not in f and f"dt={DAYS[9]}/" not in f}
    assert kept <= set(spark.table(quoted(table)).inputFiles())


def test_partitions_changed_elsewhere_are_read(spark, table):
    upsert.upsert(batch(spark, [(0, "first", DAYS[0])]), table, ["id"], ["v"], key_filter=True)
    moved = [(5000 + i, "moved in", DAYS[3]) for i in range(5)] + [(6000, "new day", "2024-02-01")]
    warehouse.replace_days(batch(spark, moved), table, [DAYS[3], "2024-02-01"])
    upsert.upsert(batch(spark, [(5002, "late", DAYS[4]), (6000, "gone", DAYS[5])]), table, ["id"], ["v"], key_filter=True)
    rows = by_key(spark, table)
    assert rows[5002] == ("late", DAYS[4]) and rows[6000] == ("gone", DAYS[5])
    assert spark.table(quoted(table)).where("id IN (5002, 6000)").count() == 2
    assert "dt=2024-02-01" not in [r[0] for r in partitions.list_partitions(spark, table).collect()]
    held = keyfilter._held(spark, table)
    assert {part for part, _ in held} == set(keyfilter.file_marks(spark, table, ["id"], ["dt"])) and len(held) == 10


def test_two_levels_null_days_text_keys(spark):
    name = f"{new_database(spark, 'test')}.t"
    spark.sql(f"CREATE TABLE {quoted(name)} (k STRING, n INT, v INT, dt STRING, `place of` STRING) USING parquet PARTITIONED BY (dt, `place of`)")
    rows = [(f"k{i}", i, 0, None if i % 4 == 0 else f"2024-01-0{i % 4}", ["a/b", "c=d é", "it's"][i % 3]) for i in range(60)]
    schema = "k string, n int, v int, dt string, `place of` string"
    spark.createDataFrame(rows, schema).write.insertInto(quoted(name))
    for turn in (1, 2, 3):
        changed = [(f"k{i}", i, turn, "2024-01-09", "z") for i in range(turn, 60, 17)]
        upsert.upsert(spark.createDataFrame(changed, schema), name, ["k", "n"], ["v"], key_filter=True)
        rows = [r for r in rows if r[0] not in {c[0] for c in changed}] + changed
        assert sorted((tuple(r) for r in spark.table(quoted(name)).collect()), key=repr) == sorted(rows, key=repr)
    assert len(keyfilter._held(spark, name)) == len(keyfilter.file_marks(spark, name, ["k", "n"], ["dt", "place of"]))
