"""Random sequences of table operations against the same sequences on a Python list."""

from __future__ import annotations

import random

import pytest

from daybook.model import days_between
from daybook.operators import partitions
from daybook.session import new_database, quoted
from daybook.sinks import upsert as upsert_sink
from daybook.sinks import warehouse

DAYS = days_between("2024-01-01", "2024-01-06")
COLUMNS = "id int, v string, seq int, dt string"


def rows(pick, count, days):
    return [
        (pick.randrange(12), pick.choice("abc"), pick.randrange(1000), pick.choice(days))
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_table_follows_the_model(spark, seed):
    pick = random.Random(seed)
    table = f"{new_database(spark, 'test')}.t"
    model = rows(pick, 20, DAYS)
    warehouse.replace_range(spark.createDataFrame(model, COLUMNS), table, DAYS[0], DAYS[-1])
    for _ in range(5):
        low, high = sorted(pick.sample(range(len(DAYS)), 2))
        chosen = DAYS[low : high + 1]
        batch = rows(pick, pick.choice([0, 3, 8]), DAYS)
        df = spark.createDataFrame(batch, COLUMNS)
        kind = pick.choice(["day", "days", "range", "upsert", "drop"])
        if kind == "day":
            warehouse.replace_day(df, table, chosen[0])
            model = [r for r in model if r[3] != chosen[0]] + [r for r in batch if r[3] == chosen[0]]
        elif kind == "days":
            ends = [chosen[0], chosen[-1]]
            warehouse.replace_days(df, table, ends)
            model = [r for r in model if r[3] not in ends] + [r for r in batch if r[3] in ends]
        elif kind == "range":
            warehouse.replace_range(df, table, chosen[0], chosen[-1])
            model = [r for r in model if r[3] not in chosen] + batch
        elif kind == "upsert":
            upsert_sink.upsert(df, table, ["id"], ["seq"])
            latest = {}
            for r in sorted(batch, key=lambda r: (r[2], r[0], r[1], r[3])):
                latest[r[0]] = r
            model = [r for r in model if r[0] not in latest] + list(latest.values())
        else:
            partitions.drop_days(spark, table, chosen[0], chosen[-1])
            model = [r for r in model if r[3] not in chosen]
        held = [tuple(r) for r in spark.table(quoted(table)).collect()]
        assert sorted(held) == sorted(model), kind
        shown = {r[0] for r in partitions.list_partitions(spark, table).collect()}
        assert shown == {f"dt={r[3]}" for r in model}
