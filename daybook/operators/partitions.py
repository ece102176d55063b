"""Day partitions of warehouse tables: looking them up, dropping them, retention."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from daybook.model import check_day, check_range, days_between
from daybook.session import quoted

# Fixed value: the partition of rows whose partition column is NULL.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

_DROPS_PER_STATEMENT = 500
_DAYS_ASKED = 7


def described(spark: SparkSession, table: str) -> dict:
    """What the catalog holds about a table; a command's answer, so no job is run."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} AS JSON").first()[0])


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return described(spark, table).get("partition_columns", [])


def is_partitioned_by_day(spark: SparkSession, table: str) -> bool:
    """Whether ``dt`` is the first partition column."""
    return [c.lower() for c in partition_columns(spark, table)][:1] == ["dt"]


def has_day_partitions_only(spark: SparkSession, table: str) -> bool:
    return [c.lower() for c in partition_columns(spark, table)] == ["dt"]


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Column ``partition``: ``dt=2021-09-01``, with deeper levels after a slash."""
    return spark.sql(f"SHOW PARTITIONS {quoted(table)}")


def partition_exists(spark: SparkSession, table: str, day: str) -> bool:
    found = spark.sql(f"SHOW PARTITIONS {quoted(table)} PARTITION (dt = '{check_day(day)}')")
    return bool(found.take(1))


def _partitions_of(spark: SparkSession, table: str, days: Sequence[str]) -> list[str]:
    """Partition names of the days: a few are asked of the catalog one by one, more with one listing."""
    if len(days) > _DAYS_ASKED:
        wanted = set(days)
        names = [r["partition"] for r in list_partitions(spark, table).collect()]
        return [n for n in names if unquote(n.split("/")[0]).partition("=")[2] in wanted]

    def shown(day: str) -> list[str]:
        value = "null" if day == NO_DAY else f"'{day}'"
        found = spark.sql(f"SHOW PARTITIONS {quoted(table)} PARTITION (dt = {value})")
        return [r["partition"] for r in found.collect()]

    return [name for day in days for name in shown(day)]


def _spec(name: str) -> str:
    # Full specs by equality: range specs are no syntax, partial ones depend on the catalog.
    parts = [unquote(level).partition("=") for level in name.split("/")]
    return ", ".join(
        "`{}` = {}".format(k, "null" if v == NO_DAY else "'" + v.replace("'", "\\'") + "'") for k, _, v in parts
    )


def drop_named(spark: SparkSession, table: str, names: Sequence[str]) -> None:
    """Drop partitions by their full names (``dt=2021-09-01/dh=05``); those not there are passed over."""
    for start in range(0, len(names), _DROPS_PER_STATEMENT):
        specs = ", ".join(f"PARTITION ({_spec(n)})" for n in names[start : start + _DROPS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {specs}")


def drop_listed_days(spark: SparkSession, table: str, days: Sequence[str]) -> list[str]:
    """Drop the partitions of exactly these days and name them.

    A table not partitioned by ``dt`` is left alone.  Only partition names reach the driver.
    """
    if not days or not is_partitioned_by_day(spark, table):
        return []
    names = _partitions_of(spark, table, days)
    drop_named(spark, table, names)
    return names


def drop_days(spark: SparkSession, table: str, dt: str, dt1: str | None = None) -> list[str]:
    """Drop the partitions of the inclusive day range and name them."""
    return drop_listed_days(spark, table, days_between(dt, dt1))


def _names(listed: str, everything: Sequence[str]) -> list[str]:
    if listed.strip().lower() == "all":
        return list(everything)
    return [n.strip() for n in listed.split(",") if n.strip()]


def tables_of(spark: SparkSession, database: str) -> list[str]:
    """Names of the stored tables of a database, without temporary views."""

    def stored(kind: str, column: str) -> list[str]:
        listed = spark.sql(f"SHOW {kind} IN `{database}`").collect()
        return [r[column] for r in listed if not r["isTemporary"]]

    views = set(stored("VIEWS", "viewName"))
    return [name for name in stored("TABLES", "tableName") if name not in views]


def clean_days(
    spark: SparkSession, databases: str, tables: str, dt: str, dt1: str | None = None
) -> list[tuple[str, str]]:
    """Drop a day range from many tables; ``databases`` and ``tables`` are lists or ``all``.

    Tables that do not exist or have no day partitions are passed over.  Returns
    ``(table, partition)`` for each partition dropped.
    """
    check_range(dt, dt1)
    dropped = []
    existing = [r["namespace"] for r in spark.sql("SHOW DATABASES").collect()]
    for database in _names(databases, existing):
        stored = tables_of(spark, database)
        known = {t.lower() for t in stored}
        for name in _names(tables, stored):
            if name.lower() in known:
                table = f"{database}.{name}"
                dropped += [(table, p) for p in drop_days(spark, table, dt, dt1)]
    return dropped


def drop_all_tables(spark: SparkSession, database: str, confirm: bool = False) -> list[str]:
    """Names of the stored tables of a database; dropped only with ``confirm``."""
    names = tables_of(spark, database)
    if confirm:
        for name in names:
            spark.sql(f"DROP TABLE {quoted(f'{database}.{name}')}")
    return names
