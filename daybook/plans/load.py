"""Jobs that load the warehouse.

Each job takes a *reader*, a function from a source table's name to its lazy frame
(``sources.relational.reader``, ``sources.search.reader`` …), so one job serves every
kind of store.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import dates
from daybook.model import (
    LoadStrategy,
    check_range,
    choose_day_match_strategy,
    choose_strategy,
    days_between,
    pair_tables,
    require_text,
)
from daybook.operators.frames import clean_text, join_allow_list
from daybook.sinks import warehouse
from daybook.sources.extract import incremental

Reader = Callable[[str], DataFrame]


def load_tables(
    read: Reader,
    database: str,
    sources: str | Sequence[str],
    dt: str,
    dt1: str | None = None,
    *,
    targets: str | Sequence[str] | None = None,
    prefix: str = "",
    created: str | None = None,
    updated: str | None = None,
    to_second: bool = False,
    fmt: str = "parquet",
    comments: Mapping[str, str] | None = None,
    rebalance: bool = True,
) -> dict[str, DataFrame]:
    """Load tables for a day or a range of days, by what the time columns allow.

    No time column: each target becomes a snapshot stamped with the last day.  Otherwise
    the days are replaced by the rows created, or created or updated, on them; that is
    allowed for one table only.  ``to_second`` closes days at 23:59:59.  Without
    ``rebalance`` the files follow the scan's splits and no row is shuffled.
    """
    require_text(database=database)
    dt, dt1 = check_range(dt, dt1)
    strategy = choose_strategy(created, updated)
    pairs = pair_tables(sources, targets, prefix)
    if len(pairs) > 1 and strategy is not LoadStrategy.ALL:
        raise ValueError("several tables can only be loaded whole")
    loaded = {}
    for pair in pairs:
        table = f"{database}.{pair.target}"
        rows = incremental(read(pair.source), strategy, dt, dt1, created, updated, to_second)
        if strategy is LoadStrategy.ALL:
            loaded[pair.target] = warehouse.replace_table(
                rows, table, fmt=fmt, partition_by_day=True, comments=comments
            )
        else:
            loaded[pair.target] = warehouse.replace_days(
                rows, table, days_between(dt, dt1), fmt=fmt, comments=comments, rebalance=rebalance
            )
    return loaded


def load_mixed_days(
    df: DataFrame,
    table: str,
    time_column: str | None,
    dt: str,
    dt1: str | None = None,
    *,
    rebalance: bool = True,
) -> DataFrame:
    """Load rows whose time text names a day of the range in any of the known formats.

    Without a time column every row is filed under every day, as a snapshot.
    """
    dt, dt1 = check_range(dt, dt1)
    if choose_day_match_strategy(time_column) is LoadStrategy.ALL:
        return warehouse.replace_days_with_snapshot(df, table, dt, dt1)
    rows = df.withColumn("dt", dates.day_of_mixed_text(time_column))
    return warehouse.replace_days(rows, table, days_between(dt, dt1), rebalance=rebalance)


def load_range(
    df: DataFrame,
    table: str,
    created: str,
    dt: str,
    dt1: str,
    *,
    fmt: str = "parquet",
    rebalance: bool = True,
) -> DataFrame:
    """Rows created from ``dt 00:00:00`` to ``dt1 23:59:59``, each filed under its own day;
    columns the table does not know are left out."""
    rows = df.where(dates.in_days_to_second(df, created, dt, dt1))
    filed = rows.withColumn("dt", dates.filed_day(df, created))
    return warehouse.replace_range(filed, table, dt, dt1, fmt=fmt, rebalance=rebalance)


def load_sheet(df: DataFrame, table: str, date_column: str, dt: str, dt1: str) -> DataFrame:
    """An all-text sheet filed by its Chinese or plain date text; see ``replace_range``."""
    rows = clean_text(df)
    filed = rows.withColumn("dt", dates.day_of_chinese_text(date_column))
    return warehouse.replace_range(filed, table, dt, dt1, clean=False)


def load_snapshot_per_day(
    df: DataFrame, table: str, dt: str, dt1: str, *, fmt: str = "parquet"
) -> DataFrame:
    return warehouse.replace_days_with_snapshot(df, table, dt, dt1, fmt=fmt)


def load_table(df: DataFrame, table: str, *, fmt: str = "parquet") -> DataFrame:
    """A whole table as it is: no day column, no cleaning."""
    return warehouse.replace_table(df, table, fmt=fmt, clean=False)


def allowed_rows(
    df: DataFrame,
    created: str,
    dt: str,
    dt1: str,
    columns: Sequence[str],
    allowed: DataFrame,
    match: str,
    key: str,
) -> DataFrame:
    """Chosen columns of the rows of a closed day range whose ``match`` is on a list."""
    rows = df.where(dates.in_days_to_second(df, created, dt, dt1))
    rows = rows.select(*[F.col(c) for c in columns])
    return join_allow_list(rows, match, allowed, key)


def copy_tables(
    read: Reader,
    write: Callable[[DataFrame, str], object],
    sources: str | Sequence[str],
    targets: str | Sequence[str] | None = None,
    prefix: str = "",
) -> None:
    """Copy whole tables from one store to another, replacing the targets."""
    for pair in pair_tables(sources, targets, prefix):
        write(read(pair.source), pair.target)
