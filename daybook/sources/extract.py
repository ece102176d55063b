"""Which rows a load takes from a source, whatever the source is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from daybook.functions import dates
from daybook.model import LoadStrategy, check_range, days_between


def _predicate(to_second: bool):
    return dates.in_days_to_second if to_second else dates.in_days


def new_rows(
    df: DataFrame, created: str, dt: str, dt1: str | None = None, to_second: bool = False
) -> DataFrame:
    """Rows created in the days ``dt`` to ``dt1``."""
    return df.where(_predicate(to_second)(df, created, dt, dt1))


def new_and_changed_rows(
    df: DataFrame,
    created: str,
    updated: str,
    dt: str,
    dt1: str | None = None,
    to_second: bool = False,
) -> DataFrame:
    """Rows created or updated in the days; a row that is both comes once."""
    test = _predicate(to_second)
    return df.where(test(df, created, dt, dt1) | test(df, updated, dt, dt1))


def rows_of_day(df: DataFrame, day: str) -> DataFrame:
    """Rows whose ``dt`` is the day; prunes partitions where ``dt`` is one."""
    return df.where(dates.in_day_list(df, [day]))


def rows_of_days(df: DataFrame, dt: str, dt1: str | None = None) -> DataFrame:
    return df.where(dates.in_day_list(df, days_between(dt, dt1)))


def incremental(
    df: DataFrame,
    strategy: LoadStrategy,
    dt: str,
    dt1: str | None = None,
    created: str | None = None,
    updated: str | None = None,
    to_second: bool = False,
) -> DataFrame:
    """The rows a load takes, stamped with the day ``dt`` they are filed under.

    A range is one pass over the source and gives what a load per day would give:
    a new row is filed under its creation day, a row created and updated on two
    days of the range is filed under both, and a snapshot is filed under the last day.
    Time text is filed under the day it starts with, whatever follows; a row whose text
    starts with no day, or with one outside the range, is left out.
    """
    dt, dt1 = check_range(dt, dt1)
    if strategy is LoadStrategy.ALL:
        return df.withColumn("dt", F.lit(dt1))
    if strategy is LoadStrategy.NEW:
        rows = new_rows(df, created, dt, dt1, to_second)
    else:
        rows = new_and_changed_rows(df, created, updated, dt, dt1, to_second)
    if strategy is LoadStrategy.NEW:
        filed = rows.withColumn("dt", _filed_day(df, created, to_second))
        return filed.where(F.col("dt").between(dt, dt1))
    days = F.array(_filed_day(df, created, to_second), _filed_day(df, updated, to_second))
    in_range = F.filter(F.array_distinct(days), lambda d: d.between(dt, dt1))
    return rows.withColumn("dt", F.explode(in_range))


def _filed_day(df: DataFrame, name: str, to_second: bool) -> Column:
    """The day of a time; NULL outside ``00:00:00`` to ``23:59:59`` of it if that counts."""
    data_type = dates.type_of(df, name)
    day = dates.filed_day(df, name)
    if not to_second or isinstance(data_type, DateType):
        return day
    if isinstance(data_type, StringType):
        return F.when((F.length(name) > 10) & ~dates.is_past_last_second(F.col(name)), day)
    first, last = (F.concat(day, F.lit(t)).cast(data_type) for t in (" 00:00:00", " 23:59:59"))
    return F.when(F.col(name).between(first, last), day)
