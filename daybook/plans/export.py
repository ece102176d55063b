"""Jobs that bring warehouse days to other stores.

Each job takes a *writer*, a function of the rows and the days they replace, so one job
serves every target (``sinks.relational.replace``, ``sinks.warehouse.replace_days`` …).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.dates import in_day_list
from daybook.model import check_range, days_between, pair_tables, require_text
from daybook.operators.changes import found_days
from daybook.operators.digests import SCHEMA, day_digests, different_days, held_digests
from daybook.operators.frames import stamp_export_time
from daybook.session import quoted
from daybook.sinks.warehouse import replace_table
from daybook.sources.extract import rows_of_days

DayWriter = Callable[[DataFrame, list[str]], object]


def stamped_days(
    spark: SparkSession,
    table: str,
    dt: str,
    dt1: str | None,
    run_time: str,
    stamp_first: bool = False,
) -> DataFrame:
    """The table's rows of the days with the time of the export."""
    rows = rows_of_days(spark.table(quoted(table)), dt, dt1)
    return stamp_export_time(rows, run_time, stamp_first)


def export_days(
    spark: SparkSession,
    table: str,
    write: DayWriter,
    dt: str,
    dt1: str | None = None,
    *,
    run_time: str,
    stamp_first: bool = False,
    last_day_only: bool = False,
) -> None:
    """Export a range of days in one write.

    ``last_day_only`` is for targets that each day would replace whole: what a run per
    day leaves there is the last day.
    """
    dt, dt1 = check_range(dt, dt1)
    dt = dt1 if last_day_only else dt
    write(stamped_days(spark, table, dt, dt1, run_time, stamp_first), days_between(dt, dt1))


def export_tables(
    spark: SparkSession,
    database: str,
    write: Callable[[DataFrame, str, list[str]], object],
    sources: str | Sequence[str],
    targets: str | Sequence[str] | None,
    dt: str,
    dt1: str | None = None,
    *,
    run_time: str,
    prefix: str = "",
    last_day_only: bool = False,
) -> None:
    """Export the days of several tables; ``write`` also gets the target's name."""
    require_text(database=database)
    for pair in pair_tables(sources, targets, prefix):
        export_days(
            spark,
            f"{database}.{pair.source}",
            lambda rows, days, target=pair.target: write(rows, target, days),
            dt,
            dt1,
            run_time=run_time,
            last_day_only=last_day_only,
        )


def export_changed_days(
    spark: SparkSession,
    table: str,
    write: DayWriter,
    dt: str,
    dt1: str | None = None,
    *,
    run_time: str,
    changed_days_query: str | None = None,
) -> list[str]:
    """Export again every day that the loads of the range have changed, in one write.

    ``changed_days_query`` finds the changed days of one load day (``do_date``); without
    it the load days themselves are exported.  Returns the exported days.
    """
    days = set(days_between(dt, dt1))
    if changed_days_query:
        found = [found_days(spark, changed_days_query, d) for d in sorted(days)]
        every = found[0]
        for other in found[1:]:
            every = every.union(other)
        days = {r["date"] for r in every.distinct().collect()}  # calendar days only
    exported = sorted(days)
    if exported:
        held = spark.table(quoted(table))
        rows = held.where(in_day_list(held, exported))
        write(stamp_export_time(rows, run_time), exported)
    return exported


def export_changed_content(
    spark: SparkSession,
    table: str,
    write: DayWriter,
    state: str,
    dt: str,
    dt1: str | None = None,
    *,
    run_time: str,
    without: tuple[str, ...] = (),
) -> list[str]:
    """Export the days of a range whose rows differ from those of their last export, in one write.

    The table ``state`` keeps a digest of each exported day; it is changed after the write, so that a failing
    export is made again.  Columns ``without`` (times of the load, for one) do not count as content.  A day
    that has lost all its rows is handed to the writer as well, without rows.  Returns the exported days.
    """
    wanted = days_between(dt, dt1)
    now = day_digests(rows_of_days(spark.table(quoted(table)), dt, dt1), without)
    held = held_digests(spark, state)
    # a row for each day that differs
    changed = {r["dt"]: tuple(r) for r in different_days(now, held.where(F.col("dt").isin(wanted))).collect()}
    if changed:
        days = sorted(changed)
        source = spark.table(quoted(table))
        write(stamp_export_time(source.where(in_day_list(source, days)), run_time), days)
        fresh = spark.createDataFrame([r for r in changed.values() if r[1] is not None], SCHEMA)
        replace_table(held.where(~F.col("dt").isin(days)).unionByName(fresh).coalesce(1), state)
    return sorted(changed)
