"""Day tables and summaries by window kept up from a stream of rows, in whatever order they come.

Every micro-batch is staged once, filed under its rows' days and appended under the batch's own number
(:func:`daybook.sinks.locations.append_once`): a batch that Spark runs again, after a failure or a lost driver, replaces
its own files and nothing else.  A day's summary is made again from the day's rows whenever a batch brings some for it, so
late rows of any age count and change only their own days.  That is why there is no watermark: there is no state that
would have to be dropped, and the work of a batch follows the days that it touches.

Queries use the trigger ``availableNow`` unless told otherwise: they take what is there and end, and the next run goes on
from the checkpoint.  One query at a time may write a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.functions import dates
from daybook.operators.partitions import NO_DAY
from daybook.session import quoted, staged
from daybook.sinks import warehouse

OnDays = Callable[[list[str]], object]


def follow(
    rows: DataFrame,
    table: str,
    time: str,
    checkpoint: str,
    *,
    name: str = "stream",
    on_days: OnDays | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream's rows to a table by day of their ``time``, each batch exactly once.

    Rows without a time go to the partition of NULL.  ``on_days`` gets the days, as text, that a batch has
    brought rows for, after they are in the table; it may run again for the same batch.  ``name`` tells the batches of
    several streams into one table apart.  The table is created if missing; new columns are added to it as text.
    """
    spark = rows.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        filed = batch.withColumn("dt", dates.day_text(batch, time))
        with staged(filed) as kept:
            days = kept.select(F.coalesce("dt", F.lit(NO_DAY)).alias("dt")).distinct()
            found = sorted(r["dt"] for r in days.collect())
            if not found:
                return
            warehouse.append_once(kept, table, f"{name}.{number}")
            spark.catalog.refreshTable(quoted(table))  # batches have a session of their own, which alone knows the new files
            if on_days:
                on_days([d for d in found if d != NO_DAY])

    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def window_counts(
    rows: DataFrame, time: str, size: str, keys: list[str], measures: dict[str, Column] | None = None
) -> DataFrame:
    """``dt, window_start, keys…, n, measures…`` of rows with a time, by the window that holds it.

    A window belongs to the day it starts on, so windows must not reach over midnight: ``size`` divides a day.
    """
    start = dates.window_start(time, size)
    placed = rows.where(F.col(time).isNotNull()).withColumn("window_start", start)
    totals = [F.count(F.lit(1)).alias("n"), *[m.alias(k) for k, m in (measures or {}).items()]]
    return placed.groupBy("dt", "window_start", *keys).agg(*totals)


def summarise_days(
    table: str, summary: str, time: str, size: str, keys: list[str], measures: dict[str, Column] | None = None, *, spark
) -> OnDays:
    """For ``on_days``: replaces the days' windows in the table ``summary`` by what the days' rows give now."""

    def each(days: list[str]) -> None:
        if days:
            held = spark.table(quoted(table))
            rows = held.where(dates.in_day_list(held, days))
            counts = window_counts(rows, time, size, keys, measures)
            shown = counts.select(*[c for c in counts.columns if c != "dt"], "dt")
            warehouse.replace_days(shown, summary, days)

    return each
