"""Daily snapshots kept as intervals: a row is stored once for as long as it stays the same.

The history of a table holds its columns, ``copies`` (how often the row is in the snapshot), ``valid_from`` (the first day it
is there) and ``valid_to`` (the first day it is not, or ``OPEN``), which partitions it.  What is stored follows the changes,
not the days.  Rows are compared whole, NULLs as equal, repeated rows by their number, so no key is needed.

To file a day, its rows and the open ones are stacked and summed by row: one aggregate with a partial step, in which a row that
comes a billion times is one row of each task.  Only the partitions ``OPEN`` and the day itself are written.  Both are made
from what the days before have left, so that filing the day again, with the same or other rows, gives what filing it once would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.model import check_day
from daybook.operators import drift, partitions
from daybook.session import quoted, session_settings
from daybook.sinks import warehouse

OPEN = "9999-12-31"
INTERVAL = ("copies", "valid_from", "valid_to")

_REPEATED_AT_ONCE = 65536


def _create(df: DataFrame, table: str, fmt: str) -> None:
    taken = {c.lower() for c in df.columns} & set(INTERVAL)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are those of the intervals")
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    columns = columns.add("copies", T.LongType()).add("valid_from", T.StringType()).add("valid_to", T.StringType())
    df.sparkSession.sql(f"CREATE TABLE {quoted(table)} ({columns.toDDL()}) USING {fmt} PARTITIONED BY (valid_to)")


def _last_day(spark: SparkSession, table: str) -> str | None:
    """The last day at which a row has come or gone."""
    gone = [r["partition"].partition("=")[2] for r in partitions.list_partitions(spark, table).collect()]
    opened = spark.table(quoted(table)).where(F.col("valid_to") == OPEN).agg(F.max("valid_from")).first()[0]
    return max([d for d in gone if d != OPEN] + [opened or ""]) or None


def _value(f: T.StructField) -> Column:
    """The column in a form by which equal values are grouped: -0.0 as 0.0, maps by their sorted entries."""
    column = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(column))).alias(f.name)
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0)).cast(f.dataType).alias(f.name)
    return column


def intervals(held: DataFrame, df: DataFrame, day: str) -> DataFrame:
    """What the partitions ``OPEN`` and ``day`` hold once the frame is the snapshot of the day."""
    schema = T.StructType([f for f in held.schema if f.name.lower() not in INTERVAL])
    values = [_value(f) for f in schema]
    none = F.lit(0).cast("long")
    # as the days before have left it: rows gone on this day are open again, rows come on it were not there
    before = held.where(F.col("valid_to").isin(OPEN, day) & (F.col("valid_from") < day))
    before = before.select(*values, F.col("copies").alias("_then"), none.alias("_now"), F.to_date("valid_from").alias("_since"))
    now = drift.in_table_order(drift.fill_missing_columns(df, schema), schema)
    now = now.select(*values, none.alias("_then"), F.lit(1).cast("long").alias("_now"), F.lit(None).cast("date").alias("_since"))
    # the day as DATE: a text's maximum would sort the rows instead of hashing them
    both = before.unionByName(now).groupBy(*[f"`{n}`" for n in schema.names]).agg(
        F.sum("_then").alias("_then"), F.sum("_now").alias("_now"), F.max("_since").cast("string").alias("_since")
    )

    def interval(copies: str, since: Column, until: str) -> Column:
        return F.struct(F.col(copies).alias("copies"), since.alias("valid_from"), F.lit(until).alias("valid_to"))

    same = F.col("_then") == F.col("_now")
    gone = F.when((F.col("_then") > 0) & ~same, interval("_then", F.col("_since"), day))
    there = F.when(F.col("_now") > 0, interval("_now", F.when(same, F.col("_since")).otherwise(F.lit(day)), OPEN))
    names = [F.col(f"`{n}`") for n in schema.names]
    found = both.select(*names, F.explode(F.array_compact(F.array(gone, there))).alias("_interval"))
    return found.select(*names, *[F.col(f"_interval.{c}").alias(c) for c in INTERVAL])


def file_snapshot(df: DataFrame, table: str, day: str, *, fmt: str = "parquet") -> DataFrame:
    """Make the history say that on ``day`` the snapshot is exactly the frame's rows.

    Days are filed in order; the last one may be filed again, an earlier one is refused, for later intervals rest on it.  A
    day left out is as the day before it.  The table is created if missing; columns it lacks are refused, those the frame
    lacks are empty text or NULL.  Text is kept as it is.
    """
    spark = df.sparkSession
    check_day(day)
    if not warehouse.table_exists(spark, table):
        _create(df, table, fmt)
    held = spark.table(quoted(table))
    last = _last_day(spark, table)
    if last is not None and day < last:
        raise ValueError(f"{table} holds changes of {last}: {day} can no longer be filed")
    unknown = drift.new_columns(df, held.schema)
    if unknown:
        raise ValueError(f"{table} has no columns {unknown}")
    rows = intervals(held, df, day)
    _overwrite(drift.in_table_order(rows, held.schema), table, day)
    return spark.table(quoted(table))


def _overwrite(rows: DataFrame, table: str, day: str) -> None:
    """Replace the partitions ``OPEN`` and ``day``; one left without rows is dropped."""
    spark = rows.sparkSession
    seen = Observation()
    observed = rows.hint("rebalance", "valid_to").observe(seen, F.collect_set("valid_to").alias("filled"))
    settings = {"spark.sql.sources.partitionOverwriteMode": "dynamic"} | warehouse.merging(by_day=True)
    with session_settings(spark, settings):
        # a dynamic overwrite may read the partitions it replaces: their files go at commit, not before
        observed.write.mode("overwrite").insertInto(quoted(table))
    emptied = {OPEN, day} - set(seen.get["filled"])
    partitions.drop_named(spark, table, [f"valid_to={d}" for d in sorted(emptied)])


def as_of(spark: SparkSession, table: str, day: str) -> DataFrame:
    """The snapshot of a day: the rows whose interval holds it, each as often as it was there.

    No shuffle; partitions of rows gone by then are not read.  Days before the first are empty, later ones as the last.
    """
    check_day(day)
    held = spark.table(quoted(table))
    names = [F.col(f"`{c}`") for c in held.columns if c.lower() not in INTERVAL]
    rows = held.where((F.col("valid_to") > day) & (F.col("valid_from") <= day))
    # in stretches, so that no task holds an array as long as the number of copies
    starts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_REPEATED_AT_ONCE).cast("long"))
    stretches = rows.select(*names, "copies", F.explode(starts).alias("_start"))
    length = F.least(F.col("copies") - F.col("_start"), F.lit(_REPEATED_AT_ONCE)).cast("int")
    return stretches.select(*names, F.explode(F.array_repeat(F.lit(True), length)).alias("_copy")).select(*names)
