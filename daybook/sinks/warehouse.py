"""Warehouse tables: replacing days, ranges and whole tables.

Days are replaced with a dynamic partition overwrite: new files appear and old ones
go when the job commits, so a run that fails half way leaves the old day readable.
A day that receives no rows is dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import dates
from daybook.model import SaveMode, check_day, check_range, days_between
from daybook.operators import drift, partitions
from daybook.operators.frames import clean_text
from daybook.session import quoted, session_settings, staged
from daybook.sinks import locations

EVOLVE = "evolve"  # new columns are added to the table
DROP_NEW = "drop"  # new columns are left out


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(quoted(table))


def sized(df: DataFrame, by_day: bool) -> DataFrame:
    """Even out the files to write.

    A day's rows are usually a few from each of many scan tasks; rebalancing merges them
    to the advisory partition size, and splits a day that is much larger than that.
    """
    return df.hint("rebalance", "dt") if by_day else df.hint("rebalance")


def merging(by_day: bool) -> dict[str, str]:
    """How far rebalanced partitions are merged into write tasks.

    Hashed by day, each day is in one partition unless it is hot, so spreading them over
    all cores costs no files.  Without a key, every task makes a file: merge to full size.
    """
    prefix = "spark.sql.adaptive.coalescePartitions"
    if by_day:
        return {f"{prefix}.parallelismFirst": "true", f"{prefix}.minPartitionSize": "64k"}
    return {f"{prefix}.parallelismFirst": "false"}


def _create_by_day(df: DataFrame, table: str, fmt: str) -> None:
    """An empty table of the frame's columns and comments, partitioned by ``dt``."""

    def column(field: T.StructField) -> T.StructField:
        comment = field.metadata.get("comment", "").replace("\\", r"\\")  # toDDL leaves them
        metadata = {"comment": comment} if comment else {}
        return T.StructField(field.name, field.dataType, metadata=metadata)

    columns = T.StructType([column(f) for f in df.schema]).toDDL()
    df.sparkSession.sql(f"CREATE TABLE {quoted(table)} ({columns}) USING {fmt} PARTITIONED BY (dt)")


def _reconciled(df: DataFrame, table: str, on_new: str) -> DataFrame:
    spark = df.sparkSession
    if not partitions.has_day_partitions_only(spark, table):
        raise ValueError(f"{table} is not partitioned by dt alone")
    if isinstance(dates.type_of(spark.table(quoted(table)), "dt"), (T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{table} is partitioned by times; dt must be a day, as text or DATE")
    if on_new == EVOLVE:
        drift.add_new_columns(df, table)
    elif on_new != DROP_NEW:
        raise ValueError(f"on_new must be {EVOLVE!r} or {DROP_NEW!r}, not {on_new!r}")
    schema = spark.table(quoted(table)).schema
    return drift.in_table_order(drift.fill_missing_columns(df, schema), schema)


def overwrite_days(df: DataFrame, table: str, days: Sequence[str]) -> None:
    """Make the table's partitions of ``days`` hold exactly the frame's rows.

    The frame must have the table's columns in order and no other days; ``NO_DAY`` stands
    for rows without one.  The days that got rows are observed by the write itself, so
    nothing is counted beforehand.
    """
    spark = df.sparkSession
    seen = Observation()
    day = F.coalesce(F.col("dt").cast("string"), F.lit(partitions.NO_DAY))
    observed = df.observe(seen, F.collect_set(day).alias("days"))
    dynamic = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
    with session_settings(spark, dynamic | merging(by_day=len(days) > 1)):
        observed.write.mode("overwrite").insertInto(quoted(table))
    partitions.drop_listed_days(spark, table, sorted(set(days) - set(seen.get["days"])))


def _replace(
    df: DataFrame,
    table: str,
    wanted: Column,
    days: Sequence[str],
    fmt: str,
    on_new: str,
    comments: Mapping[str, str] | None,
    rebalance: bool,
) -> DataFrame:
    spark = df.sparkSession
    if isinstance(dates.type_of(df, "dt"), (T.TimestampType, T.TimestampNTZType)):
        raise ValueError("dt must be a day, as text or DATE, not a time")
    if not table_exists(spark, table):
        _create_by_day(drift.with_comments(df, comments) if comments else df, table, fmt)
    rows = _reconciled(df.where(wanted), table, on_new)
    rows = sized(rows, by_day=len(days) > 1) if rebalance else rows
    overwrite_days(rows, table, days)
    return spark.table(quoted(table))


def _among(df: DataFrame, days: Sequence[str]) -> Column:
    # times are refused further on, where the table is known
    if isinstance(dates.type_of(df, "dt"), (T.StringType, T.DateType)):
        return dates.in_day_list(df, days)
    return F.col("dt").cast("string").isin(list(days))


def replace_day(
    df: DataFrame,
    table: str,
    day: str,
    *,
    fmt: str = "parquet",
    on_new: str = EVOLVE,
    comments: Mapping[str, str] | None = None,
    clean: bool = True,
    rebalance: bool = True,
) -> DataFrame:
    """Replace one day by the frame's rows of that day; rows of other days are left out.

    Line breaks are stripped from text.  Columns only the frame has are added to the
    table as STRING (or left out with ``on_new="drop"``); columns only the table has are
    filled with empty text, or NULL where they are not text.  The table is created if
    missing, with the given column comments.
    """
    return replace_days(
        df,
        table,
        [day],
        fmt=fmt,
        on_new=on_new,
        comments=comments,
        clean=clean,
        rebalance=rebalance,
    )


def replace_days(
    df: DataFrame,
    table: str,
    days: Sequence[str],
    *,
    fmt: str = "parquet",
    on_new: str = EVOLVE,
    comments: Mapping[str, str] | None = None,
    clean: bool = True,
    rebalance: bool = True,
) -> DataFrame:
    """Replace several days in one write, as :func:`replace_day` would one by one."""
    days = sorted({check_day(d) for d in days})
    if not days:
        return df.sparkSession.table(quoted(table))
    wanted = _among(df, days)  # exactly these days: no text in between
    df = clean_text(df, skip=["dt"]) if clean else df  # the day's filter must reach the scan
    return _replace(df, table, wanted, days, fmt, on_new, comments, rebalance)


def replace_range(
    df: DataFrame,
    table: str,
    dt: str,
    dt1: str,
    *,
    fmt: str = "parquet",
    on_new: str = DROP_NEW,
    clean: bool = True,
    rebalance: bool = True,
    batch: str | None = None,
) -> DataFrame:
    """Replace a day range by rows that carry their own ``dt``; by default new columns are
    left out.  Rows of other days, and of none, are kept as well: they are appended, once for
    each ``batch`` id (the range, unless given), so that a range can be loaded again."""
    spark = df.sparkSession
    dt, dt1 = check_range(dt, dt1)
    df = clean_text(df, skip=["dt"]) if clean else df
    inside = F.coalesce(_among(df, days_between(dt, dt1)), F.lit(False))
    seen = Observation()
    df = df.observe(seen, F.count_if(~inside).alias("outside"))
    days = days_between(dt, dt1)
    result = _replace(df, table, inside, days, fmt, on_new, None, rebalance)
    batch = batch or f"{dt}.{dt1}"
    if seen.get["outside"] or locations.holds_batch(spark, table, batch):
        rows = _reconciled(df.where(~inside), table, on_new)
        rows = sized(rows, by_day=True) if rebalance else rows
        locations.append_once(rows, table, batch)
    return result


def append_once(
    df: DataFrame, table: str, batch: str, *, fmt: str = "parquet", on_new: str = EVOLVE, clean: bool = True
) -> DataFrame:
    """Append rows that carry their own ``dt`` to a table by day; of one ``batch`` id they are there once,
    however often it is run.  The table is created if missing."""
    spark = df.sparkSession
    df = clean_text(df, skip=["dt"]) if clean else df
    if not table_exists(spark, table):
        _create_by_day(df, table, fmt)
    locations.append_once(sized(_reconciled(df, table, on_new), by_day=True), table, batch)
    return spark.table(quoted(table))


def replace_table(
    df: DataFrame,
    table: str,
    *,
    fmt: str = "parquet",
    partition_by_day: bool = False,
    comments: Mapping[str, str] | None = None,
    clean: bool = True,
) -> DataFrame:
    """Replace the whole table, columns included.  Files follow the scan's splits: no shuffle.

    The old table stays readable until the new one is written, and keeps its comment and
    properties: an unpartitioned managed table is written beside it and takes its name; one
    partitioned by ``dt`` alone, of the same columns, gets its partitions replaced at commit; an
    external one of the same columns gets new locations.  Other tables (of other columns or
    partitioning) are overwritten by Spark, which drops the old one first, but only once the new rows
    have been written to the shared folder: a failure to compute them leaves the old ones.
    """
    spark = df.sparkSession
    df = clean_text(df) if clean else df
    df = drift.with_comments(df, comments) if comments else df
    if table_exists(spark, table):
        held = partitions.described(spark, table)
        by = [c.lower() for c in held.get("partition_columns", [])]
        if held.get("type") == "MANAGED" and not by and not partition_by_day:
            replace_by_name(df, table, fmt)
            return spark.table(quoted(table))
        if by == ["dt"] and partition_by_day and held.get("provider") == fmt and _same_columns(df, table):
            _replace_partitions(df, table)
            return spark.table(quoted(table))
        if held.get("provider") == fmt and by == (["dt"] if partition_by_day else []) and _same_columns(df, table):
            locations.swap(df, table)
            return spark.table(quoted(table))
        with staged(df) as rows:
            _overwrite(_described_as(rows, df.schema), table, fmt, partition_by_day)
    else:
        _overwrite(df, table, fmt, partition_by_day)
    return spark.table(quoted(table))


def _overwrite(df: DataFrame, table: str, fmt: str, partition_by_day: bool) -> None:
    writer = df.write.format(fmt).mode("overwrite")
    writer = writer.partitionBy("dt") if partition_by_day else writer
    writer.saveAsTable(quoted(table))


def _same_columns(df: DataFrame, table: str) -> bool:
    def kinds(schema: T.StructType) -> dict:
        return {f.name.lower(): (f.dataType.simpleString(), f.metadata.get("comment", "")) for f in schema}

    return kinds(df.schema) == kinds(df.sparkSession.table(quoted(table)).schema)


def _replace_partitions(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    held = [r["partition"] for r in partitions.list_partitions(spark, table).collect()]
    seen = Observation()
    day = F.coalesce(F.col("dt").cast("string"), F.lit(partitions.NO_DAY))
    rows = drift.in_table_order(df, spark.table(quoted(table)).schema)
    observed = rows.observe(seen, F.collect_set(day).alias("days"))
    with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        observed.write.mode("overwrite").insertInto(quoted(table))
    filled = set(seen.get["days"])
    partitions.drop_named(spark, table, [n for n in held if unquote(n).partition("=")[2] not in filled])


def replace_by_name(df: DataFrame, table: str, fmt: str) -> None:
    """Write the frame as a table beside an unpartitioned one and let it take the name, the
    comment and the properties; if that fails, the old table has its name again."""
    spark = df.sparkSession
    held = partitions.described(spark, table)
    df = _described_as(df, spark.table(quoted(table)).schema)
    tag = uuid.uuid4().hex[:12]
    fresh, old = f"{table}__new_{tag}", f"{table}__old_{tag}"
    try:
        df.write.format(fmt).saveAsTable(quoted(fresh))
        for key, value in held.get("table_properties", {}).items():
            spark.sql(f"ALTER TABLE {quoted(fresh)} SET TBLPROPERTIES ({_text(key)} = {_text(value)})")
        if held.get("comment"):
            spark.sql(f"COMMENT ON TABLE {quoted(fresh)} IS {_text(held['comment'])}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(fresh)}")
        raise
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(old)}")
    try:
        spark.sql(f"ALTER TABLE {quoted(fresh)} RENAME TO {quoted(table)}")
    except Exception:
        spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(table)}")
        spark.sql(f"DROP TABLE IF EXISTS {quoted(fresh)}")
        raise
    spark.sql(f"DROP TABLE {quoted(old)}")


def _described_as(df: DataFrame, old: T.StructType) -> DataFrame:
    """The frame with the old columns' comments and defaults, but for comments that it brings itself."""
    kept = {
        f.name.lower(): {k: v for k, v in f.metadata.items() if k in ("comment", "CURRENT_DEFAULT", "EXISTS_DEFAULT")}
        for f in old
    }

    def column(field: T.StructField) -> Column:
        own = {k: v for k, v in field.metadata.items() if k != "comment" or v}
        return F.col(f"`{field.name}`").alias(field.name, metadata=kept.get(field.name.lower(), {}) | own)

    return df.select([column(f) for f in df.schema])


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_if_absent(
    df: DataFrame, table: str, day: str | None = None, *, fmt: str = "parquet", **options
) -> DataFrame:
    """Write only where there is no data yet: no table or, given a day, no partition of it.

    Line breaks are stripped from text either way, unless ``clean`` is false.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        if day is None:
            rows = clean_text(df) if options.get("clean", True) else df
            rows.write.format(fmt).saveAsTable(quoted(table))
        else:
            replace_day(df, table, day, fmt=fmt, **options)
    elif day is not None and not partitions.partition_exists(spark, table, day):
        replace_day(df, table, day, fmt=fmt, **options)
    return spark.table(quoted(table))


def write_by_mode(
    df: DataFrame, table: str, mode: SaveMode, day: str, *, fmt: str = "parquet", **options
) -> DataFrame:
    """The table sink chosen by save mode; only rows of the day are written in every mode."""
    if mode is SaveMode.OVERWRITE_DAY:
        return replace_day(df, table, day, fmt=fmt, **options)
    if mode is SaveMode.IGNORE:
        return write_if_absent(df, table, day, fmt=fmt, **options)
    rows = df.where(_among(df, [check_day(day)]))
    return replace_table(rows, table, fmt=fmt, partition_by_day=True, **options)


def replace_days_with_snapshot(
    df: DataFrame, table: str, dt: str, dt1: str, *, fmt: str = "parquet"
) -> DataFrame:
    """File the same whole snapshot under every day of a range, in one write.

    Rows are cleaned once and then repeated; every task holds an even share of every day,
    so the write needs no shuffle.
    """
    days = days_between(dt, dt1)
    every_day = F.explode(F.array(*[F.lit(d) for d in days]))
    stamped = clean_text(df.drop("dt")).withColumn("dt", every_day)
    return replace_days(stamped, table, days, fmt=fmt, clean=False, rebalance=False)
