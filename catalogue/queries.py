"""Queries by key.  Each takes a session and a folder of parquet tables.

Sink queries write into a fresh database in the shared folder and return the table as
read back.  Times are returned as text so that both engines show them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import workbooks
from daybook.functions import dates, text
from daybook.model import LoadStrategy, SaveMode
from daybook.operators import changes, drift, frames, partitions, summaries
from daybook.plans import export, load
from daybook.session import new_database, new_path, quoted
from daybook.sinks import files as file_sinks
from daybook.sinks import history, locations
from daybook.sinks import upsert as upsert_sink
from daybook.sinks import warehouse, widening
from daybook.sources import extract
from daybook.sources import files as file_sources
from daybook.sources import splits, worksheets
from daybook.streaming import days as days_stream

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-15"
RUN_TIME = "2024-02-01 03:00:00"
EVENT = ["event_id", "user_id", "event_type", "value", "props"]

_QUERIES: dict[str, Query] = {}
_LEFT: dict[str, list[str]] = {}  # databases that a query's last run has left behind


def _query(run: Query) -> Query:
    @wraps(run)
    def tidy(spark: SparkSession, sf: str) -> DataFrame:
        # results are read lazily, so a run's databases go when the query runs again
        for database in _LEFT.pop(run.__name__, []):
            spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
        before = _databases(spark)
        result = run(spark, sf)
        _LEFT[run.__name__] = sorted(_databases(spark) - before)
        return result

    _QUERIES[run.__name__] = tidy
    return tidy


def _databases(spark: SparkSession) -> set[str]:
    return {r["namespace"] for r in spark.sql("SHOW DATABASES LIKE 'daybook_*'").collect()}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- inputs ------------------------------------------------------------------------------


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return file_sources.parquet_reader(spark, sf)(table)


def _time_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def _second_text(name: str) -> Column:
    return F.date_format(name, dates.TIME_FORMAT)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events filed under their own day."""
    events = _read(spark, sf, "events")
    return events.withColumn("dt", dates.day_text(events, "ts"))


def _events_table(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> str:
    table = f"{new_database(spark)}.events"
    rows = _events(spark, sf) if rows is None else rows
    warehouse.replace_days(rows, table, _days(rows))
    return table


def _days(rows: DataFrame) -> list[str]:
    """The days that a frame's rows are filed under; calendar days only."""
    found = rows.select(F.col("dt").cast("string").alias("dt")).distinct().collect()
    return sorted(r["dt"] for r in found if r["dt"] is not None)


def _with_update_time(events: DataFrame) -> DataFrame:
    """Events with a later update time, up to three days on."""
    hours = F.make_dt_interval(hours=(F.col("event_id") % 72).cast("int"))
    return events.withColumn("updated", F.col("ts") + hours)


def _as_text(df: DataFrame, name: str) -> DataFrame:
    """An integer column with NULLs as text, which both engines hand out alike."""
    return df.withColumn(name, F.col(name).cast("string"))


def _mixed_day_text(c: str) -> Column:
    """The event's time in three formats, by its type."""
    day = F.to_date(c)
    return (
        F.when(F.col("event_type").isin("click", "error"), F.date_format(day, "yyyyMMdd"))
        .when(F.col("event_type") == "view", day.cast("string"))
        .otherwise(_second_text(c))
    )


def _dirty_time_text() -> Column:
    """The event's time as text; unreadable, impossible, or missing for some."""
    return (
        F.when(F.col("user_id") % 11 == 0, F.lit(None))
        .when(F.col("event_type") == "error", F.concat(_second_text("ts"), F.lit(" +")))
        .when(F.col("event_type") == "view", F.regexp_replace(_second_text("ts"), "-01-", "-13-"))
        .otherwise(_second_text("ts"))
    )


# -- sources -----------------------------------------------------------------------------


@_query
def load_all(spark: SparkSession, sf: str) -> DataFrame:
    read = file_sources.parquet_reader(spark, sf)
    return load.load_tables(read, new_database(spark), "customer", DAY)["customer"]


@_query
def split_by_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Every line with the number of splits that it is in, on a column of which one value and NULL hold many rows."""
    lines = _read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).when(F.col("l_orderkey") % 10 != 1, F.col("l_partkey")).alias("l_key"),
    )
    conditions = splits.quantile_splits(lines, "l_key", 16, "l_orderkey")
    inside = [F.coalesce(F.expr(c).cast("int"), F.lit(0)) for c in conditions]
    sizes = lines.agg(*[F.sum(i) for i in inside]).first()
    even = max(sizes) <= 1.5 * sum(sizes) / 16
    counted = lines.withColumn("n_splits", reduce(add, inside))
    return _as_text(counted, "l_key").withColumn("even", F.lit(even))


@_query
def load_new(spark: SparkSession, sf: str) -> DataFrame:
    loaded = load.load_tables(
        file_sources.parquet_reader(spark, sf),
        new_database(spark),
        "orders",
        "1996-09-01",
        "1996-09-30",
        created="o_orderdate",
    )["orders"]
    return loaded.withColumn("o_orderdate", _second_text("o_orderdate"))


@_query
def load_new_and_change(spark: SparkSession, sf: str) -> DataFrame:
    # The two times are in two tables: a branch for each, so that both scans are given its days.
    week = ("1998-10-01", "1998-10-07")
    orders, lines = _read(spark, sf, "orders"), _read(spark, sf, "lineitem")
    of_order = F.col("l_orderkey") == F.col("o_orderkey")
    is_new = dates.in_days(orders, "o_orderdate", *week)
    created = lines.join(orders.where(is_new), of_order)
    earlier = orders.where(~is_new | F.col("o_orderdate").isNull())
    updated = extract.new_rows(lines, "l_shipdate", *week).join(earlier, of_order)
    rows = extract.incremental(
        created.unionByName(updated),
        LoadStrategy.NEW_AND_CHANGE,
        *week,
        created="o_orderdate",
        updated="l_shipdate",
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "o_custkey",
        "l_extendedprice",
        _second_text("o_orderdate").alias("o_orderdate"),
        _second_text("l_shipdate").alias("l_shipdate"),
        "dt",
    )


@_query
def load_new_closed_second(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract.incremental(
        _read(spark, sf, "events"),
        LoadStrategy.NEW,
        "2024-01-03",
        "2024-01-28",
        created="ts",
        to_second=True,
    )
    return rows.select(*EVENT, _time_text("ts"), "dt")


@_query
def load_new_iso_text(spark: SparkSession, sf: str) -> DataFrame:
    events = _read(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    written = F.when(F.col("event_id") % 5 == 0, F.lit("unknown")).otherwise(iso)
    rows = extract.incremental(
        events.withColumn("created", written).select("event_id", "created", "value"),
        LoadStrategy.NEW,
        "2024-01-03",
        "2024-01-09",
        created="created",
        to_second=True,
    )
    return rows


@_query
def load_new_and_change_closed_second(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract.incremental(
        _with_update_time(_read(spark, sf, "events")),
        LoadStrategy.NEW_AND_CHANGE,
        DAY,
        created="ts",
        updated="updated",
        to_second=True,
    )
    return rows.select(*EVENT, _time_text("ts"), _time_text("updated"), "dt")


@_query
def load_range_derive_dt(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{new_database(spark)}.events"
    events = _read(spark, sf, "events")
    load.load_range(events, table, "ts", "2024-01-05", "2024-01-08")
    loaded = load.load_range(events, table, "ts", "2024-01-07", "2024-01-11")
    return loaded.select(*EVENT, _time_text("ts"), "dt")


@_query
def scan_by_dt(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    rows = extract.rows_of_day(spark.table(quoted(table)), DAY)
    return rows.select(*EVENT, _time_text("ts"), "dt")


@_query
def range_project_allowlist(spark: SparkSession, sf: str) -> DataFrame:
    customers = _read(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    suppliers = _read(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    allowed = customers.select(F.col("c_custkey").alias("institution")).union(
        suppliers.select("s_suppkey")
    )
    rows = load.allowed_rows(
        _read(spark, sf, "events"),
        "ts",
        "2024-01-05",
        "2024-01-20",
        ["event_id", "user_id", "event_type", "value"],
        allowed,
        match="user_id",
        key="institution",
    )
    return rows


@_query
def csv_all_string_load(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "customers-csv")
    customers = _read(spark, sf, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    )
    file_sinks.export_csv(customers, path, nullValue=r"\N")
    return file_sources.read_csv(spark, path, "key,name,nation,balance,segment")


@_query
def xlsx_all_string_load(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows as the CSV load, from workbooks of up to 2,000 customers; balances are text there, since a number
    cell holds no trailing zero."""
    customers = _read(spark, sf, "customer").withColumns(
        {"c_mktsegment": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")), "c_acctbal": F.col("c_acctbal").cast("string")}
    )
    books = workbooks.made_from(customers, 2000)
    return worksheets.parse(books, ["key", "name", "nation", "balance", "segment"])


# -- predicates, days and times ------------------------------------------------------------


@_query
def cn_date_to_dt(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("ts")
    year, month, dom = F.year(day), F.month(day), F.day(day)
    written = (
        F.when(
            F.col("event_type") == "click",
            F.concat(year, F.lit("年"), month, F.lit("月"), dom, F.lit("日")),
        )
        .when(F.col("event_type") == "view", F.concat_ws("|", year, month, dom))
        .when(F.col("event_type") == "error", F.col("props"))
        .otherwise(_second_text("ts"))
    )
    rows = _read(spark, sf, "events").withColumn("fill_in_time", written)
    return rows.select(
        "event_id", "fill_in_time", dates.day_of_chinese_text("fill_in_time").alias("dt")
    )


@_query
def multi_format_day_match(spark: SparkSession, sf: str) -> DataFrame:
    rows = _read(spark, sf, "events").withColumn("month", _mixed_day_text("ts"))
    found = rows.where(dates.matches_day("month", DAY))
    return frames.stamp_day(found.select("event_id", "month", "value"), DAY, first=True)


@_query
def load_mixed_day_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = _read(spark, sf, "events").withColumn("month", _mixed_day_text("ts"))
    table = f"{new_database(spark)}.events"
    loaded = load.load_mixed_days(
        rows.select("event_id", "month", "value"), table, "month", "2024-01-10", "2024-01-20"
    )
    return loaded


@_query
def day_range(spark: SparkSession, sf: str) -> DataFrame:
    orders = _read(spark, sf, "orders")
    per_day = orders.groupBy(dates.day_text(orders, "o_orderdate").alias("dt")).agg(
        F.count(F.lit(1)).alias("n")
    )
    span = orders.agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    days = span.select(F.explode(dates.days_column(F.col("low"), F.col("high"))).alias("dt"))
    return days.join(per_day, "dt", "left").select("dt", F.coalesce("n", F.lit(0)).alias("n"))


@_query
def text_to_epoch_ms(spark: SparkSession, sf: str) -> DataFrame:
    rows = _read(spark, sf, "events").withColumn("t", _dirty_time_text())
    return rows.select("event_id", dates.text_to_epoch_ms("t").alias("ms"))


@_query
def text_to_epoch_ms_lenient(spark: SparkSession, sf: str) -> DataFrame:
    written = (
        F.when(F.col("event_id") % 7 == 0, F.lit("99999999-01-01 00:00:00"))
        .when(F.col("event_id") % 7 == 1, F.lit("2024-999999999-01 00:00:00"))
        .when(F.col("event_id") % 7 == 2, F.concat(_second_text("ts"), F.lit(".5")))
        .when(F.col("event_id") % 7 == 3, F.date_format("ts", "yyyy-M-d H:m:s"))
        .otherwise(_second_text("ts"))
    )
    rows = _read(spark, sf, "events").withColumn("t", written)
    return rows.select("event_id", dates.text_to_epoch_ms("t", lenient=True).alias("ms"))


@_query
def epoch_ms_to_text(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    ms = (seconds + F.hour("ts") * 3600 + F.minute("ts") * 60) * 1000 + F.col("event_id") % 60000
    rows = _read(spark, sf, "events").withColumn("ms", ms)
    return rows.select("event_id", "ms", dates.epoch_ms_to_text("ms").alias("t"))


@_query
def shift_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = _read(spark, sf, "events").withColumn("t", _dirty_time_text())
    return rows.select(
        "event_id",
        dates.back_quarter_hour("t").alias("back_quarter"),
        dates.next_quarter_hour("t").alias("next_quarter"),
        dates.back_hour("t").alias("back_hour"),
        dates.back_day("t").alias("back_day"),
        dates.back_week("t").alias("back_week"),
    )


@_query
def is_valid_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    rows = _read(spark, sf, "events").withColumn("t", _dirty_time_text())
    return rows.select("event_id", "t", dates.is_valid_time("t").cast("int").alias("valid"))


@_query
def iso_weekday(spark: SparkSession, sf: str) -> DataFrame:
    weekday = dates.iso_weekday("o_orderdate").cast("bigint").alias("weekday")
    return _read(spark, sf, "orders").select("o_orderkey", weekday)


@_query
def tumbling_window_start(spark: SparkSession, sf: str) -> DataFrame:
    start = dates.window_start("ts", "1 day", "-8 hours").alias("start")
    rows = _read(spark, sf, "events").select("event_id", start)
    return rows.select("event_id", _second_text("start").alias("window_start"))


@_query
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Six-hour windows kept up from a stream of files: two of events in time, then late ones, over three runs."""
    database, place = new_database(spark), new_path(spark, "landing")
    table, summary = f"{database}.events", f"{database}.windows"
    events = _read(spark, sf, "events")
    late = (F.col("event_id") % 7 == 0) | (F.col("event_type") == "error")
    early = F.col("ts") < F.lit(DAY).cast("timestamp_ntz")
    totals = {"total": F.sum("value"), "last_id": F.max("event_id")}
    on_days = days_stream.summarise_days(table, summary, "ts", "6 hours", ["event_type"], totals, spark=spark)
    for part in (~late & early, ~late & ~early, late):
        events.where(part).write.mode("append").parquet(place)
        rows = spark.readStream.schema(events.schema).parquet(place)
        days_stream.follow(rows, table, "ts", f"{place}-checkpoint", on_days=on_days).awaitTermination()
    loaded = spark.table(quoted(summary))
    return loaded.select("dt", _second_text("window_start").alias("window_start"), "event_type", "n", "total", "last_id")


# -- cleaning and combining ----------------------------------------------------------------


@_query
def strip_newlines(spark: SparkSession, sf: str) -> DataFrame:
    documents = _read(spark, sf, "documents")
    marked = documents.withColumn("text", F.concat("text", F.lit("\r\n"), "lang"))
    return frames.clean_text(marked.select("doc_id", "text", "source", "n_chars"))


@_query
def strip_newlines_pages(spark: SparkSession, sf: str) -> DataFrame:
    return frames.clean_text(_read(spark, sf, "pages"))


@_query
def blank_to_null(spark: SparkSession, sf: str) -> DataFrame:
    orders = _read(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit(" \t"))
        .when(F.col("o_orderstatus") == "P", F.lit("null"))
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
        "o_orderpriority",
    )
    return frames.blanks_to_null(orders)


@_query
def strip_last_suffix(spark: SparkSession, sf: str) -> DataFrame:
    index = F.concat_ws("_", F.lit("log"), "event_type", F.date_format("ts", "yyyy"))
    typed = F.when(F.col("event_type") == "view", F.concat(index, F.lit(":_docx"))).otherwise(index)
    rows = _read(spark, sf, "events").withColumn("index", typed)
    return rows.select("event_id", "index", text.strip_last_suffix("index").alias("base"))


@_query
def export_stamped(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    rows = export.stamped_days(spark, table, "2024-01-10", "2024-01-12", RUN_TIME)
    return rows.select(*EVENT, _time_text("ts"), "dt", "last_update_time")


def _accounts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customers = _read(spark, sf, "customer").select(
        F.col("c_custkey").alias("col0"), F.col("c_nationkey").cast("bigint").alias("col1")
    )
    suppliers = _read(spark, sf, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("col1"), F.col("s_suppkey").alias("col0")
    )
    return customers, suppliers


@_query
def union_by_position(spark: SparkSession, sf: str) -> DataFrame:
    return frames.union_by_position(*_accounts(spark, sf))


@_query
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return frames.union_by_name(*_accounts(spark, sf))


# -- table sinks ---------------------------------------------------------------------------


def _stale(events: DataFrame) -> DataFrame:
    return events.withColumn("value", F.lit(-1.0))


@_query
def sink_replace_day(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    table = _events_table(spark, sf, _stale(events))
    for _ in range(2):
        warehouse.replace_day(events, table, DAY)
    return spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")


@_query
def sink_replace_day_date(spark: SparkSession, sf: str) -> DataFrame:
    by_date = lambda rows: rows.withColumn("dt", F.col("dt").cast("date"))
    events = by_date(_events(spark, sf))
    table = _events_table(spark, sf, _stale(events))
    for _ in range(2):
        warehouse.replace_days(events, table, [DAY, "2024-01-17"])
    rows = spark.table(quoted(table)).withColumn("dt", F.col("dt").cast("string"))
    return rows.select(*EVENT, _time_text("ts"), "dt")


@_query
def sink_replace_day_empty(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    nothing = _events(spark, sf).where(F.col("value") < 0)
    warehouse.replace_day(nothing, table, DAY)
    return spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")


@_query
def sink_replace_range(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    table = _events_table(spark, sf, _stale(events))
    changed = events.where(
        F.col("dt").between("2024-01-10", "2024-01-20") & (F.col("event_type") != "error")
    )
    for _ in range(2):
        warehouse.replace_range(changed, table, "2024-01-10", "2024-01-20")
    return spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")


@_query
def sink_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{new_database(spark)}.part"
    warehouse.replace_table(_read(spark, sf, "supplier"), table, fmt="orc")
    return warehouse.replace_table(_read(spark, sf, "part"), table, fmt="orc")


@_query
def sink_ignore_existing(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    table = _events_table(spark, sf, events.where(F.col("dt") != DAY))
    for rows in (events, _stale(events)):  # the second run finds both days filled
        for day in (DAY, "2024-01-16"):
            warehouse.write_by_mode(rows, table, SaveMode.IGNORE, day)
    return spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")


@_query
def snapshot_per_day(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{new_database(spark)}.supplier"
    return load.load_snapshot_per_day(
        _read(spark, sf, "supplier"), table, "2024-01-01", "2024-01-03"
    )


@_query
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as they stood on four days, from their intervals: they come on their day, close, and leave."""
    table = f"{new_database(spark)}.orders"
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    for n, day in enumerate(days):
        closed = (F.col("o_custkey") % 4 == n) & (F.col("o_orderkey") % 3 == 0)
        state = orders.where((F.col("o_orderkey") % 5 <= n + 2) & (F.col("o_orderkey") % 7 != n))
        state = state.withColumn("o_orderstatus", F.when(closed, F.lit("C")).otherwise(F.col("o_orderstatus")))
        history.file_snapshot(state.drop("o_custkey"), table, day)
    each = [history.as_of(spark, table, day).withColumn("dt", F.lit(day)) for day in days]
    return reduce(DataFrame.unionByName, each)


# -- schema drift --------------------------------------------------------------------------


@_query
def evolve_add_columns(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    wider = _events(spark, sf).withColumn("Weekday", dates.iso_weekday("ts"))
    warehouse.replace_day(wider, table, DAY)
    rows = spark.table(quoted(table))
    return rows.select(*EVENT, F.col("Weekday").alias("weekday"), _time_text("ts"), "dt")


@_query
def evolve_widen_types(spark: SparkSession, sf: str) -> DataFrame:
    """Narrow columns that a later batch outgrows: an external table described anew, a managed one rewritten."""
    events = _events(spark, sf)
    narrow = events.select(
        F.col("event_id").cast("int").alias("event_id"),
        (F.col("user_id") * 1.25).cast("decimal(9,2)").alias("amount"),
        F.to_date("ts").alias("happened"),
        "dt",
    )
    wide = events.where(F.col("dt") == DAY).select(
        (F.col("event_id") + 2**40).alias("event_id"),
        (F.col("user_id") * 1.0625).cast("decimal(20,4)").alias("amount"),
        F.col("ts").cast("timestamp_ntz").alias("happened"),
        "dt",
    )
    external, managed = (f"{new_database(spark)}.{name}" for name in ("external", "managed"))
    place = new_path(spark, "external")
    columns = narrow.drop("happened").schema.toDDL()
    spark.sql(f"CREATE TABLE {quoted(external)} ({columns}) USING parquet PARTITIONED BY (dt) LOCATION '{place}'")
    warehouse.replace_days(narrow.drop("happened"), external, _days(narrow))
    widening.replace_days(wide.drop("happened"), external, [DAY])
    warehouse.replace_days(narrow, managed, _days(narrow))
    texts = wide.withColumn("event_id", F.concat(F.lit("e"), F.col("event_id")))
    widening.replace_days(texts, managed, [DAY])

    def shown(table: str, happened: Column) -> DataFrame:
        rows = spark.table(quoted(table))
        return rows.select(
            F.lit(table.rpartition(".")[2]).alias("kind"),
            F.col("event_id").cast("string").alias("event_id"),
            F.col("amount").cast("string").alias("amount"),
            happened.alias("happened"),
            "dt",
        )

    return shown(external, F.lit(None).cast("string")).union(shown(managed, _second_text("happened")))


@_query
def evolve_fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    narrower = _events(spark, sf).drop("props", "user_id")
    warehouse.replace_day(narrower, table, DAY)
    rows = spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")
    return _as_text(rows, "user_id")


@_query
def evolve_drop_new(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    rows = extract.rows_of_day(_events(spark, sf), DAY)
    wider = rows.withColumns({"note": F.lit("x"), "value": F.col("value") + 1})
    loaded = warehouse.replace_range(wider, table, DAY, DAY)
    return loaded.select(*[c for c in loaded.columns if c != "ts"], _time_text("ts"))


@_query
def column_comments(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{new_database(spark)}.customer"
    comments = {"c_custkey": "customer key", "c_acctbal": "account balance"}
    written = warehouse.replace_table(_read(spark, sf, "customer"), table, comments=comments)
    held = written.agg(*[F.count(c).alias(c) for c in written.columns])
    held = held.unpivot([], held.columns, "col_name", "n_values")
    described = spark.sql(f"DESCRIBE {quoted(table)}").select("col_name", "comment")
    return described.join(held, "col_name")


@_query
def align_to_target(spark: SparkSession, sf: str) -> DataFrame:
    target = _read(spark, sf, "customer").schema
    orders = _read(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("C_CUSTKEY"),
        F.col("o_totalprice").alias("C_AcctBal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        "o_orderkey",
    )
    return _as_text(drift.align_to_target(orders, target), "c_nationkey")


@_query
def schema_to_ddl(spark: SparkSession, sf: str) -> DataFrame:
    orders = drift.with_comments(_read(spark, sf, "orders"), {"o_orderkey": "the order's key"})
    stored = drift.to_relational(orders)
    lengths = stored.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in stored.columns])
    lengths = lengths.unpivot([], lengths.columns, "col_name", "longest")
    # each column's line of the statement that creates the table
    statement = drift.create_table_statement("orders", orders.schema)
    lines = F.transform(F.split(F.lit(statement), "\n"), lambda line: F.btrim(line, F.lit(" ,")))
    own = F.filter(lines, lambda line: line.startswith(F.concat(F.lit("`"), F.col("col_name"), F.lit("`"))))
    return lengths.select(
        "col_name", F.element_at(own, 1).alias("definition"), F.col("longest").cast("bigint").alias("longest")
    )


@_query
def relational_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = _read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    stored = drift.to_relational(lines)
    return stored.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


# -- changes -------------------------------------------------------------------------------


def _late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events filed under their day, created some days earlier or at an unknown time."""
    days_ago = F.make_dt_interval(days=(F.col("user_id") % 10).cast("int"))
    created = F.when(F.col("event_type") != "error", F.col("ts") - days_ago)
    return _events(spark, sf).withColumn("created", created)


@_query
def changed_days(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf, _late_events(spark, sf))
    return changes.changed_days(spark, table, "created", DAY)


def _changed_days_query(table: str) -> str:
    return (
        "SELECT date_format(created, 'yyyy-MM-dd') AS date "
        f"FROM {quoted(table)} WHERE dt = 'do_date' AND value > 50"
    )


@_query
def changed_days_by_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Days exported by the second and third run: those whose rows have changed since, then none."""
    table = _events_table(spark, sf)
    events = _events(spark, sf)
    target, state = (f"{new_database(spark)}.{name}" for name in ("events", "digests"))
    days = _days(events)
    exported = []
    for run in range(3):
        if run == 1:  # equal rows in other files and order, a day with another value, a day without rows
            again = events.repartition(3, "user_id").withColumn(
                "value", F.col("value") + F.when((F.col("dt") == DAY) & (F.col("event_type") == "error"), 1).otherwise(0)
            )
            warehouse.replace_days(again.where(F.col("dt") != days[-1]), table, days)
        found = export.export_changed_content(
            spark, table, lambda rows, days: warehouse.replace_days(rows, target, days), state, days[0], days[-1], run_time=RUN_TIME
        )
        exported += [(run + 1, d) for d in found if run]
    held = spark.table(quoted(target)).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
    runs = spark.createDataFrame(exported, "run int, dt string")
    return runs.join(held, "dt", "left").select("run", "dt", F.coalesce("n", F.lit(0)).alias("n"))


@_query
def changed_days_sql(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf, _late_events(spark, sf))
    return changes.changed_days_sql(spark, _changed_days_query(table), DAY)


@_query
def propagate_changed_days(spark: SparkSession, sf: str) -> DataFrame:
    source = _events_table(spark, sf, _late_events(spark, sf))
    target = f"{new_database(spark)}.exported"
    stale = frames.stamp_export_time(_stale(_events(spark, sf)), "2024-01-31 03:00:00")
    warehouse.replace_days(stale, target, _days(stale))
    export.export_changed_days(
        spark,
        source,
        lambda rows, days: warehouse.replace_days(rows, target, days, on_new=warehouse.DROP_NEW),
        DAY,
        run_time=RUN_TIME,
        changed_days_query=_changed_days_query(source),
    )
    return spark.table(quoted(target)).select(*EVENT, _time_text("ts"), "last_update_time", "dt")


@_query
def sink_swap_location(spark: SparkSession, sf: str) -> DataFrame:
    """An external table by day, replaced as a whole: other rows, a day less, a day more."""
    table = f"{new_database(spark)}.events"
    place = new_path(spark, "external")
    events = _events(spark, sf)
    events.where(F.col("event_type") != "error").write.partitionBy("dt").parquet(place)
    columns = events.schema.toDDL()
    spark.sql(f"CREATE TABLE {quoted(table)} ({columns}) USING parquet PARTITIONED BY (dt) LOCATION '{place}'")
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")
    later = events.where(F.col("dt") != DAY).withColumn("dt", F.date_add(F.to_date("dt"), 1).cast("string"))
    locations.swap(later, table)
    return spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")


@_query
def sink_replace_range_outside(spark: SparkSession, sf: str) -> DataFrame:
    """A range loaded twice: rows of days outside it are there once, as the second run has them."""
    events = _events(spark, sf)
    table = _events_table(spark, sf, events.where(F.col("event_type") == "view"))
    for add in (1, 2):
        late = events.where(F.col("event_type") == "click").withColumn("value", F.col("value") + add)
        warehouse.replace_range(late, table, DAY, "2024-01-18")
    return spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")


@_query
def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{new_database(spark)}.customer"
    warehouse.replace_table(_read(spark, sf, "customer"), table)
    batch = _read(spark, sf, "orders").select(
        (F.col("o_custkey") * 2).alias("C_CUSTKEY"),  # even keys; half of them are new
        F.when(F.col("o_orderstatus") == "P", F.lit(" "))
        .otherwise(F.col("o_orderpriority"))
        .alias("c_mktsegment"),
        F.col("o_totalprice").alias("c_acctbal"),
        "o_orderdate",
        "o_orderkey",
    )
    merged = upsert_sink.upsert(batch, table, ["c_custkey"], ["o_orderdate", "o_orderkey"])
    return _as_text(merged, "c_nationkey")


@_query
def upsert_blank_typed(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{new_database(spark)}.orders"
    orders = _read(spark, sf, "orders").select("o_orderkey", F.lit(7).alias("o_rank"), "o_orderdate")
    warehouse.replace_table(orders, table)
    blank = F.col("o_orderkey") % 3 == 0
    batch = orders.where(F.col("o_orderkey") % 2 == 0).select(
        "o_orderkey",
        F.when(blank, F.lit(" ")).otherwise(F.lit("9")).alias("o_rank"),
        F.when(blank, F.lit("\t")).otherwise(_second_text("o_orderdate")).alias("o_orderdate"),
    )
    merged = upsert_sink.upsert(batch, table, ["o_orderkey"], ["o_orderkey"])
    return _as_text(merged, "o_rank").withColumn("o_orderdate", _second_text("o_orderdate"))


@_query
def upsert_by_key_hours(spark: SparkSession, sf: str) -> DataFrame:
    table = f"{new_database(spark)}.events"
    hour = F.date_format("ts", "HH").alias("dh")
    events = _events(spark, sf).where(F.col("dt").between("2024-01-14", "2024-01-16"))
    events = events.select("event_id", "value", "dt", hour)
    spark.sql(
        f"CREATE TABLE {quoted(table)} (event_id BIGINT, value DOUBLE, dt STRING, dh STRING) "
        "USING parquet PARTITIONED BY (dt, dh)"
    )
    events.write.insertInto(quoted(table))
    # all of one hour moves to the next day, some of another changes
    moved = events.where((F.col("dt") == DAY) & (F.col("dh") == "05")).withColumn("dt", F.lit("2024-01-16"))
    changed = events.where((F.col("dt") == DAY) & (F.col("dh") == "07") & (F.col("event_id") % 2 == 0))
    batch = moved.unionByName(changed).withColumn("value", F.col("value") + 1)
    return upsert_sink.upsert(batch, table, ["event_id"], ["event_id"])


@_query
def upsert_by_key_days(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    moved = _events(spark, sf).where((F.col("dt") == DAY) | (F.col("event_type") == "error"))
    next_day = F.date_add(F.to_date("dt"), 1).cast("string")
    batch = moved.withColumns({"dt": next_day, "value": F.col("value") + 1})
    loaded = upsert_sink.upsert(batch, table, ["event_id"], ["ts"])
    return loaded.select(*EVENT, _time_text("ts"), "dt")


@_query
def upsert_pruned(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    events = _events(spark, sf)
    one_user = events.where(F.col("user_id") % 50 == 1).withColumn("value", F.col("value") + 1)
    upsert_sink.upsert(one_user, table, ["event_id"], ["ts"], key_filter=True)
    # by now every partition has a filter; some of a day's events move to the next day
    moved = events.where((F.col("dt") == DAY) & (F.col("event_type") == "error"))
    batch = moved.withColumns({"dt": F.date_add(F.to_date("dt"), 1).cast("string"), "value": F.lit(0.0)})
    loaded = upsert_sink.upsert(batch, table, ["event_id"], ["ts"], key_filter=True)
    return loaded.select(*EVENT, _time_text("ts"), "dt")


# -- summaries -----------------------------------------------------------------------------


@_query
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.word_count(_read(spark, sf, "documents"), "text")


@_query
def last_value_by_key(spark: SparkSession, sf: str) -> DataFrame:
    events = _read(spark, sf, "events")
    return summaries.last_value_by_key(events, "user_id", "event_type", "ts", "event_id")


# -- catalog -------------------------------------------------------------------------------


@_query
def drop_partition_range(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    partitions.drop_days(spark, table, "2024-01-05", "2024-01-10")
    return spark.table(quoted(table)).select(*EVENT, _time_text("ts"), "dt")


@_query
def drop_partition_range_long(spark: SparkSession, sf: str) -> DataFrame:
    database = new_database(spark)
    events = _events(spark, sf).withColumnRenamed("dt", "DT")
    events.write.partitionBy("DT").saveAsTable(quoted(f"{database}.events"))
    partitions.drop_days(spark, f"{database}.events", "2024-01-05", "2024-01-16")
    rows = spark.table(quoted(f"{database}.events"))
    return rows.select(*EVENT, _time_text("ts"), F.col("DT").alias("dt"))


@_query
def list_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return partitions.list_partitions(spark, _events_table(spark, sf))


@_query
def retention_clean(spark: SparkSession, sf: str) -> DataFrame:
    database = new_database(spark)
    events = _events(spark, sf)
    days = _days(events)
    for kind in ("click", "view"):
        rows = events.where(F.col("event_type") == kind)
        warehouse.replace_days(rows, f"{database}.{kind}s", days)
    warehouse.replace_table(events, f"{database}.unpartitioned")
    partitions.clean_days(spark, database, "all", days[0], "2024-01-12")
    left = [
        spark.table(quoted(f"{database}.{name}")).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("table_name"), "dt", "n")
        for name in ("clicks", "views", "unpartitioned")
    ]
    return left[0].union(left[1]).union(left[2])


@_query
def drop_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    database = new_database(spark)
    names = ["supplier", "part", "customer"]
    load.load_tables(file_sources.parquet_reader(spark, sf), database, names, DAY)
    listed = partitions.drop_all_tables(spark, database)  # dry run
    partitions.drop_all_tables(spark, database, confirm=True)
    left = set(partitions.tables_of(spark, database))
    each = [
        _read(spark, sf, name)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows", F.lit(int(name in left)).alias("left"))
        for name in listed
    ]
    return each[0].union(each[1]).union(each[2])


@_query
def multi_table_load(spark: SparkSession, sf: str) -> DataFrame:
    read = file_sources.parquet_reader(spark, sf)
    loaded = load.load_tables(
        read, new_database(spark), "supplier,part,customer", DAY, targets="vendor,,", prefix="ods_"
    )
    keys = {"ods_vendor": "s_suppkey", "ods_part": "p_partkey", "ods_customer": "c_custkey"}
    each = [
        loaded[name].select(F.lit(name).alias("table_name"), F.col(key).alias("key"), "dt")
        for name, key in keys.items()
    ]
    return each[0].union(each[1]).union(each[2])


# -- copies and files ----------------------------------------------------------------------


@_query
def copy_table(spark: SparkSession, sf: str) -> DataFrame:
    database = new_database(spark)

    def write(rows: DataFrame, table: str) -> None:
        warehouse.replace_table(rows, f"{database}.{table}", clean=False)

    load.copy_tables(file_sources.parquet_reader(spark, sf), write, "part,lineitem", prefix="copy_")
    copied = spark.table(quoted(f"{database}.copy_lineitem"))
    return copied.withColumn("l_shipdate", _second_text("l_shipdate"))


@_query
def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    table = _events_table(spark, sf)
    path = new_path(spark, "events-csv")
    schema = "event_id bigint, user_id bigint, event_type string, value double, props string, dt string"
    for day in ("2024-01-10", "2024-01-11", "2024-01-12"):
        rows = extract.rows_of_day(spark.table(quoted(table)), day)
        file_sinks.export_csv(rows.select(*EVENT, "dt"), path, escape='"')
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@_query
def export_range_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "created-csv")
    events = _read(spark, sf, "events")
    rows = extract.new_rows(events, "ts", "2024-01-10", "2024-01-12", to_second=True)
    file_sinks.export_csv(rows.select(*EVENT, _second_text("ts").alias("created")), path, escape='"')
    schema = "event_id bigint, user_id bigint, event_type string, value double, props string, created string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@_query
def export_json_docs(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "documents-json")
    documents = frames.stamp_export_time(_read(spark, sf, "documents"), RUN_TIME)
    file_sinks.export_json_docs(documents, path)
    return spark.read.schema(documents.schema).json(path)
