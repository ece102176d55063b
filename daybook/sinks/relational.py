"""Relational stores: replace by day, replace the table, upsert, bulk append.

Executors load a staging table in parallel; the target then changes in one short
transaction inside the store, so readers never see a half-written day and a failed
load leaves the target as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from daybook.functions.dates import in_day_list
from daybook.model import SaveMode, check_day
from daybook.operators import drift
from daybook.operators.frames import required
from daybook.operators.summaries import latest_rows
from daybook.sources.relational import Store, identifier, quote_mark, scan


def run_in_store(
    spark: SparkSession, store: Store, statements: Sequence[tuple[str, Sequence[str]]]
) -> None:
    """Run statements with their text parameters in one transaction, from the driver.

    The only step that is not a DataFrame operation: Spark has no DELETE or MERGE for JDBC.
    """
    jvm = spark._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(store.driver)
    properties = jvm.java.util.Properties()
    for key, value in {"user": store.user, "password": store.password, **store.properties}.items():
        properties.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(store.url, properties)
    try:
        connection.setAutoCommit(False)
        for sql, parameters in statements:
            prepared = connection.prepareStatement(sql)
            for position, value in enumerate(parameters, start=1):
                prepared.setString(position, value)
            prepared.execute()
            prepared.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def append(
    df: DataFrame,
    store: Store,
    table: str,
    *,
    connections: int = 50,
    batch_size: int = 50_000,
    isolation: str = "NONE",
) -> None:
    """Bulk append through at most ``connections`` parallel connections."""
    writer = _writer(df, store, table, connections, batch_size)
    writer.option("isolationLevel", isolation).mode("append").save()


def write_options(
    df: DataFrame, store: Store, table: str, connections: int, batch_size: int
) -> dict[str, str]:
    return store.options() | {
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "createTableColumnTypes": drift.create_table_column_types(df.schema),
    }


def _writer(
    df: DataFrame, store: Store, table: str, connections: int, batch_size: int
) -> DataFrameWriter:
    options = write_options(df, store, table, connections, batch_size)
    return df.write.format("jdbc").options(**options)


def insert_statement(df: DataFrame, table: str, staging: str, mark: str = '"') -> tuple[str, Sequence[str]]:
    names = ", ".join(identifier(c, mark) for c in df.columns)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}", ()


def day_statements(
    df: DataFrame, table: str, staging: str, days: Sequence[str] | None, mark: str = '"'
) -> list[tuple[str, Sequence[str]]]:
    """Delete the days (all rows without days), then insert what was staged."""
    if days is None:
        delete = (f"DELETE FROM {table}", ())
    else:
        marks = ", ".join("?" for _ in days)
        where = f"{identifier('dt', mark)} IN ({marks})"
        delete = (f"DELETE FROM {table} WHERE {where}", tuple(check_day(d) for d in days))
    return [delete, insert_statement(df, table, staging, mark)]


def upsert_statement(
    df: DataFrame, table: str, staging: str, keys: Sequence[str], dialect: str
) -> str:
    """One set-based insert-or-update from the staging table."""
    mark = "`" if dialect == "mysql" else '"'
    names = [identifier(c, mark) for c in df.columns]
    listed = ", ".join(names)
    if dialect == "mysql":
        updates = ", ".join(f"{n} = VALUES({n})" for n in names)
        return (
            f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} "
            f"ON DUPLICATE KEY UPDATE {updates}"
        )
    is_key = {k.lower() for k in keys}
    of_key = [identifier(c, mark) for c in df.columns if c.lower() in is_key]
    matched = " AND ".join(f"t.{k} = s.{k}" for k in of_key)
    rest = [n for n in names if n not in of_key]
    update = f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.{n} = s.{n}' for n in rest)} "
    values = ", ".join(f"s.{n}" for n in names)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {matched} {update if rest else ''}"
        f"WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({values})"
    )


@contextmanager
def _staging(df: DataFrame, store: Store, table: str, connections: int, batch_size: int):
    staging = f"{table}_stage_{uuid.uuid4().hex[:8]}"
    try:
        # Spread by a shuffle: left to the writer's own cap, a coalesce, the scan would
        # run in no more tasks than there are connections.
        spread = df.repartition(connections)
        _writer(spread, store, staging, connections, batch_size).mode("overwrite").save()
        yield staging
    finally:
        run_in_store(df.sparkSession, store, [(f"DROP TABLE IF EXISTS {staging}", ())])


def _create_if_missing(df: DataFrame, rows: DataFrame, store: Store, table: str) -> None:
    """Create the target for the frame's types; ``rows`` are its relational values."""
    if store.url.startswith("jdbc:mysql:"):  # by statement, which carries the comments
        statement = drift.create_table_statement(table, df.schema)
        run_in_store(df.sparkSession, store, [(statement, ())])
    else:  # an append of no rows creates the table and nothing else
        _writer(rows.limit(0), store, table, 1, 1).mode("append").save()


def replace(
    df: DataFrame,
    store: Store,
    table: str,
    mode: SaveMode = SaveMode.OVERWRITE_DAY,
    days: str | Sequence[str] | None = None,
    *,
    connections: int = 5,
    batch_size: int = 1_000,
) -> None:
    """Replace the given days of a store's table, or all of it; create it if missing.

    With ``OVERWRITE_TABLE`` every row of the frame is written, else those of the days (with
    ``IGNORE``, all rows if no days are given).  ``IGNORE`` writes only into an empty table and
    deletes nothing.
    """
    spark = df.sparkSession
    days = [days] if isinstance(days, str) else list(days or [])
    if mode is SaveMode.OVERWRITE_DAY and not days:
        raise ValueError("replacing by day needs at least one day")
    if mode is not SaveMode.OVERWRITE_TABLE and days:
        df = df.where(in_day_list(df, days))
    rows = drift.to_relational(df)
    _create_if_missing(df, rows, store, table)
    if mode is SaveMode.IGNORE and not scan(spark, store, table).isEmpty():
        return
    mark = quote_mark(store)
    with _staging(rows, store, table, connections, batch_size) as staging:
        if mode is SaveMode.IGNORE:
            statements = [insert_statement(rows, table, staging, mark)]
        else:
            whole = mode is SaveMode.OVERWRITE_TABLE
            statements = day_statements(rows, table, staging, None if whole else days, mark)
        run_in_store(spark, store, statements)


def upsert(
    df: DataFrame,
    store: Store,
    table: str,
    keys: list[str],
    order_by: list[str],
    *,
    dialect: str = "mysql",
    connections: int = 5,
    batch_size: int = 1_000,
) -> None:
    """Insert or update by key in an existing table of the store, target columns only.

    Blank text becomes NULL, whatever the target's type; a NULL key is an error.
    """
    spark = df.sparkSession
    target = scan(spark, store, table).schema
    latest = latest_rows(df, keys, order_by)
    rows = drift.align_to_target(latest, target, blank_as_null=True)
    rows = rows.withColumns({k.lower(): required(k.lower()) for k in keys})
    with _staging(rows, store, table, connections, batch_size) as staging:
        statement = upsert_statement(rows, table, staging, keys, dialect)
        run_in_store(spark, store, [(statement, ())])
