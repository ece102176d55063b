"""Relational stores through Spark's JDBC source.  Driver jars are the user's."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from daybook.model import days_between, next_day
from daybook.sources.splits import quantile_splits


@dataclass(frozen=True)
class Store:
    """Where a relational store is and how to log in.  The password never shows in ``repr``."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        login = {"user": self.user, "password": self.password}
        return {"url": self.url, "driver": self.driver, **login, **self.properties}


def _host_and_port(host: str, default_port: int) -> str:
    name, _, port = host.partition(":")
    return f"{name}:{port or default_port}"


def mysql(
    host: str, database: str, user: str, password: str, driver: str = "com.mysql.cj.jdbc.Driver"
) -> Store:
    """A MySQL store; ``host`` may carry a port.  tinyint(1) stays a number."""
    # Connection flags of the URL.
    flags = "tinyInt1isBit=false&connectTimeout=300000&socketTimeout=300000"
    url = f"jdbc:mysql://{_host_and_port(host, 3306)}/{database}?{flags}"
    return Store(url, user, password, driver)


def sql_server(host: str, database: str, user: str, password: str) -> Store:
    url = f"jdbc:sqlserver://{_host_and_port(host, 1433)};databaseName={database}"
    return Store(url, user, password, "com.microsoft.sqlserver.jdbc.SQLServerDriver")


def clickhouse(
    host: str,
    database: str,
    user: str = "default",
    password: str = "",
    driver: str = "com.clickhouse.jdbc.ClickHouseDriver",
) -> Store:
    url = f"jdbc:clickhouse://{_host_and_port(host, 8123)}/{database}"
    return Store(url, user, password, driver)


def scan(
    spark: SparkSession,
    store: Store,
    table: str,
    *,
    split_on: str | None = None,
    splits: int = 1,
    bounds: tuple | None = None,
    predicates: Sequence[str] | None = None,
    even: bool = False,
    tie_column: str | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table of the store; filters and column choice made later are pushed into its query.

    One reader by default.  ``split_on`` (a numeric, date or timestamp column) with
    ``splits`` reads ranges of that column in parallel; its bounds are asked of the
    store unless given.  Where values bunch up, ``even`` reads the column once beforehand and
    splits at its quantiles, values that hold more than a split's rows by ``tie_column`` as well
    (:mod:`daybook.sources.splits`); or pass ``predicates``: SQL conditions that cover the table
    without overlap, one reader each.
    """
    if even and split_on and splits > 1 and not predicates:
        whole = scan(spark, store, table, split_on=split_on, splits=splits, bounds=bounds, fetch_size=fetch_size)
        needed = whole.select(*dict.fromkeys(c for c in (split_on, tie_column) if c))
        predicates = quantile_splits(needed, split_on, splits, tie_column, quote_mark(store))
    if predicates:
        properties = {k: v for k, v in store.options().items() if k != "url"}
        properties["fetchsize"] = str(fetch_size)
        return spark.read.jdbc(store.url, table, predicates=list(predicates), properties=properties)
    reader = spark.read.format("jdbc").options(**store.options()).option("fetchsize", fetch_size)
    if split_on and splits > 1:
        if bounds is None:
            bounds = _bounds(spark, store, table, split_on)
        reader = reader.options(**split_options(split_on, splits, bounds))
    return reader.option("dbtable", table).load()


def quote_mark(store: Store) -> str:
    """What the store's SQL puts around names that may be reserved words."""
    return "`" if store.url.startswith(("jdbc:mysql:", "jdbc:clickhouse:")) else '"'


def identifier(name: str, mark: str) -> str:
    return mark + name.replace(mark, 2 * mark) + mark


def split_options(column: str, splits: int, bounds: tuple) -> dict[str, str]:
    """Settings of a parallel read; none for an empty table, whose bounds are NULL."""
    if bounds[0] is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(splits),
    }


def _bounds(spark: SparkSession, store: Store, table: str, column: str) -> tuple:
    column = identifier(column, quote_mark(store))
    query = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"
    row = spark.read.format("jdbc").options(**store.options()).option("query", query).load().first()
    return row[0], row[1]


def day_predicates(column: str, dt: str, dt1: str | None = None) -> list[str]:
    """One condition per day of a range, for parallel reads of what was created in it."""
    return [f"{column} >= '{d}' AND {column} < '{next_day(d)}'" for d in days_between(dt, dt1)]


def reader(spark: SparkSession, store: Store, **scan_options) -> Callable[[str], DataFrame]:
    """Table name to frame, for the jobs."""
    return lambda table: scan(spark, store, table, **scan_options)
