"""Session defaults, and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the sizing: shuffles start wide and are merged to the
# advisory size, hot partitions are split in joins and in rebalanced writes.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session with the library's defaults; keyword settings (dots as ``__``) win."""
    builder = SparkSession.builder.appName(app_name)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, prefix: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/{prefix}-{uuid.uuid4().hex}"


def new_database(spark: SparkSession, prefix: str = "daybook") -> str:
    """Create an empty database of unused name whose tables live in the shared folder."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    location = f"{shared_folder(spark)}/{name}.db".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{location}'")
    return name


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Write a frame once to a table in the shared folder and read it from there.

    Cuts lineage, gives the planner real sizes for later joins, and stays readable
    when executors are lost.  The staging table is dropped on exit.
    """
    spark = df.sparkSession
    database = new_database(spark, "staging")
    table = f"`{database}`.rows"
    try:
        df.write.format("parquet").saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Hold session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def quoted(table: str) -> str:
    """``db.table`` with each part in back-ticks."""
    return ".".join(f"`{part.strip('`')}`" for part in table.split("."))
