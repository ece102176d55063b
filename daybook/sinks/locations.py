"""Replacing a table's data by writing to a new place and pointing the catalog at it.

The old files are not touched while the new ones are written, so that a write that fails leaves the table as it was.
The catalog is changed afterwards, in short statements: the table's location, then each partition's.  If one of them
fails, those before it are taken back.  The old files go last, unless they are to be kept.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from daybook.operators import drift, partitions
from daybook.session import quoted, session_settings


def _quoted_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def delete(spark: SparkSession, path: str) -> None:
    system, found = _file_system(spark, path)
    system.delete(found, True)


def place_beside(place: str) -> str:
    """An unused path beside a table's files."""
    return f"{place.rstrip('/')}__{uuid.uuid4().hex[:12]}"


def _folders(spark: SparkSession, root: str, depth: int) -> dict[str, str]:
    """Partition name (``dt=2024-01-01/dh=05``, escaped as in paths) to folder, for what was written under ``root``."""
    system, found = _file_system(spark, root)
    level = {"": found}
    for _ in range(depth):
        level = {
            f"{name}/{s.getPath().getName()}".lstrip("/"): s.getPath()
            for name, path in level.items() for s in system.listStatus(path) if s.isDirectory() and "=" in s.getPath().getName()
        }
    return {name: path.toString() for name, path in level.items()}


def partition_location(spark: SparkSession, table: str, name: str) -> str:
    """Where the files of a partition are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} PARTITION ({partitions._spec(name)})").collect()
    at = next(i for i, r in enumerate(rows) if r["col_name"] == "# Detailed Partition Information")
    return next(r["data_type"] for r in rows[at:] if r["col_name"] == "Location")


class _Undo:
    """Statements that take back those that have run."""

    def __init__(self, spark: SparkSession):
        self.spark, self.back = spark, []

    def run(self, statement: str, back: str) -> None:
        self.spark.sql(statement)
        self.back.append(back)

    def all(self) -> None:
        for statement in reversed(self.back):
            self.spark.sql(statement)


def swap(df: DataFrame, table: str, *, keep_old: bool = False) -> str:
    """Replace all rows of a table of the same columns by the frame's, in a new place beside the old one, and name it.

    Format, comments, properties and partitioning stay as they are.  Readers that have planned before the swap still find
    the old files with ``keep_old``.  A partition that gets no rows is dropped.
    """
    spark = df.sparkSession
    held = partitions.described(spark, table)
    by = held.get("partition_columns", [])
    old_place = held["location"]
    place = place_beside(old_place)
    rows = drift.in_table_order(df, spark.table(quoted(table)).schema)
    old_parts = [r["partition"] for r in partitions.list_partitions(spark, table).collect()] if by else []
    old_places = {name: partition_location(spark, table, name) for name in old_parts}
    undo = _Undo(spark)
    try:
        writer = rows.write.format(held["provider"])
        with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
            (writer.partitionBy(*by) if by else writer).save(place)
        new_places = _folders(spark, place, len(by)) if by else {}
        name_of = {unquote(name): name for name in old_parts}  # as the catalog shows it
        undo.run(_set_place(table, None, place), _set_place(table, None, old_place))
        for name, folder in new_places.items():
            shown = name_of.get(unquote(name))
            if shown is not None:
                undo.run(_set_place(table, shown, folder), _set_place(table, shown, old_places[shown]))
            else:
                spec = partitions._spec(name)
                undo.run(
                    f"ALTER TABLE {quoted(table)} ADD PARTITION ({spec}) LOCATION {_quoted_text(folder)}",
                    f"ALTER TABLE {quoted(table)} DROP IF EXISTS PARTITION ({spec})",
                )
    except Exception:
        undo.all()
        spark.catalog.refreshTable(quoted(table))
        delete(spark, place)
        raise
    filled = {unquote(name) for name in new_places}
    emptied = [name for name in old_parts if unquote(name) not in filled]
    partitions.drop_named(spark, table, emptied)
    spark.catalog.refreshTable(quoted(table))
    if not keep_old:
        for folder in {old_place, *old_places.values()}:
            if folder.rstrip("/") != place:
                delete(spark, folder)
    return place


def _set_place(table: str, name: str | None, place: str) -> str:
    of = f" PARTITION ({partitions._spec(name)})" if name else ""
    return f"ALTER TABLE {quoted(table)}{of} SET LOCATION {_quoted_text(place)}"


def _batch_mark(batch: str) -> str:
    if not batch or not all(c.isalnum() or c in "-." for c in batch):
        raise ValueError("a batch id is made of letters, digits, dots and dashes")
    return f"__batch_{batch}__"


def holds_batch(spark: SparkSession, table: str, batch: str) -> bool:
    """Whether files of the batch are in the table."""
    mark = _batch_mark(batch)
    return any(mark in f.rpartition("/")[2] for f in spark.table(quoted(table)).inputFiles())


def append_once(df: DataFrame, table: str, batch: str) -> int:
    """Append rows to a table partitioned by ``dt`` alone, so that of one batch id they are there once.

    The rows are written to a folder beside the table first, then their files are moved into the partitions under names
    that carry the batch id.  Those names are the batch's commit marker: files that an earlier run of the batch has left
    go before new ones come, also where it has failed half way.  Returns the number of files.

    Readers can see a part of the files while they are moved.  Files move by rename: rows are written once.
    """
    spark = df.sparkSession
    held = partitions.described(spark, table)
    if [c.lower() for c in held.get("partition_columns", [])] != ["dt"]:
        raise ValueError(f"{table} is not partitioned by dt alone")
    mark = _batch_mark(batch)
    place = place_beside(held["location"])
    rows = drift.in_table_order(df, spark.table(quoted(table)).schema)
    try:
        rows.write.format(held["provider"]).partitionBy("dt").save(place)
        system, _ = _file_system(spark, place)
        path = spark._jvm.org.apache.hadoop.fs.Path
        _remove_batch(spark, table, mark)
        shown = {unquote(r["partition"]): r["partition"] for r in partitions.list_partitions(spark, table).collect()}
        moved = 0
        for name, folder in sorted(_folders(spark, place, 1).items()):
            known = shown.get(unquote(name))
            target = partition_location(spark, table, known) if known else f"{held['location'].rstrip('/')}/{name}"
            system.mkdirs(path(target))
            if not known:  # before its files come, so that a run after a failure finds them
                spec = partitions._spec(name)
                spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {_quoted_text(target)}")
            for status in system.listStatus(path(folder)):
                file = status.getPath().getName()
                if not file.startswith(("_", ".")):
                    if not system.rename(status.getPath(), path(f"{target}/part{mark}{moved:05d}-{file}")):
                        raise OSError(f"could not move {status.getPath()}")
                    moved += 1
    finally:
        delete(spark, place)
        spark.catalog.refreshTable(quoted(table))
    return moved


def _remove_batch(spark: SparkSession, table: str, mark: str) -> None:
    """Take the files of a batch out of the table, and drop partitions that held nothing else."""
    spark.catalog.refreshTable(quoted(table))
    files = spark.table(quoted(table)).inputFiles()
    folders = {f.rpartition("/")[0] for f in files if mark in f.rpartition("/")[2]}
    for file in files:
        if mark in file.rpartition("/")[2]:
            delete(spark, unquote(file))
    left = {f.rpartition("/")[0] for f in files if mark not in f.rpartition("/")[2]}
    emptied = [unquote(f.rpartition("/")[2]) for f in folders - left]
    partitions.drop_named(spark, table, emptied)
