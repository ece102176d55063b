"""Key filters of partitioned tables: which partitions can hold any of a batch's keys.

Beside a table stands ``<table>__keys`` with a blocked Bloom filter for each partition.  A key's hash names a block of
512 bits and one bit in each of its eight words, so a filter is one ``bit_or`` aggregate by partition and block, and a
batch is held against all filters by an equi-join on the block.  Every block has the least and greatest first key
as well.  A partition has a power of two of blocks, one for each ``_KEYS_PER_BLOCK`` rows; of each number of blocks that
occurs, a batch's key names one block.

A filter counts only for the data files it was made from: their names' digest is a partition column of the filter table, so
which filters hold is told from file and partition names alone.  Partitions changed by anyone, however, or never seen are
taken as possible hits until :func:`refresh` has read them.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import partitions
from daybook.session import quoted

_WORDS = 8
_KEYS_PER_BLOCK = 16


def filter_table(table: str) -> str:
    return f"{table}__keys"


def levels(by: list[str]) -> Column:
    """A row's partition as text: its level values, with the catalog's stand-in for NULL."""
    return F.to_json(F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(partitions.NO_DAY)) for c in by]))


def _named(values: list[str]) -> str:
    return json.dumps(values, ensure_ascii=False, separators=(",", ":"))


def _mark(keys: list[str], files: list[str]) -> str:
    return hashlib.md5("\n".join([*keys, *sorted(files)]).encode()).hexdigest()


def file_marks(spark: SparkSession, table: str, keys: list[str], by: list[str]) -> dict[str, str]:
    """Partition to digest of its data files' names, as the table's file index lists them.

    Files of a partition that was put elsewhere do not show its values and are left out.
    """
    spark.catalog.refreshTable(quoted(table))
    files = defaultdict(list)
    for path in spark.table(quoted(table)).inputFiles():
        *folders, name = path.split("/")
        tail = [folder.partition("=") for folder in folders[-len(by) :]]
        if [unquote(k).lower() for k, _, _ in tail] == by:
            files[_named([unquote(unquote(v)) if "%25" in v else unquote(v) for _, _, v in tail])].append(name)
    return {part: _mark(keys, names) for part, names in files.items()}


def _held(spark: SparkSession, table: str) -> set[tuple[str, str]]:
    """Partition and digest of every filter there is."""
    name = filter_table(table)
    if not spark.catalog.tableExists(quoted(name)):
        return set()
    rows = [r["partition"] for r in partitions.list_partitions(spark, name).collect()]
    split = [[unquote(level).partition("=")[2] for level in row.split("/")] for row in rows]
    return {(part, mark) for part, mark in split}


def _hashed(df: DataFrame, keys: list[str], *kept: Column) -> DataFrame:
    of = [F.col(f"`{k}`") for k in keys]
    return df.select(*kept, of[0].alias("key"), F.xxhash64(*of).alias("h"), F.xxhash64(F.lit(1), *of).alias("bits"))


def _bit(i: int) -> Column:
    return F.shiftrightunsigned("bits", 6 * i).bitwiseAND(F.lit(63)).cast("int")


def _filters(rows: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The filters of the rows' partitions: ``blocks, block, low, high, w0.., part``."""
    hashed = _hashed(rows, keys, levels(by).alias("part"))
    wanted = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / _KEYS_PER_BLOCK))
    # one row for each partition
    sizes = hashed.groupBy("part").agg(F.expr("1L").alias("one"), wanted.alias("wanted")).select(
        "part", F.pow(F.lit(2.0), F.ceil(F.log2("wanted"))).cast("long").alias("blocks")
    )
    placed = hashed.join(sizes, "part").withColumn("block", F.col("h").bitwiseAND(F.col("blocks") - 1))
    words = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(i))).alias(f"w{i}") for i in range(_WORDS)]
    return placed.groupBy("part", "blocks", "block").agg(F.min("key").alias("low"), F.max("key").alias("high"), *words).select(
        "blocks", "block", "low", "high", *[f"w{i}" for i in range(_WORDS)], "part"
    )


def refresh(spark: SparkSession, table: str, keys: list[str], by: list[str]) -> list[str]:
    """Make filters of all partitions that have none of their present files, and name those partitions."""
    marks = file_marks(spark, table, keys, by)  # listed first: files that come later make the filter void
    held = _held(spark, table)
    stale = sorted(part for part, mark in marks.items() if (part, mark) not in held)
    name = filter_table(table)
    if stale:
        target = spark.table(quoted(table))
        chosen = [json.loads(part) for part in stale]
        found = _filters(of_partitions(target, by, chosen), keys, by)
        listed = spark.createDataFrame([(part, marks[part]) for part in stale], "part string, files string")
        rows = found.join(F.broadcast(listed), "part").select(*found.columns, "files")  # one row for each partition
        if not spark.catalog.tableExists(quoted(name)):
            spark.createDataFrame([], rows.schema).write.partitionBy("part", "files").saveAsTable(quoted(name))
        rows.hint("rebalance", "part").write.insertInto(quoted(name))
    void = [partition for partition in held if marks.get(partition[0]) != partition[1]]
    for part, mark in void:
        spec = ", ".join(f"{c} = '{v}'" for c, v in (("part", part.replace("\\", "\\\\").replace("'", "\\'")), ("files", mark)))
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION ({spec})")
    return stale


def possible(batch: DataFrame, table: str, keys: list[str], by: list[str]) -> list[list[str]] | None:
    """Level values of the partitions that can hold a key of the batch; None if no filter tells."""
    spark = batch.sparkSession
    marks = file_marks(spark, table, keys, by)
    fresh = {part: mark for part, mark in _held(spark, table) if marks.get(part) == mark}
    if not fresh:
        return None
    shown = [r["partition"] for r in partitions.list_partitions(spark, table).collect()]
    every = [[unquote(level).partition("=")[2] for level in row.split("/")] for row in shown]
    unknown = [values for values in every if _named(values) not in fresh]
    filters = spark.table(quoted(filter_table(table))).where(F.col("files").isin(list(fresh.values())))
    sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]  # powers of two
    probes = _hashed(batch, keys).withColumn("blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
    probes = probes.withColumn("block", F.col("h").bitwiseAND(F.col("blocks") - 1))
    inside = [F.col("key").between(F.col("low"), F.col("high"))]
    bits = [F.call_function("shiftrightunsigned", F.col(f"w{i}"), _bit(i)).bitwiseAND(F.lit(1)) == 1 for i in range(_WORDS)]
    met = filters.join(probes, ["blocks", "block"]).where(reduce(and_, inside + bits))
    return unknown + [json.loads(r["part"]) for r in met.select("part").distinct().collect()]


def of_partitions(target: DataFrame, by: list[str], chosen: list[list[str]]) -> DataFrame:
    """The table's rows in the partitions of these level values; the first level prunes the scan, deeper ones do where
    the short list of partitions is joined."""
    spark = target.sparkSession
    first = next(f.dataType for f in target.schema if f.name.lower() == by[0])
    values = {tuple(v) for v in chosen}
    days = [F.lit(v).cast(first) for v in sorted({v[0] for v in values}) if v != partitions.NO_DAY]
    wanted = F.col(by[0]).isin(days) if days else F.lit(False)
    if any(v[0] == partitions.NO_DAY for v in values):
        wanted = wanted | F.col(by[0]).isNull()
    held = target.where(wanted)
    if len(by) > 1:
        listed = spark.createDataFrame(sorted(values), ", ".join(f"`_p{i}` string" for i in range(len(by))))
        names = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(partitions.NO_DAY)) for c in by]
        held = held.join(listed, reduce(and_, [n == F.col(f"_p{i}") for i, n in enumerate(names)]), "left_semi")
    return held
