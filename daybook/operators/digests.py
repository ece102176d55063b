"""What a day holds, as a few numbers: days of equal rows have equal digests, in whatever order and files.

A digest is the number of rows and two sums of 64-bit row hashes, each sum exact.  Sums do not depend on order, so a day is
one aggregate with a partial step: nothing is sorted and no rows travel.  A row is hashed by column name, NULLs included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.partitions import NO_DAY
from daybook.session import quoted

SCHEMA = "dt string, n long, first decimal(38,0), second decimal(38,0)"


def _hashable(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        whole = F.map_entries(column) if isinstance(field.dataType, T.MapType) else column
        whole = F.array_sort(whole) if isinstance(field.dataType, T.MapType) else whole
        # hashes pass over NULLs inside a value, text does not
        return F.to_json(F.struct(whole.alias("v")), {"ignoreNullFields": "false"})
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return column + F.lit(0.0)  # -0.0 equals 0.0
    return column


def row_hashes(df: DataFrame, without: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row's columns, in whatever order the frame has them."""
    left_out = {c.lower() for c in without}
    fields = sorted((f for f in df.schema if f.name.lower() not in left_out), key=lambda f: f.name.lower())
    values = [x for f in fields for x in (F.lit(f.name.lower()), F.col(f"`{f.name}`").isNull(), _hashable(f))]
    return F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)


def day_digests(df: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """``dt, n, first, second`` of each day; rows without a day are a day of their own."""
    first, second = row_hashes(df, ("dt", *without))
    exact = T.DecimalType(20, 0)
    day = F.coalesce(F.col("dt").cast("string"), F.lit(NO_DAY)).alias("dt")
    hashed = df.select(day, first.cast(exact).alias("a"), second.cast(exact).alias("b"))
    return hashed.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"), F.sum("a").cast("decimal(38,0)").alias("first"), F.sum("b").cast("decimal(38,0)").alias("second")
    )


def held_digests(spark: SparkSession, state: str) -> DataFrame:
    """The digests kept in the table ``state``; none if there is no such table."""
    if spark.catalog.tableExists(quoted(state)):
        return spark.table(quoted(state))
    return spark.createDataFrame([], SCHEMA)


def different_days(now: DataFrame, before: DataFrame) -> DataFrame:
    """Days whose digests differ, or that only one side has: ``dt, n, first, second`` of now, NULL for days that are gone."""
    both = now.alias("a").join(before.alias("b"), "dt", "full_outer")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("n", "first", "second")]
    return both.where(~(same[0] & same[1] & same[2])).select("dt", "a.n", "a.first", "a.second")
