"""Delimited files and spreadsheets with a caller-given list of text columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.sources import worksheets


def text_schema(names: str) -> T.StructType:
    """``"a,b,c"`` as a schema of nullable strings."""
    return T.StructType([T.StructField(n.strip(), T.StringType()) for n in names.split(",")])


def read_csv(spark: SparkSession, path: str, names: str, **options: str) -> DataFrame:
    r"""CSV with a header line, ``\N`` for NULL, every column text under the given names."""
    reader = spark.read.schema(text_schema(names)).option("header", True).option("nullValue", r"\N")
    return reader.options(**options).csv(path)


def read_excel(spark: SparkSession, path: str, names: str, sheet: str | int = 0, header: bool = True) -> DataFrame:
    """A worksheet of ``.xlsx`` files, by name or position, every column text under the given names; empty cells are NULL."""
    return worksheets.read(spark, path, text_schema(names).names, sheet, header)


def parquet_reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Table name to the parquet file or folder of that name, for the jobs."""
    return lambda table: spark.read.parquet(f"{folder}/{table}.parquet")
