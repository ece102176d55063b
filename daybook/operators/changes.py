"""Which business days a day's load has touched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import dates
from daybook.model import check_day
from daybook.session import quoted


def changed_days(spark: SparkSession, table: str, created: str, day: str) -> DataFrame:
    """Distinct creation days (column ``ct``) among the rows filed under a day.

    Reads one partition and one column; days are merged before they are shuffled.
    """
    rows = spark.table(quoted(table)).where(F.col("dt") == check_day(day))
    days = rows.select(dates.day_text(rows, created).alias("ct"))
    return days.where(F.col("ct").isNotNull()).distinct()


def found_days(spark: SparkSession, template: str, day: str) -> DataFrame:
    """The days that the caller's query finds for one load day, as text without NULL, as they come."""
    found = spark.sql(template.replace("do_date", check_day(day)))
    days = found.select(F.col("date").cast("string").alias("date"))
    return days.where(F.col("date").isNotNull())


def changed_days_sql(spark: SparkSession, template: str, day: str) -> DataFrame:
    """Days found by the caller's own query, in which ``do_date`` stands for the day.

    The query must return a column ``date``.  Distinct, without NULL, ascending, as text.
    """
    return found_days(spark, template, day).distinct().orderBy("date")
