"""Stamping, cleaning and combining frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import text
from daybook.model import check_day


def _stamp(df: DataFrame, name: str, value: Column, first: bool) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    stamped = value.alias(name)
    return df.select(stamped, *rest) if first else df.select(*rest, stamped)


def stamp_day(df: DataFrame, day: str, first: bool = False) -> DataFrame:
    """Add the constant day column ``dt``, last unless asked for first."""
    return _stamp(df, "dt", F.lit(check_day(day)), first)


def stamp_export_time(df: DataFrame, run_time: str, first: bool = False) -> DataFrame:
    """Add ``last_update_time``: one value for the whole run, given by the caller."""
    return _stamp(df, "last_update_time", F.lit(run_time), first)


def _over_text(df: DataFrame, change, chosen) -> DataFrame:
    changed = {
        field.name: change(F.col(f"`{field.name}`"))
        for field in df.schema.fields
        if isinstance(field.dataType, T.StringType) and chosen(field.name.lower())
    }
    return df.withColumns(changed) if changed else df


def clean_text(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Strip line breaks from every string column; other columns and NULLs pass.

    Filters on a skipped column still reach the scan.
    """
    skipped = {n.lower() for n in skip}
    return _over_text(df, text.strip_newlines, lambda name: name not in skipped)


def blanks_to_null(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Blank text to NULL in the given string columns, or in all of them."""
    wanted = None if names is None else {n.lower() for n in names}
    return _over_text(df, text.blank_to_null, lambda name: wanted is None or name in wanted)


def required(name: str) -> Column:
    """A key column of an upsert: NULL in it is an error."""
    missing = F.raise_error(F.lit(f"upsert: key column {name} is NULL"))
    return F.when(F.col(f"`{name}`").isNull(), missing).otherwise(F.col(f"`{name}`")).alias(name)


def join_allow_list(df: DataFrame, column: str, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose column is in a one-column list, once per copy of the value in the list.

    No broadcast hint: the planner broadcasts a list below its size limit and
    otherwise sort-merges, splitting hot keys.
    """
    return df.join(allowed, df[column] == allowed[key], "inner").drop(allowed[key])


def union_by_position(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two frames column by column, whatever the names of the second."""
    return first.union(second)


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two frames matching columns by name, whatever their order."""
    return first.unionByName(second)
