"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.dates import column_of


def strip_newlines(c: Column | str) -> Column:
    """Text without carriage returns and line feeds; NULL stays NULL."""
    no_returns = F.replace(column_of(c), F.lit("\r"), F.lit(""))
    return F.replace(no_returns, F.lit("\n"), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    """NULL for text that is white space only or the word ``null``."""
    c = column_of(c)
    return F.when(c.rlike(r"\S") & (c != "null"), c)


def strip_last_suffix(c: Column | str) -> Column:
    """``logs_app_2021`` to ``logs_app``, also in front of a ``:type`` ending."""
    return F.regexp_replace(column_of(c), r"^([^:]*)_[^_:]*(:.*)?$", "$1$2")
