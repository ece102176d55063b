"""Parallel reads of equal size: conditions that cover a table without overlap, by the quantiles of a column.

The split points come from a quantile sketch, one aggregate over the column.  A value that several quantiles fall on
and that holds more than half a split's rows gets conditions of its own, as NULL does, cut further at the
quantiles of a second column among its rows.  A range of the others ends at a quantile, so it has at most half a split's
rows more than its share.  Each row meets exactly one condition, whatever its values.
"""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the sketch: ranks are off by at most one in so many


def literal(value) -> str:
    """A value as SQL text that stores and Spark read alike."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value) if value == value and abs(value) != float("inf") else f"CAST('{value}' AS DOUBLE)"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value:%Y-%m-%d}'"
    raise TypeError(f"no split at {type(value).__name__}")


def _ranges(column: str, points: list) -> list[str]:
    """Conditions of the ranges between ascending, different points; each point belongs to the range below it."""
    if not points:
        return [f"{column} IS NOT NULL"]
    out = [f"{column} <= {literal(points[0])}"]
    out += [f"{column} > {literal(a)} AND {column} <= {literal(b)}" for a, b in zip(points, points[1:])]
    return [*out, f"{column} > {literal(points[-1])}"]


def _quantiles(column: Column, parts: int) -> Column:
    # percentile_approx takes a list of shares; the first and last would be the column's bounds
    return F.percentile_approx(column, [i / parts for i in range(1, parts)], ACCURACY)


def quantile_splits(
    df: DataFrame, column: str, splits: int, tie_column: str | None = None, mark: str = "`"
) -> list[str]:
    """About ``splits`` conditions (twice as many at most) on ``column`` (a number, date or time), each with about as many rows.

    ``tie_column``, a column with many different values, splits values that alone hold more than one split's rows; without
    it such a value is one condition.  ``mark`` quotes names.  What reaches the driver are the split points.
    """
    name, tie = (c and mark + c.replace(mark, 2 * mark) + mark for c in (column, tie_column))
    if splits < 2:
        return ["1 = 1"]
    value = F.col(f"`{column}`")
    # finer than the splits, so that any value with more than half a split's rows is on two of the points
    fine = _quantiles(value, 4 * splits).alias("points")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("known"), fine).first()
    n, unknown = row["n"], row["n"] - row["known"]
    if not n:
        return ["1 = 1"]
    size = n / splits
    doubtful = [v for v, times in Counter(row["points"] or []).items() if times > 1]  # half as many as points at most
    counted = df.where(value.isin(doubtful)).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")) if doubtful else None
    heavy = {r["v"]: r["n"] for r in counted.where(F.col("n") > size / 2).collect()} if doubtful else {}
    rest = row["known"] - sum(heavy.values())
    parts = max(1, round(rest / size))
    light = df.where(~value.isin(list(heavy))) if heavy else df
    points = (light.agg(_quantiles(value, parts)).first()[0] or []) if parts > 1 else []
    out = []
    if heavy:
        own = _tied(df, value, heavy, size, tie_column)
        for v in sorted(heavy):
            out += [f"{name} = {literal(v)}{cond}" for cond in _tie_conditions(tie, own.get(v))]
        others = " AND ".join(f"{name} <> {literal(v)}" for v in sorted(heavy))
        out += [f"{cond} AND {others}" for cond in _ranges(name, sorted(set(points)))]
    elif row["known"]:
        out += _ranges(name, sorted(set(points)))
    if unknown:
        own = _tied(df.where(value.isNull()), F.lit(True), {True: unknown}, size, tie_column)
        out += [f"{name} IS NULL{cond}" for cond in _tie_conditions(tie, own.get(True))]
    # rows that came after the sketch: NULLs, if there were none then
    return out if unknown else [f"({out[0]}) OR {name} IS NULL", *out[1:]]


def _tied(df: DataFrame, value: Column, counts: dict, size: float, tie_column: str | None) -> dict:
    """Split points of the second column for each value that holds more than one split's rows."""
    if tie_column is None:
        return {}
    tie = F.col(f"`{tie_column}`")
    parts = {v: round(count / size) for v, count in counts.items() if round(count / size) > 1}
    out = {}
    for number in sorted(set(parts.values())):  # values with equally many parts in one aggregate
        chosen = [v for v, p in parts.items() if p == number]
        found = df.where(value.isin(chosen)).groupBy(value.alias("v")).agg(_quantiles(tie, number).alias("points"))
        out |= {r["v"]: sorted(set(r["points"] or [])) for r in found.collect()}
    return out


def _tie_conditions(tie: str | None, points: list | None) -> list[str]:
    if not points:
        return [""]
    first, *others = _ranges(tie, points)
    return [f" AND ({first} OR {tie} IS NULL)", *[f" AND {c}" for c in others]]
