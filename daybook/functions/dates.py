"""Days and times as column expressions.

The predicates compare the bare column with literals of its own type, so they
reach the scan (parquet row groups, JDBC ``WHERE``) instead of being evaluated
on a formatted copy of the column.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.model import check_day, check_range, next_day

# Text formats of the data.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_DAY_FORMAT = "yyyyMMdd"

_TIMES = (T.TimestampType, T.TimestampNTZType)


def column_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def type_of(df: DataFrame, name: str) -> T.DataType:
    """Type of a column looked up the way Spark resolves it, without regard to case."""
    for field in df.schema.fields:
        if field.name.lower() == name.lower():
            return field.dataType
    raise ValueError(f"no column {name!r} in {df.columns}")


def _literal(text: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return F.lit(text)
    if isinstance(data_type, (T.DateType, *_TIMES)):
        return F.lit(text).cast(data_type)
    raise TypeError(f"a day predicate needs a date, timestamp or string column, not {data_type}")


def in_days(df: DataFrame, name: str, dt: str, dt1: str | None = None) -> Column:
    """Rows whose time lies in the days ``dt`` to ``dt1``: from midnight up to, not including,
    midnight after the last day.  Text columns must hold ``yyyy-MM-dd…``."""
    dt, dt1 = check_range(dt, dt1)
    data_type = type_of(df, name)
    c = F.col(name)
    if isinstance(data_type, T.DateType):
        return (c >= _literal(dt, data_type)) & (c <= _literal(dt1, data_type))
    return (c >= _literal(dt, data_type)) & (c < _literal(next_day(dt1), data_type))


def in_days_to_second(df: DataFrame, name: str, dt: str, dt1: str | None = None) -> Column:
    """Rows between ``dt 00:00:00`` and ``dt1 23:59:59``, both included.

    Unlike :func:`in_days` this leaves out fractions of the last second.
    """
    dt, dt1 = check_range(dt, dt1)
    data_type = type_of(df, name)
    c = F.col(name)
    if isinstance(data_type, T.DateType):
        return c.between(_literal(dt, data_type), _literal(dt1, data_type))
    low = _literal(f"{dt} 00:00:00", data_type)
    if isinstance(data_type, T.StringType):  # a space or a T before the clock
        late = c.startswith(dt1) & is_past_last_second(c)
        return (c >= low) & (c < _literal(next_day(dt1), data_type)) & ~late
    return c.between(low, _literal(f"{dt1} 23:59:59", data_type))


def is_past_last_second(c: Column) -> Column:
    """Whether time text names a fraction after ``23:59:59``."""
    return c.rlike(r"^.{10}[ T]23:59:59\.\d*[1-9]")


def in_day_list(df: DataFrame, days: Sequence[str], name: str = "dt") -> Column:
    """Rows whose day is exactly one of the days; prunes partitions, for text and DATE alike."""
    data_type = type_of(df, name)
    return F.col(name).isin([_literal(check_day(d), data_type) for d in days])


def written_day(c: Column | str) -> Column:
    """The ``yyyy-MM-dd`` day that time text starts with, whatever follows it; NULL if it starts with none."""
    day = F.substring(column_of(c), 1, 10)
    return F.when(day.rlike(r"^\d{4}-\d\d-\d\d$") & F.try_to_timestamp(day, F.lit("yyyy-MM-dd")).isNotNull(), day)


def day_text(df: DataFrame, name: str) -> Column:
    """The day of a time column as ``yyyy-MM-dd`` text; NULL where text is no time."""
    if isinstance(type_of(df, name), T.StringType):
        return day_of_text(name)
    return F.to_date(F.col(name)).cast("string")


def filed_day(df: DataFrame, name: str) -> Column:
    """The day a row is filed under: that of a time, or the one that time text starts with."""
    if isinstance(type_of(df, name), T.StringType):
        return written_day(name)
    return day_text(df, name)


def day_of_text(c: Column | str) -> Column:
    return F.to_date(F.try_to_timestamp(column_of(c))).cast("string")


def compact_day(day: str) -> str:
    """``yyyy-MM-dd`` to ``yyyyMMdd``."""
    return check_day(day).replace("-", "")


def matches_day(c: Column | str, day: str) -> Column:
    """Text that names the day as ``yyyy-MM-dd``, as ``yyyyMMdd`` or as a time on that day.

    Other types are read as the text they show.
    """
    c = column_of(c).cast("string")
    return (c == check_day(day)) | (c == compact_day(day)) | (day_of_text(c) == day)


def day_of_mixed_text(c: Column | str) -> Column:
    """The day that :func:`matches_day` would find, so a range of days needs one pass."""
    c = column_of(c).cast("string")
    compact = F.to_date(F.try_to_timestamp(c, F.lit(COMPACT_DAY_FORMAT))).cast("string")
    return F.coalesce(day_of_text(c), compact)


def day_of_chinese_text(c: Column | str) -> Column:
    """``2021年4月2日`` (or ``2021|4|2``) to ``2021-04-02``; NULL where it is no date."""
    dashed = F.regexp_replace(column_of(c), "[年|月]", "-")
    return day_of_text(F.replace(dashed, F.lit("日"), F.lit("")))


def _lenient_time(c: Column) -> Column:
    # Narrow or overlong fields, text after the seconds ignored, overflowing fields carried over.
    # Years of four digits and other fields of five stay within what dates and times can hold.
    pattern = r"^(\d{1,4})-(\d{1,5})-(\d{1,5}) (\d{1,5}):(\d{1,5}):(\d{1,5})(?!\d)"
    part = [F.regexp_extract(c, pattern, n).try_cast("int") for n in range(1, 7)]
    day = F.date_add(F.add_months(F.make_date(part[0], F.lit(1), F.lit(1)), part[1] - 1), part[2] - 1)
    clock = F.make_dt_interval(hours=part[3], mins=part[4], secs=part[5].cast("decimal(18,6)"))
    return F.when(c.rlike(pattern), (day.cast("timestamp_ntz") + clock).cast("timestamp"))


def parse_time(c: Column | str, lenient: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a timestamp, NULL where it is not one.

    ``lenient`` also takes narrow fields (``2021-2-3 4:5:6``), text after the seconds,
    and out-of-range fields, which carry over (month 13 is January of the next year); years
    of more than four digits and other fields of more than five cannot be read.
    """
    c = column_of(c)
    return _lenient_time(c) if lenient else F.try_to_timestamp(c, F.lit(TIME_FORMAT))


def text_to_epoch_ms(c: Column | str, lenient: bool = False) -> Column:
    """Time text as milliseconds since the epoch, 0 where it cannot be read."""
    return F.coalesce(F.unix_millis(parse_time(c, lenient)), F.lit(0).cast("bigint"))


def epoch_ms_to_text(c: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(column_of(c)), TIME_FORMAT)


def shift_time(c: Column | str, by: timedelta, lenient: bool = False) -> Column:
    """Time text moved by a fixed duration; NULL where it cannot be read.

    24 hours stay 24 hours where the session's zone changes its clock; adding an interval
    of a day would not.
    """
    shifted = F.unix_micros(parse_time(c, lenient)) + F.lit(by // timedelta(microseconds=1))
    return F.date_format(F.timestamp_micros(shifted), TIME_FORMAT)


def back_quarter_hour(c: Column | str) -> Column:
    return shift_time(c, timedelta(minutes=-15))


def next_quarter_hour(c: Column | str) -> Column:
    return shift_time(c, timedelta(minutes=15))


def back_hour(c: Column | str) -> Column:
    return shift_time(c, timedelta(hours=-1))


def back_day(c: Column | str) -> Column:
    return shift_time(c, timedelta(hours=-24))


def back_week(c: Column | str) -> Column:
    return shift_time(c, timedelta(hours=-168))


def is_valid_time(c: Column | str, any_width: bool = False) -> Column:
    """Whether text is a real ``yyyy-MM-dd HH:mm:ss`` time; NULL text is not.

    ``any_width`` also takes narrow fields and text after the seconds, but never an
    impossible date.
    """
    c = column_of(c)
    if any_width:
        head = F.regexp_extract(c, r"^\d+-\d+-\d+ \d+:\d+:\d+", 0)
        return F.coalesce(F.try_to_timestamp(head, F.lit("y-M-d H:m:s")).isNotNull(), F.lit(False))
    return F.try_to_timestamp(c, F.lit(TIME_FORMAT)).isNotNull()


def iso_weekday(c: Column | str) -> Column:
    """Monday 1 to Sunday 7, for a date, a timestamp or ``yyyy-MM-dd`` text."""
    return F.weekday(column_of(c)) + 1


def window_start(c: Column | str, size: str = "1 day", offset: str = "0 seconds") -> Column:
    """Start of the tumbling window that holds a timestamp; NULL stays NULL.

    One per select: Spark plans a single window per projection.
    """
    c = column_of(c)
    # F.window drops rows of NULL time; feed it a stand-in and blank the answer instead.
    known = F.coalesce(c, F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.when(c.isNotNull(), F.window(known, size, startTime=offset).start)


def window_start_ms(c: Column | str, size_ms: int, offset_ms: int = 0) -> Column:
    """The same on epoch milliseconds, floored also before the epoch."""
    c = column_of(c)
    return c - F.pmod(c - F.lit(offset_ms), F.lit(size_ms))


def days_column(first: Column, last: Column) -> Column:
    """Array of every day from one date to another, both included, as text."""
    days = F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day"))
    return F.transform(days, lambda d: d.cast("string"))
