"""Column expressions on literal rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybook.functions import dates, text
from daybook.session import session_settings


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.fixture
def rows(spark):
    def make(items, kind="string"):
        return spark.createDataFrame([(i,) for i in items], f"c {kind}")

    return make


def test_mixed_day_formats(spark):
    people = spark.createDataFrame(
        [
            ("a", 20, 1000000001, "20210411"),
            ("a", 20, 1000000001, "20210412"),
            ("b", 20, 1000000001, "20210413"),
            ("c", 19, 1000000002, "2021-04-12 00:00:05"),
            ("d", 21, 1000000003, "2021-04-12"),
            ("e", 21, 1000000003, "no day"),
            ("f", 21, 1000000003, None),
        ],
        "name string, age int, phone bigint, Month string",
    )
    found = people.where(dates.matches_day("Month", "2021-04-12")).collect()
    assert [r["Month"] for r in found] == ["20210412", "2021-04-12 00:00:05", "2021-04-12"]
    days = values(people, dates.day_of_mixed_text("Month"))
    assert days == [
        "2021-04-11",
        "2021-04-12",
        "2021-04-13",
        "2021-04-12",
        "2021-04-12",
        None,
        None,
    ]


@pytest.mark.parametrize(
    "kind, day", [("date", date(2021, 4, 12)), ("timestamp", datetime(2021, 4, 12, 5)), ("int", 20210412)]
)
def test_mixed_days_of_other_types(rows, kind, day):
    df = rows([day, None], kind)
    assert values(df.where(dates.matches_day("c", "2021-04-12")), "c") == [day]
    assert values(df, dates.day_of_mixed_text("c")) == ["2021-04-12", None]


def test_chinese_dates(rows):
    df = rows(["2020年7月15日", "2021年12月1日", "2021|4|2", "2021-04-02 08:00:00", "x", None])
    assert values(df, dates.day_of_chinese_text("c")) == [
        "2020-07-15",
        "2021-12-01",
        "2021-04-02",
        "2021-04-02",
        None,
        None,
    ]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_half_open_day_keeps_the_last_fraction(rows, kind):
    times = [
        datetime(2024, 1, 14, 23, 59, 59, 999999),
        datetime(2024, 1, 15),
        datetime(2024, 1, 15, 23, 59, 59),
        datetime(2024, 1, 15, 23, 59, 59, 1),
        datetime(2024, 1, 16),
        None,
    ]
    df = rows(times, kind)
    assert values(df.where(dates.in_days(df, "c", "2024-01-15")), "c") == times[1:4]
    assert values(df.where(dates.in_days_to_second(df, "C", "2024-01-15")), "c") == times[1:3]
    assert values(df, dates.day_text(df, "c")) == [
        "2024-01-14",
        "2024-01-15",
        "2024-01-15",
        "2024-01-15",
        "2024-01-16",
        None,
    ]


def test_day_predicates_on_dates_and_text(rows):
    df = rows([date(2024, 1, 14), date(2024, 1, 15), date(2024, 1, 16)], "date")
    wanted = dates.in_days(df, "c", "2024-01-15", "2024-01-16")
    assert len(values(df.where(wanted), "c")) == 2
    wanted = dates.in_days_to_second(df, "c", "2024-01-14", "2024-01-15")
    assert len(values(df.where(wanted), "c")) == 2
    df = rows(["2024-01-15", "2024-01-15 10:00:00", "2024-01-15 23:59:59", "2024-01-16 00:00:00"])
    assert len(values(df.where(dates.in_days(df, "c", "2024-01-15")), "c")) == 3
    assert len(values(df.where(dates.in_days_to_second(df, "c", "2024-01-15")), "c")) == 2


def test_day_predicate_needs_a_time_column(rows):
    df = rows([1], "int")
    with pytest.raises(TypeError):
        dates.in_days(df, "c", "2024-01-15")
    with pytest.raises(ValueError):
        dates.in_days(df, "nope", "2024-01-15")


def test_day_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ct")
    ).write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(dates.in_days(df, "ct", "1970-01-01"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ct," in plan and "LessThan(ct," in plan


def test_epoch(rows):
    df = rows(["1970-01-01 00:00:01", "2021-02-03 04:05:06", "2021-02-30 00:00:00", "x", None])
    ms = [1000, 1612325106000, 0, 0, 0]
    assert values(df, dates.text_to_epoch_ms("c")) == ms
    back = rows([1000, 1612325106999, -1], "bigint")
    assert values(back, dates.epoch_ms_to_text("c")) == [
        "1970-01-01 00:00:01",
        "2021-02-03 04:05:06",
        "1969-12-31 23:59:59",
    ]


def test_lenient_epoch_carries_over(rows):
    df = rows(
        [
            "2021-2-3 4:5:6",
            "2021-02-03 04:05:06.789 and more",
            "2021-13-01 00:00:00",
            "2021-02-30 00:00:00",
            "2021-01-01 24:00:61",
            "x",
            None,
        ]
    )

    def ms(*parts):
        return int((datetime(*parts) - datetime(1970, 1, 1)).total_seconds() * 1000)

    assert values(df, dates.text_to_epoch_ms("c", lenient=True)) == [
        ms(2021, 2, 3, 4, 5, 6),
        ms(2021, 2, 3, 4, 5, 6),
        ms(2022, 1, 1),
        ms(2021, 3, 2),
        ms(2021, 1, 2, 0, 1, 1),
        0,
        0,
    ]


def test_shifts(rows):
    df = rows(["2024-03-01 00:10:00", "bad"])
    assert values(df, dates.back_quarter_hour("c")) == ["2024-02-29 23:55:00", None]
    assert values(df, dates.next_quarter_hour("c")) == ["2024-03-01 00:25:00", None]
    assert values(df, dates.back_hour("c")) == ["2024-02-29 23:10:00", None]
    assert values(df, dates.back_day("c")) == ["2024-02-29 00:10:00", None]
    assert values(df, dates.back_week("c")) == ["2024-02-23 00:10:00", None]
    assert values(df, dates.shift_time("c", timedelta(seconds=1))) == ["2024-03-01 00:10:01", None]


def test_durations_are_fixed_where_clocks_change(spark, rows):
    with session_settings(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        df = rows(["2024-03-10 12:00:00"])
        assert values(df, dates.back_day("c")) == ["2024-03-09 11:00:00"]
        strict, lenient = (dates.text_to_epoch_ms("c", lenient=x) for x in (False, True))
        assert values(df, strict) == values(df, lenient) == [1710086400000]


def test_validity(rows):
    df = rows(
        [
            "2021-02-03 04:05:06",
            "2021-2-3 4:5:6",
            "2021-02-03 04:05:06 x",
            "2007-02-29 00:00:00",
            "2021-02-03",
            None,
        ]
    )
    assert values(df, dates.is_valid_time("c")) == [True, False, False, False, False, False]
    assert values(df, dates.is_valid_time("c", any_width=True)) == [
        True,
        True,
        True,
        False,
        False,
        False,
    ]


def test_iso_weekday(rows):
    days = [date(2024, 1, 1) + timedelta(days=n) for n in range(7)]
    assert values(rows(days, "date"), dates.iso_weekday("c")) == [1, 2, 3, 4, 5, 6, 7]
    assert values(rows(["2020-12-27"]), dates.iso_weekday("c")) == [7]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_start(rows, kind):
    df = rows([datetime(2020, 12, 28, 11, 59, 33), datetime(1960, 3, 5, 11), None], kind)
    assert values(df, dates.window_start("c", "1 day", "-8 hours")) == [
        datetime(2020, 12, 27, 16),
        datetime(1960, 3, 4, 16),
        None,
    ]


def test_window_start_of_milliseconds(rows):
    hour = 3600 * 1000
    df = rows([1609156773000, -1, None], "bigint")
    assert values(df, dates.window_start_ms("c", 24 * hour, -8 * hour)) == [
        1609084800000,
        -8 * hour,
        None,
    ]


def test_days_column(rows):
    df = rows([date(2024, 2, 28)], "date")
    days = dates.days_column(F.col("c"), F.date_add("c", 2))
    assert values(df, days) == [["2024-02-28", "2024-02-29", "2024-03-01"]]


def test_text_cleaning(rows):
    df = rows(["a\r\nb\n\rc", "", None])
    assert values(df, text.strip_newlines("c")) == ["abc", "", None]
    df = rows(["", " \t\n", "null", "NULL", " null ", "x", None])
    assert values(df, text.blank_to_null("c")) == [None, None, None, "NULL", " null ", "x", None]


def test_last_suffix(rows):
    df = rows(["xxx_yy_z_index_2021", "xxx_yy_z_index_2021:_docx", "plain", "a_b:c_d", None])
    assert values(df, text.strip_last_suffix("c")) == [
        "xxx_yy_z_index",
        "xxx_yy_z_index:_docx",
        "plain",
        "a:c_d",
        None,
    ]
