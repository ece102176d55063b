import pytest

from daybook import (
    LoadStrategy,
    SaveMode,
    TablePair,
    check_day,
    choose_day_match_strategy,
    choose_strategy,
    days_between,
    pair_tables,
    parse_save_mode,
    require_text,
)


@pytest.mark.parametrize(
    "created, updated, expected",
    [
        (None, "", LoadStrategy.ALL),
        ("  ", None, LoadStrategy.ALL),
        ("ct", None, LoadStrategy.NEW),
        ("ct", " ", LoadStrategy.NEW),
        ("ct", "ut", LoadStrategy.NEW_AND_CHANGE),
    ],
)
def test_strategy_follows_the_time_columns(created, updated, expected):
    assert choose_strategy(created, updated) is expected


def test_update_time_alone_is_refused():
    with pytest.raises(ValueError):
        choose_strategy("", "ut")


def test_two_way_strategy():
    assert choose_day_match_strategy("") is LoadStrategy.ALL
    assert choose_day_match_strategy("month") is LoadStrategy.NEW


@pytest.mark.parametrize(
    "text, mode",
    [
        ("overwritealltable", SaveMode.OVERWRITE_TABLE),
        ("OverWriteByDt", SaveMode.OVERWRITE_DAY),
        ("IGNORE", SaveMode.IGNORE),
        ("something", SaveMode.OVERWRITE_DAY),
        (None, SaveMode.OVERWRITE_DAY),
    ],
)
def test_save_mode_text(text, mode):
    assert parse_save_mode(text) is mode


def test_days_are_inclusive_and_cross_months():
    assert days_between("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert days_between("2024-02-28") == ["2024-02-28"]


def test_days_out_of_order_are_refused():
    with pytest.raises(ValueError):
        days_between("2024-03-01", "2024-02-28")


@pytest.mark.parametrize("day", ["2024-2-28", "20240228", "2023-02-29", "2024-02-28 ", "", None])
def test_days_that_are_none(day):
    with pytest.raises(ValueError):
        check_day(day)


def test_blank_parameters():
    require_text(host="h", table="t")
    with pytest.raises(ValueError, match="table"):
        require_text(host="h", table=" ")


def test_table_lists():
    assert pair_tables("a, b", prefix="ods_") == [TablePair("a", "ods_a"), TablePair("b", "ods_b")]
    assert pair_tables(["a", "b"], "x,") == [TablePair("a", "x"), TablePair("b", "b")]
    assert pair_tables("idx:docx") == [TablePair("idx:docx", "idx")]
    with pytest.raises(ValueError):
        pair_tables("a,b", "x")
    with pytest.raises(ValueError):
        pair_tables("a,")
