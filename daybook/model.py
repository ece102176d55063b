"""Enums, parameter checks and table lists shared by the jobs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from enum import Enum

_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


class LoadStrategy(Enum):
    """Which source rows a load takes."""

    ALL = "ALL"
    NEW = "NEW"
    NEW_AND_CHANGE = "NEW_AND_CHANGE"


class SaveMode(Enum):
    """What a sink does with rows that are already there."""

    OVERWRITE_TABLE = "OverWriteAllTable"
    OVERWRITE_DAY = "OverWriteByDt"
    IGNORE = "Ignore"


def parse_save_mode(text: str | None) -> SaveMode:
    """Save mode by its name in any case; anything else means replace by day."""
    wanted = (text or "").lower()
    return next((m for m in SaveMode if m.value.lower() == wanted), SaveMode.OVERWRITE_DAY)


def _blank(text: str | None) -> bool:
    return text is None or not text.strip()


def choose_strategy(created: str | None, updated: str | None) -> LoadStrategy:
    """No time column: ALL.  Creation time only: NEW.  Both: NEW_AND_CHANGE."""
    if _blank(created):
        if _blank(updated):
            return LoadStrategy.ALL
        raise ValueError("an update-time column needs a creation-time column beside it")
    return LoadStrategy.NEW if _blank(updated) else LoadStrategy.NEW_AND_CHANGE


def choose_day_match_strategy(time_column: str | None) -> LoadStrategy:
    """Two-way choice for sources with one time column of mixed text formats."""
    return LoadStrategy.ALL if _blank(time_column) else LoadStrategy.NEW


def require_text(**values: str | None) -> None:
    """Raise unless every named value holds more than white space."""
    for name, value in values.items():
        if _blank(value):
            raise ValueError(f"{name} must not be blank")


def check_day(day: str) -> str:
    """The day itself if it is a real ``yyyy-MM-dd`` date."""
    if not _DAY.fullmatch(day or ""):
        raise ValueError(f"expected a day as yyyy-MM-dd, got {day!r}")
    date.fromisoformat(day)
    return day


def next_day(day: str) -> str:
    return (date.fromisoformat(check_day(day)) + timedelta(days=1)).isoformat()


def check_range(dt: str, dt1: str | None = None) -> tuple[str, str]:
    """Both ends of an inclusive day range; one day when ``dt1`` is left out."""
    dt1 = dt if dt1 is None else dt1
    if check_day(dt1) < check_day(dt):
        raise ValueError(f"range end {dt1} lies before its start {dt}")
    return dt, dt1


def days_between(dt: str, dt1: str | None = None) -> list[str]:
    """Every day of the inclusive range, ascending."""
    dt, dt1 = check_range(dt, dt1)
    first = date.fromisoformat(dt)
    length = (date.fromisoformat(dt1) - first).days + 1
    return [(first + timedelta(days=n)).isoformat() for n in range(length)]


@dataclass(frozen=True)
class TablePair:
    source: str
    target: str


def pair_tables(
    sources: str | Sequence[str], targets: str | Sequence[str] | None = None, prefix: str = ""
) -> list[TablePair]:
    """Match source tables to target tables, in order.

    Lists may be comma-separated text.  Without targets, a table keeps its name (an index
    written ``index:type`` that of the index); a blank entry in the target list also
    means that.  The lists must be equally long.
    """

    def items(names: str | Sequence[str]) -> list[str]:
        return [n.strip() for n in (names.split(",") if isinstance(names, str) else names)]

    from_names = items(sources)
    to_names = items(targets) if targets else [""] * len(from_names)
    if len(from_names) != len(to_names):
        raise ValueError(f"{len(from_names)} source tables but {len(to_names)} target tables")
    require_text(**{f"source table {n}": name for n, name in enumerate(from_names, start=1)})
    named = [t or s.partition(":")[0] for s, t in zip(from_names, to_names)]
    return [TablePair(s, f"{prefix}{t}") for s, t in zip(from_names, named)]
