"""Calendar expressions. All of them return DATE unless named otherwise."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date | Column) -> Column:
    """A literal or column as DATE."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def coerce_date(text: Column, fmt: str | None = None) -> Column:
    """Parse text, ISO by default; what does not parse becomes null."""
    trimmed = F.trim(text)
    return trimmed.try_cast("date") if fmt is None else F.try_to_date(trimmed, fmt)


def parse_mixed_date(text: Column) -> Column:
    """Date out of ``m/d/Y`` or ``d/m/Y`` text with an optional time after a blank.

    Month first wins where both readings are possible.
    """
    word = F.split_part(F.trim(text), F.lit(" "), F.lit(1))
    return F.coalesce(F.try_to_date(word, "M/d/yyyy"), F.try_to_date(word, "d/M/yyyy"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def prev_month_end(day: Column) -> Column:
    return F.date_sub(month_start(day), 1)


def week_start(day: Column) -> Column:
    """The Monday on or before the day."""
    return F.trunc(day, "week")


def date_shift(day: Column, days: int | Column) -> Column:
    return F.date_add(day, days)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_to_date(data_date: str) -> list[dt.date]:
    """The days from the first of the data date's month up to the data date."""
    last = dt.date.fromisoformat(data_date)
    return [last.replace(day=day) for day in range(1, last.day + 1)]
