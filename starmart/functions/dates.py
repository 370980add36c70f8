"""Dates: tolerant parsing and calendar keys.

Source texts may be dirty and ANSI mode throws on a bad cast, so parsing is
always the ``try_`` form: unreadable text becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed value: shape of a full timestamp; ``2020-1-7 9:00:00`` is one too ----
TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$"


def parse_date(text: str | Column) -> Column:
    return F.trim(text).try_cast("date")


def parse_timestamp(text: str | Column) -> Column:
    """Full timestamps only. Checking the shape and casting is about twice as fast as a format pattern."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(TIMESTAMP_SHAPE), trimmed.try_cast("timestamp"))


def date_key(date: str | Column) -> Column:
    """``yyyyMMdd`` as an integer."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def date_id(date: str | Column) -> Column:
    """``yyyyMMdd`` as text."""
    return F.date_format(date, "yyyyMMdd")


def month_id(date: str | Column) -> Column:
    """``yyyyMM`` as text."""
    return F.date_format(date, "yyyyMM")


def is_weekend(date: str | Column) -> Column:
    return F.weekday(date) >= 5


def week_start(date: str | Column) -> Column:
    """The Monday on or before ``date``."""
    return F.trunc(date, "week")
