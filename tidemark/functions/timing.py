"""Time helpers: whole seconds, fixed-width time buckets, day bounds."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400


def whole_seconds(ts: str | Column) -> Column:
    """Epoch seconds, fractions dropped. Also takes timestamps without a zone."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(column.cast("timestamp"))


def bucket_of(seconds: Column, width: int) -> Column:
    """Number of the ``width``-second bucket that holds ``seconds``."""
    w = F.lit(width).cast("long")
    return ((seconds - F.pmod(seconds, w)) / w).cast("long")


def as_date(day: str | date | datetime) -> date:
    if isinstance(day, datetime):
        return day.date()
    return day if isinstance(day, date) else datetime.strptime(day, "%Y-%m-%d").date()


def days_before(day: str | date, n: int) -> str:
    return (as_date(day) - timedelta(days=n)).isoformat()


def midnight(day: str | date) -> datetime:
    d = as_date(day)
    return datetime(d.year, d.month, d.day)


def instant(when: str | date | datetime) -> Column:
    """A constant timestamp in the session time zone; a date means its midnight."""
    if not isinstance(when, datetime):
        when = midnight(when)
    return F.lit(str(when)).cast("timestamp")


def day_bounds(start: str | date, end: str | date) -> tuple[datetime, datetime]:
    """First second of ``start`` and last whole second of ``end``."""
    return midnight(start), midnight(end) + timedelta(days=1, seconds=-1)
