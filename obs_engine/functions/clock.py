"""Literal time bounds derived from a run's clock, so that they prune partitions."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta, timezone


def clock(as_of: datetime | None) -> datetime:
    """``as_of`` in UTC; the wall clock when omitted. A naive value is UTC."""
    if as_of is None:
        return datetime.now(timezone.utc)
    return (as_of.replace(tzinfo=timezone.utc) if as_of.tzinfo is None
            else as_of.astimezone(timezone.utc))


def months_before(moment: datetime, months: int) -> datetime:
    """Same day and time some months earlier, clamped to the month's last day."""
    index = moment.year * 12 + moment.month - 1 - months
    year, month = divmod(index, 12)
    day = min(moment.day, calendar.monthrange(year, month + 1)[1])
    return moment.replace(year=year, month=month + 1, day=day)


def first_day_from(moment: datetime) -> date:
    """The first day whose midnight is not before ``moment``."""
    midnight = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    return (midnight if midnight == moment else midnight + timedelta(days=1)).date()
