"""Day arithmetic for search windows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_DAY = "yyyy-MM-dd"


def parse_day(text: str | Column, strict: bool = True) -> Column:
    """ISO day to date; a bad value fails the job, or is null if not strict."""
    return F.to_date(text, ISO_DAY) if strict else F.try_to_date(text, ISO_DAY)


def iso_day(day: str | Column) -> Column:
    return F.date_format(day, ISO_DAY)


def days_between(start: Column, end: Column) -> Column:
    """Every day from start to end, both included; none if end is earlier."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))


def next_day(day: str | Column) -> Column:
    """Exclusive end of a one-day window."""
    return F.date_add(day, 1)


# Fixed value: how posts write their time where it is no ISO stamp, behind the day of the week.
POST_TIME = "MMM dd HH:mm:ss Z yyyy"


def event_time(created: str | Column, arrived: str | Column) -> Column:
    """A post's own time, ISO or as ``Tue Mar 18 10:20:30 +0000 2025``; where neither, the broker's time."""
    created = F.col(created) if isinstance(created, str) else created
    arrived = F.col(arrived) if isinstance(arrived, str) else arrived
    named = F.try_to_timestamp(F.regexp_replace(created, "^[A-Za-z]{3} ", ""), F.lit(POST_TIME))
    return F.coalesce(F.try_to_timestamp(created), named, arrived)
