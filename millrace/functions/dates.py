"""Calendar expressions; all of them work on zone-less timestamps without a zone conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start: Column | str, stop: Column | str) -> Column:
    """Minute boundaries crossed from start to stop (seconds within the minute do not count)."""

    def minute_of_day(c: Column) -> Column:
        return F.hour(c) * 60 + F.minute(c)

    a, b = _c(start), _c(stop)
    days = F.datediff(b.cast("date"), a.cast("date")).cast("bigint")
    return days * 1440 + minute_of_day(b) - minute_of_day(a)


def date_key(c: Column | str) -> Column:
    """yyyymmdd as a number."""
    d = _c(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def month_name(c: Column | str) -> Column:
    """Three-letter English month."""
    return F.monthname(_c(c))


def day_of_week(c: Column | str) -> Column:
    """Sunday is 0."""
    return (F.dayofweek(_c(c)) - 1).cast("bigint")
