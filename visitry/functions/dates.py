"""Date and time expressions on zone-free timestamps; clocks are always parameters."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, functions as F

EPOCH = "1970-01-01 00:00:00"
# Start of the default time range, and the offset of schedule texts.
RANGE_START = datetime(2000, 1, 1)
SCHEDULE_OFFSET_HOURS = 8


def ntz(moment: datetime | date | str) -> Column:
    """Zone-free timestamp literal (folds to a constant, so it reaches the scan)."""
    return F.lit(str(as_datetime(moment))).cast("timestamp_ntz")


def as_datetime(moment: datetime | date | str) -> datetime:
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if not isinstance(moment, datetime):
        moment = datetime.combine(moment, time())
    return moment


def epoch_micros_to_ts(c: Column) -> Column:
    """Microseconds since the epoch to a timestamp, cut to whole seconds."""
    return F.timestamp_add("SECOND", F.floor(c / 1_000_000), F.lit(EPOCH).cast("timestamp_ntz"))


def parse_date_time(d: Column, t: Column) -> Column:
    """``yyyyMMdd`` and ``HH:mm:ss`` texts to one timestamp."""
    return F.to_timestamp_ntz(F.concat_ws(" ", d, t), F.lit("yyyyMMdd HH:mm:ss"))


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def schedule_to_ts(c: Column, offset_hours: int = SCHEDULE_OFFSET_HOURS) -> Column:
    """``cron(minute hour day month ? year)`` to a local timestamp."""
    parts = F.split(F.regexp_replace(c, r"cron|[()]| \?", ""), " ")
    minute, hour, day, month, year = (F.get(parts, F.lit(i)).try_cast("int") for i in range(5))
    utc = F.make_timestamp_ntz(year, month, day, hour, minute, F.lit(0).cast("decimal(16,6)"))
    return F.timestamp_add("HOUR", F.lit(offset_hours), utc)


def new_customer_flag(joined: Column, money: Column, as_of: date) -> Column:
    """Joined within the month before ``as_of`` and has spent something."""
    return (joined > F.add_months(F.lit(as_of), -1)) & (money > 0)


def resolve_range(
    time_range: Mapping | None, as_of: datetime | date | str
) -> tuple[datetime, datetime]:
    """Start and end of a rule's time range, worked out on the driver.

    The last N days end at ``as_of``; explicit bounds are taken as given (a
    plain date means midnight); without a range: from 2000-01-01 to ``as_of``.
    """
    now = as_datetime(as_of)
    if not time_range:
        return RANGE_START, now
    if time_range.get("days"):
        return now - timedelta(days=time_range["days"]), now
    start, end = time_range.get("start_time"), time_range.get("end_time")
    return (as_datetime(start) if start else RANGE_START, as_datetime(end) if end else now)


def between_times(c: Column, start: datetime, end: datetime, is_date: bool) -> Column:
    """``start <= c <= end``. Date columns get date bounds, which push down to the scan."""
    if is_date:
        first = start.date() if start.time() == time() else start.date() + timedelta(days=1)
        return c.between(F.lit(first), F.lit(end.date()))
    return c.between(ntz(start), ntz(end))
