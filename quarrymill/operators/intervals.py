"""Time intervals: floors as Column expressions, and iteration over whole intervals.

Intervals are of the wall clock of a zone. Times without a zone in data are UTC; a zone's wall clock skips an hour or shows one twice where it changes, so
a day has 23 to 25 hours, and the two hours of one name are one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = "UTC"


@dataclass(frozen=True)
class Interval:
    """kind: minutes, hours, days, weeks or months; first_day: of weeks, Monday 0."""

    id: int
    name: str
    kind: str
    n: int = 1
    first_day: int = 0
    pattern: str = "yyyy-MM-dd"

    def floor(self, at: datetime) -> datetime:
        day = at.replace(hour=0, minute=0, second=0, microsecond=0)
        if self.kind == "minutes":
            return at.replace(minute=at.minute - at.minute % self.n, second=0, microsecond=0)
        if self.kind == "hours":
            return at.replace(minute=0, second=0, microsecond=0)
        if self.kind == "days":
            return day
        if self.kind == "weeks":
            return day - timedelta(days=(day.weekday() - self.first_day) % 7)
        return day.replace(day=1)

    def next(self, at: datetime, times: int = 1) -> datetime:
        if self.kind == "months":
            month = at.year * 12 + at.month - 1 + times
            return at.replace(year=month // 12, month=month % 12 + 1)
        return at + timedelta(**{self.kind: self.n * times})

    def column(self, ts: Column, anchor: datetime | None = None) -> Column:
        """The start of the interval that holds ts. Intervals of several weeks count from ``anchor``."""
        if self.kind == "minutes":
            hour = F.date_trunc("hour", ts)
            return F.date_trunc("minute", ts) if self.n == 1 else hour + F.make_dt_interval(mins=F.floor(F.minute(ts) / self.n).cast("int") * self.n)
        if self.kind == "hours":
            return F.date_trunc("hour", ts)
        if self.kind == "days":
            return F.date_trunc("day", ts)
        if self.kind == "months":
            return F.date_trunc("month", ts)
        shift = F.make_dt_interval(days=F.lit((7 - self.first_day) % 7))
        week = F.date_trunc("week", ts + shift) - shift
        if self.n == 1:
            return week
        if anchor is None:
            raise ValueError(f"{self.name} counts from the range's start")
        start = F.lit(self.floor(anchor).date())
        spans = F.floor(F.datediff(F.to_date(ts), start) / (7 * self.n)).cast("int")
        return F.date_add(start, spans * (7 * self.n)).cast("timestamp_ntz")

    def label(self, ts: Column) -> Column:
        """The time in this interval's format, not floored."""
        return F.date_format(ts, self.pattern)


_MINUTE, _HOUR = "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH"
#: Interval ids and names.
INTERVALS = (
    Interval(201, "Minutely", "minutes", pattern=_MINUTE),
    Interval(205, "FiveMinutely", "minutes", 5, pattern=_MINUTE),
    Interval(210, "TenMinutely", "minutes", 10, pattern=_MINUTE),
    Interval(230, "HalfHourly", "minutes", 30, pattern=_MINUTE),
    Interval(301, "Hourly", "hours", pattern=_HOUR),
    Interval(401, "Daily", "days"),
    Interval(501, "MondayBasedWeekly", "weeks"),
    Interval(504, "MondayBasedFourWeekly", "weeks", 4),
    Interval(551, "SaturdayBasedWeekly", "weeks", first_day=5),
    Interval(554, "SaturdayBasedFourWeekly", "weeks", 4, 5),
    Interval(561, "SundayBasedWeekly", "weeks", first_day=6),
    Interval(564, "SundayBasedFourWeekly", "weeks", 4, 6),
    Interval(601, "Monthly", "months", pattern="yyyy-MM"),
)
_BY = {k: i for i in INTERVALS for k in (i.id, i.name)}


def interval(key: int | str) -> Interval:
    if key not in _BY:
        raise ValueError(f"unknown interval {key!r}")
    return _BY[key]


def whole_intervals(kind: Interval, start: datetime | None, end: datetime | None, now: datetime, offset: timedelta = timedelta(0)) -> Iterator[tuple[datetime, datetime]]:
    """Intervals that end by ``end`` and by now less the offset; without a start the last finished one only."""
    latest = now - offset
    if start is None:
        at = kind.floor(latest)
        start = kind.floor(kind.next(at, -1))
    at = kind.floor(start)
    stop = latest if end is None else min(end, latest)
    while (to := kind.next(at)) <= stop:
        yield at, to
        at = to


def report_range(kind: Interval, start: datetime, end: datetime, periodic: bool) -> tuple[datetime, datetime]:
    """The floored range. An ad-hoc report's end is in the range with its whole interval; a periodic one's isn't."""
    low, high = kind.floor(start), kind.floor(end)
    return low, high if periodic else kind.next(high)


def to_utc(wall: datetime, zone: str) -> datetime:
    """A zone's wall clock as UTC. A time that the clock skips is that of the change; of one that it shows twice, the first."""
    return wall if zone == UTC else wall.replace(tzinfo=ZoneInfo(zone)).astimezone(timezone.utc).replace(tzinfo=None)


def to_wall(at: datetime, zone: str) -> datetime:
    return at if zone == UTC else at.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def wall_clock(ts: Column, kind: str, zone: str) -> Column:
    """Times in data as a zone's wall clock. kind: the type's name; times with a zone are instants, others are UTC."""
    if zone == UTC:
        return ts
    if kind == "timestamp":
        ts = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=(F.unix_micros(ts) / 1_000_000).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit(UTC), F.lit(zone), ts)


def zoned_intervals(kind: Interval, start: datetime, end: datetime, now: datetime, offset: timedelta = timedelta(0), zone: str = UTC) -> Iterator[tuple[datetime, datetime, datetime]]:
    """(start by the wall clock, start and end in UTC) of whole intervals; the arguments are by the wall clock.

    Minutes and hours are counted in UTC, so that each that passes is there; longer ones are of the clock.
    """
    if zone == UTC or kind.kind not in ("minutes", "hours"):
        for a, b in whole_intervals(kind, start, end, now, offset):
            yield a, to_utc(a, zone), to_utc(b, zone)
        return
    at, stop = to_utc(kind.floor(start), zone), to_utc(min(end, now - offset), zone)
    while (to := kind.next(at)) <= stop:
        yield to_wall(at, zone), at, to
        at = to
