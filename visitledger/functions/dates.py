"""Calendar arithmetic on columns, and the few plain dates a driver needs to choose partitions."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Brazilian Portuguese month and day names (day 1 is Sunday).
MONTHS_SHORT = ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")
DAYS = ("domingo", "segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sábado")


def from_compact(text: Column) -> Column:
    """YYYYMMDD text to a date; bad text raises."""
    return F.to_date(text, "yyyyMMdd")


def minute_from_compact(text: Column) -> Column:
    """YYYYMMDDHHMM text to a timestamp without zone."""
    return F.to_timestamp_ntz(text, F.lit("yyyyMMddHHmm"))


def instant(at: dt.datetime) -> Column:
    """A zone-less timestamp literal; going through text keeps the session time zone out of it."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, without any session time zone in between."""
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000_000
        + (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint") * 1_000_000
        + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    )


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.date_sub(day, F.weekday(day))


def last_closed_sunday(today: Column) -> Column:
    return F.date_sub(today, F.weekday(today) + 1)


def next_month_start(day: Column) -> Column:
    return F.add_months(F.trunc(day, "MM"), 1).cast("date")


def inclusive_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def month_short(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS_SHORT]), F.month(day))


def day_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAYS]), F.dayofweek(day))


def local_time(ts_utc: Column, zone: str) -> Column:
    """Zone-less UTC timestamp seen in the property's time zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc)


def relative_day(text: str, today: dt.date) -> dt.date:
    """``today``, ``yesterday``, ``NdaysAgo`` or an ISO date."""
    if text == "today":
        return today
    if text == "yesterday":
        return today - dt.timedelta(days=1)
    if text.endswith("daysAgo"):
        return today - dt.timedelta(days=int(text.removesuffix("daysAgo")))
    return dt.date.fromisoformat(text)


class Week(NamedTuple):
    """Monday and Sunday of a week."""

    monday: dt.date
    sunday: dt.date

    @classmethod
    def of(cls, day: dt.date) -> Week:
        """The week a day lies in, by its ISO number."""
        year, number, _ = day.isocalendar()
        return cls(*(dt.date.fromisocalendar(year, number, n) for n in (1, 7)))

    def earlier(self, weeks: int = 1) -> Week:
        return Week(*(day - dt.timedelta(weeks=weeks) for day in self))


def reference_week(today: dt.date, sunday: dt.date | None = None) -> Week:
    """The last week that is over, or the week of the given Sunday."""
    return Week.of(sunday) if sunday else Week.of(today).earlier()
