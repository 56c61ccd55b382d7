"""Calendar and clock expressions (column in -> column out).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
PostgreSQL conventions the reports depend on are made explicit here:
weekday 0 = Sunday, blank-padded lower-case day names, HALF_UP numerics.
"""

from __future__ import annotations

import calendar as _cal
import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month names used when a report is asked for Spanish
# labels (January first).
SPANISH_MONTHS = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]

# Fixed value: open end date of a current dimension row.
OPEN_END_DATE = _dt.date(2099, 12, 31)

_MICROS_PER_MINUTE = 60_000_000
_MICROS_PER_HOUR = 3_600_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(value: _dt.date | str) -> _dt.date:
    """Accept ``date`` or ISO string for ``as_of`` parameters."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def days_before(as_of: _dt.date | str, days: int) -> _dt.date:
    """``as_of - INTERVAL 'n days'`` as a literal date (midnight when compared)."""
    return as_date(as_of) - _dt.timedelta(days=days)


def months_before(as_of: _dt.date | str, months: int) -> _dt.date:
    """``as_of - INTERVAL 'n months'``; the day clamps to the month's end."""
    d = as_date(as_of)
    total = d.year * 12 + (d.month - 1) - months
    year, month = divmod(total, 12)
    month += 1
    day = min(d.day, _cal.monthrange(year, month)[1])
    return _dt.date(year, month, day)


def parse_datetime(col: Column | str, fmt: str | None = None) -> Column:
    """Text (or a timestamp) to TIMESTAMP_NTZ; unparseable text gives NULL.

    The wall-clock time is kept in any session zone, also where it falls
    into a zone's summer-time gap.
    """
    c = _c(col).cast("string")
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    return F.when(F.try_to_timestamp(c, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))


def pg_dow(ts: Column | str) -> Column:
    """PostgreSQL ``EXTRACT(DOW ...)``: 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(ts)) - 1


def iso_weekday(d: Column | str) -> Column:
    """ISO weekday: 1 = Monday ... 7 = Sunday."""
    return F.weekday(_c(d)) + 1


def is_weekend(d: Column | str) -> Column:
    return iso_weekday(d) >= 6


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Exact signed minutes ``end - start`` as DECIMAL (no float error)."""
    return micros_between(start, end).cast("decimal(20,0)") / F.lit(_MICROS_PER_MINUTE)


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Exact signed hours ``end - start`` as DECIMAL."""
    return micros_between(start, end).cast("decimal(20,0)") / F.lit(_MICROS_PER_HOUR)


def month_trunc(ts: Column | str) -> Column:
    """``date_trunc('month', ts)`` as TIMESTAMP_NTZ, independent of the session time zone.

    Truncates the calendar date (``trunc``) instead of ``date_trunc``, which
    returns a zoned timestamp and goes through the session zone.
    """
    return F.trunc(F.to_date(_c(ts)), "month").cast("timestamp_ntz")


def ntz_literal(value: _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal that no time zone can shift (built from text)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def weekday_name_pg(ts: Column | str) -> Column:
    """``to_char(ts, 'day')``: lower-case English name blank-padded to 9."""
    return F.rpad(F.lower(F.date_format(_c(ts), "EEEE")), 9, " ")


def day_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "EEEE")


def month_name(d: Column | str, lang: str = "en") -> Column:
    """Full month name; English by default, Spanish with ``lang='es'``."""
    if lang == "es":
        return F.element_at(F.array(*[F.lit(m) for m in SPANISH_MONTHS]), F.month(_c(d)))
    return F.date_format(_c(d), "MMMM")


def period_label(ts: Column | str) -> Column:
    """Month label ``MM yyyy`` of the trend report."""
    return F.date_format(_c(ts), "MM yyyy")


def date_key(ts: Column | str) -> Column:
    """``yyyymmdd`` integer key of a date or timestamp."""
    c = _c(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def time_key(ts: Column | str) -> Column:
    """Hour-grain time key: ``hour * 100``."""
    return (F.hour(_c(ts)) * 100).cast("int")


def months_by_calendar(as_of: _dt.date | str, d: Column | str) -> Column:
    """Whole calendar months from ``d`` to ``as_of``; the day of month is ignored."""
    ref = as_date(as_of)
    c = _c(d)
    return ((F.lit(ref.year) - F.year(c)) * 12 + (F.lit(ref.month) - F.month(c))).cast("int")


def quarter(d: Column | str) -> Column:
    return F.quarter(_c(d))


def iso_week(d: Column | str) -> Column:
    return F.weekofyear(_c(d))


def time_of_day(hour: Column | str) -> Column:
    """Four day parts by hour: <6, <12, <18, rest."""
    h = _c(hour)
    return (
        F.when(h < 6, "Madrugada")
        .when(h < 12, "Mañana")
        .when(h < 18, "Tarde")
        .otherwise("Noche")
    )


def is_business_hour(hour: Column | str) -> Column:
    h = _c(hour)
    return (h >= 8) & (h < 18)


def shift(hour: Column | str) -> Column:
    """Three shifts: 6-13, 14-21, the rest."""
    h = _c(hour)
    return (
        F.when((h >= 6) & (h < 14), "Turno 1")
        .when((h >= 14) & (h < 22), "Turno 2")
        .otherwise("Turno 3")
    )


def am_pm(hour: Column | str) -> Column:
    return F.when(_c(hour) < 12, "AM").otherwise("PM")


def hour_24_label(hour: Column | str) -> Column:
    return F.format_string("%02d:00", _c(hour))


def hour_12_label(hour: Column | str) -> Column:
    h = _c(hour)
    h12 = F.when(h % 12 == 0, 12).otherwise(h % 12)
    return F.format_string("%02d:00 %s", h12, am_pm(h))


def day_mask(date: Column | str) -> Column:
    """The day of the month as one bit; masks of a month are joined with ``bit_or``."""
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(date) - 1)


def days_in_mask(mask: Column | str) -> Column:
    """How many days a mask holds."""
    return F.bit_count(mask)
