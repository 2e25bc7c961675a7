"""ISO-like date text and provider epoch values as UTC timestamps.

Everything is arithmetic on built-in expressions. Text that does not parse gives
NULL. Timestamps are read and cut to days in UTC, so the session time zone must
be UTC (see :func:`guichet.session.require_utc`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions.text import strip

_OFFSET = r"(?:Z|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.\d+)?)?)?)?"
_CLOCK = r"(\d{2})(?::(\d{2})(?::(\d{2}))?|(\d{2})(\d{2})?)?(?:[.,](\d+))?"
_CALENDAR_DAY = r"(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
_WEEK_DAY = r"(\d{4})(?:-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)"
_TAIL = rf"(?:.(?:{_CLOCK})\s?{_OFFSET})?"
_FULL_CALENDAR = rf"(?s)^{_CALENDAR_DAY}{_TAIL}$"
_FULL_WEEK = rf"(?s)^{_WEEK_DAY}{_TAIL}$"

# The everyday spelling, which the cast to TIMESTAMP reads by itself.
_PLAIN = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?)?$"

_DAY_SECONDS = 86_400

# The capture groups of either spelling, brought to one list: day, hour, minute,
# second, fraction, sign and offset. A group that took no part leaves its place empty.
_CLOCK_PARTS = "/$6/$7$9/$8$10/$11/$12/$13/$14/$15"
_CALENDAR_PARTS = "$1-$2$4-$3$5" + _CLOCK_PARTS
_WEEK_PARTS = "$1:$2$4:$3$5" + _CLOCK_PARTS


def _number(part: Column) -> Column:
    return F.coalesce(F.nullif(part, F.lit("")).cast("int"), F.lit(0))


def _calendar_day(part: Column) -> Column:
    return F.when(~part.startswith("0000"), part.try_cast("date"))


def _week_day(part: Column) -> Column:
    year, week = (_number(F.split_part(part, F.lit(":"), F.lit(i))) for i in (1, 2))
    weekday = F.coalesce(F.nullif(F.split_part(part, F.lit(":"), F.lit(3)), F.lit("")).cast("int"), F.lit(1))
    first_monday = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    # Week 53 exists only in years whose last Thursday falls in it.
    thursday = F.date_add(first_monday, (week - 1) * 7 + 3)
    exists = week.between(1, 53) & (F.year(thursday) == year) & weekday.between(1, 7) & (year > 0)
    return F.when(exists, F.date_add(thursday, weekday - 4))


def _instant(parts: Column, day_of) -> Column:
    """UTC timestamp of the listed parts, NULL where one is out of range."""
    hour, minute, second = (_number(parts[i]) for i in (1, 2, 3))
    off_hour, off_minute, off_second = (_number(parts[i]) for i in (6, 7, 8))
    seconds = hour.cast("long") * 3600 + minute * 60 + second
    offset = off_hour.cast("long") * 3600 + off_minute * 60 + off_second
    fraction = F.rpad(F.substring(parts[4], 1, 6), 6, "0").cast("int")
    valid = (hour < 24) & (minute < 60) & (second < 60) & (offset < _DAY_SECONDS) & (off_minute < 60) & (off_second < 60)
    days = F.unix_date(day_of(parts[0])).cast("long") * _DAY_SECONDS
    total = days + seconds + F.when(parts[5] == "-", offset).otherwise(-offset)
    return F.when(valid, F.timestamp_micros(total * 1_000_000 + fraction))


def _parse_unusual(text: Column, pattern: str, parts: str, day_of) -> Column:
    listed = F.array(F.split(F.regexp_replace(text, pattern, parts), "/"))
    return F.get(F.transform(listed, lambda p: _instant(p, day_of)), 0)


def parse_iso(c: Column) -> Column:
    """TIMESTAMP of ISO 8601 text in extended, basic or week form; no zone means UTC."""
    text = strip(c)
    return (
        F.when(text.rlike(_PLAIN), F.when(~text.startswith("0000"), text.try_cast("timestamp")))
        .when(text.rlike(_FULL_CALENDAR), _parse_unusual(text, _FULL_CALENDAR, _CALENDAR_PARTS, _calendar_day))
        .when(text.rlike(_FULL_WEEK), _parse_unusual(text, _FULL_WEEK, _WEEK_PARTS, _week_day))
    )


def parse_epoch(seconds_or_millis: Column) -> Column:
    """TIMESTAMP of a positive epoch number; large values are milliseconds."""
    value = seconds_or_millis.cast("double")
    seconds = F.when(value > fv.EPOCH_MILLIS_ABOVE, value / 1000).otherwise(value)
    # The upper bound is the last second of year 9999; NaN compares above it.
    return F.when((value > 0) & (seconds < 253_402_300_800), F.timestamp_micros(F.rint(seconds * 1_000_000).cast("long")))


def utc_date(c: Column, data_type: str) -> Column:
    """Creation day in UTC of a text, date or timestamp column; anything else gives NULL."""
    if data_type == "string":
        return F.to_date(parse_iso(c))
    if data_type in ("timestamp", "timestamp_ntz", "date"):
        return F.to_date(c)
    return F.lit(None).cast("date")
