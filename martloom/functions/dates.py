"""Date ids, calendar parts and movable feasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_id(c: Column) -> Column:
    """Date or timestamp as the integer YYYYMMDD; null stays null."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("long")


def sunday_week(c: Column) -> Column:
    """Week of the year counted in Sundays passed, 0 to 53."""
    return F.floor((F.dayofyear(c) - F.dayofweek(c) + 7) / 7).cast("int")


def _field(name: str, span: Column) -> Column:
    return F.extract(F.lit(name), span).cast("long")


def whole_days(start: Column, end: Column) -> Column:
    """Full days from one moment to a later one, whatever the session's time zone."""
    return _field("DAY", end - start)


def whole_hours(start: Column, end: Column) -> Column:
    """Full hours between two moments, toward zero, whatever the session's time zone."""
    return _field("DAY", end - start) * 24 + _field("HOUR", end - start)


EPOCH = "1970-01-01 00:00:00"


def instant_of_utc(c: Column) -> Column:
    """The moment that a zone-less time names in UTC, whatever the session's time zone.

    ``c`` stands here once: where a text is parsed in it, it is parsed once.
    """
    since = c - F.lit(EPOCH).cast("timestamp_ntz")
    return F.timestamp_seconds(since.cast("interval second").cast("decimal(20,6)"))


def utc_of_instant(c: Column) -> Column:
    """The zone-less UTC time of a moment, whatever the session's time zone."""
    micros = F.unix_micros(c)
    seconds = F.floor(micros / 1_000_000).cast("long")
    rest = (micros - seconds * 1_000_000).cast("decimal(18,6)") / 1_000_000
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (seconds.cast("decimal(18,6)") + rest).cast("decimal(18,6)"))
    return F.lit(EPOCH).cast("timestamp_ntz") + span


def as_kind(utc: Column, kind: T.DataType) -> Column:
    """A zone-less UTC time as the given kind of timestamp."""
    return utc if isinstance(kind, T.TimestampNTZType) else instant_of_utc(utc)


def parse_like(text: Column, fmt: str, kind: T.DataType) -> Column:
    """Strictly parse text, which is UTC, to the same kind of timestamp as ``kind``."""
    return as_kind(F.to_timestamp_ntz(text, F.lit(fmt)), kind)


def timestamp_kind(df: DataFrame) -> T.DataType:
    """The kind of timestamp a table uses: zone-less if any of its columns is, else zoned."""
    kinds = [f.dataType for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return next((k for k in kinds if isinstance(k, T.TimestampNTZType)), T.TimestampType())


def _div(a: Column, b: int) -> Column:
    return F.floor(a / b)


def parity_easter(year: Column) -> Column:
    """The feast base of the parity mode: a lunar offset counted from 1 January.

    It falls in January or February and so is not the Christian Easter; it is kept because
    existing reports carry these dates.
    """
    y = year.cast("long")
    # Fixed formula.
    e = F.lit(255) - F.lit(11) * (y % 19)
    days = e % 30 + 21 + (F.lit(6) + (y + _div(y, 4) + _div(e, 30)) % 7) % 7 - 1
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), days.cast("int"))


def gregorian_easter(year: Column) -> Column:
    """Easter Sunday by the anonymous Gregorian computus."""
    y = year.cast("long")
    a, b, c = y % 19, _div(y, 100), y % 100
    d, e = _div(b, 4), b % 4
    g = _div(b - _div(b + 8, 25) + 1, 3)
    h = (a * 19 + b - d - g + 15) % 30
    i, k = _div(c, 4), c % 4
    m = (e * 2 + i * 2 + 32 - h - k) % 7
    n = h + m - _div(a + h * 11 + m * 22, 451) * 7 + 114
    return F.make_date(year, _div(n, 31).cast("int"), (n % 31 + 1).cast("int"))
