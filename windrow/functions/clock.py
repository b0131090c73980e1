"""Epoch numbers, event-time columns, wall-clock texts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from windrow.session import require_utc

_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(duration: str | timedelta) -> int:
    """`'5 minutes'` (one or more `<number> <unit>` pairs) or a timedelta, in microseconds."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    words = duration.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for count, unit in zip(words[::2], words[1::2]):
        size = _UNITS.get(unit.lower().rstrip("s"))
        if size is None:
            raise ValueError(f"unknown unit in {duration!r}")
        total += int(count) * size
    if total <= 0:
        raise ValueError(f"duration must be positive: {duration!r}")
    return total


def interval_text(micros: int) -> str:
    """The interval string `F.window` takes."""
    return f"{micros} microseconds"


def strict_long(text: Column) -> Column:
    """Text to BIGINT by Java's rules: optional sign, digits, 64-bit range; otherwise null.

    The pattern rejects what a plain cast would accept: blanks around the number, fractions.
    """
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))


# fixed values: 0001-01-01 and the last microsecond of 9999, the range that the type documents
FIRST_MICROS, LAST_MICROS = -62_135_596_800_000_000, 253_402_300_799_999_999


def micros_time(micros: Column) -> Column:
    """Epoch microseconds to TIMESTAMP; null outside the years 1 to 9999, where clocks and windows overflow.

    Names its argument three times: give it a column, not a long expression.
    """
    return F.when(micros.between(FIRST_MICROS, LAST_MICROS), F.timestamp_micros(micros))


def millis_micros(millis: Column) -> Column:
    """Epoch milliseconds to microseconds; null beyond 64 bits."""
    return F.try_multiply(millis, F.lit(1000))


def millis_time(millis: Column) -> Column:
    """Epoch milliseconds to TIMESTAMP; null outside the years 1 to 9999."""
    return micros_time(millis_micros(millis))


def event_time(column: Column, unit: str) -> Column:
    """A TIMESTAMP column from an epoch number (`s`, `ms`, `us`) or from a timestamp (`ts`)."""
    if unit == "s":
        first, last = FIRST_MICROS // 1_000_000, LAST_MICROS // 1_000_000
        return F.when(column.between(first, last), F.timestamp_seconds(column))
    if unit == "ms":
        return millis_time(column)
    if unit == "us":
        return micros_time(column)
    if unit == "ts":
        return column.cast("timestamp")
    raise ValueError(f"unit must be s, ms, us or ts, not {unit!r}")


def floor_to(micros: Column, step: int) -> Column:
    """The multiple of `step` at or below an epoch number, also before 1970."""
    return micros - F.pmod(micros, F.lit(step))


def zoned_text(time: Column, pattern: str, zone: str) -> Column:
    """Format an instant as the wall clock of `zone` shows it."""
    require_utc(SparkSession.active())
    return F.date_format(F.from_utc_timestamp(time, zone), pattern)


def jdbc_timestamp_text(time: Column, zone: str = "UTC") -> Column:
    """`yyyy-MM-dd HH:mm:ss.f`: fraction cut of trailing zeros, but never of its first digit."""
    return F.regexp_replace(zoned_text(time, "yyyy-MM-dd HH:mm:ss.SSS", zone), r"0{1,2}\z", "")
