"""Instants, local calendar days and release times.

Local time is the instant shifted by the zone's offset, kept as plain seconds: no result
depends on the session time zone, and days and hours are integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Shanghai"
DAY_SECONDS = 86400


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def to_instant(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def local_seconds(seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    """Seconds since 1970-01-01 00:00 on the wall clock of ``zone``."""
    return F.unix_seconds(F.from_utc_timestamp(to_instant(seconds), zone))


def local_day(seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    days = F.floor(local_seconds(seconds, zone) / F.lit(DAY_SECONDS))
    return F.date_from_unix_date(days.cast("int"))


def local_hour(seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    into_day = F.pmod(local_seconds(seconds, zone), F.lit(DAY_SECONDS))
    return F.floor(into_day / F.lit(3600)).cast("int")


def local_minute(seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    into_hour = F.pmod(local_seconds(seconds, zone), F.lit(3600))
    return F.floor(into_hour / F.lit(60)).cast("int")


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1


def naive_seconds(naive: Column) -> Column:
    """Whole epoch seconds of a ``TIMESTAMP_NTZ`` column read as UTC."""
    return F.timestamp_diff("SECOND", _epoch(), naive)


def parse_release(text: Column, zone: str = "UTC") -> Column:
    """Release instant from text; unreadable text gives NULL.

    The text carries no zone: ``zone`` says which wall clock it was written by.
    """
    naive = text.try_cast("timestamp_ntz")
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), naive)
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), utc))


def release_seconds(instant: Column) -> Column:
    return F.unix_micros(instant) / F.lit(1_000_000.0)


def day_number(day: Column) -> Column:
    return F.unix_date(day)
