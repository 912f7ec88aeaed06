"""Dates and times of day in local time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local(ts: Column, tz: str) -> Column:
    return F.from_utc_timestamp(ts, tz)


def service_date(ts: Column, tz: str = "Europe/Moscow") -> Column:
    return F.to_date(local(ts, tz))


def weekday_iso(date: Column) -> Column:
    return (F.weekday(date) + 1).cast("int")


def second_of_day(ts: Column) -> Column:
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def bucket_start(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def clock(seconds: Column) -> Column:
    """HH:MM:SS of a second of day, held to the day."""
    s = F.greatest(F.lit(0), F.least(F.lit(86399), seconds)).cast("int")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int"), (s % 60).cast("int"))


def near_source(observed: Column, source: Column, lag_s: int = 900) -> Column:
    """Whether a provider's stamp is close enough to the time of observation."""
    return F.abs(F.unix_timestamp(observed) - F.unix_timestamp(source)) <= lag_s


def roll_day(observed: Column, stamped: Column) -> Column:
    """A time-only stamp around midnight, moved by a day if it lies over 12 hours off."""
    off = F.unix_timestamp(stamped) - F.unix_timestamp(observed)
    return F.when(off > 43200, stamped - F.expr("INTERVAL 1 DAY")).when(off < -43200, stamped + F.expr("INTERVAL 1 DAY")).otherwise(stamped)
