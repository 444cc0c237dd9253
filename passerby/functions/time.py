"""Epoch seconds to local days and months, in the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_start(seconds: Column) -> Column:
    return F.unix_timestamp(F.date_trunc("day", F.timestamp_seconds(seconds)))


def month_start(seconds: Column) -> Column:
    return F.unix_timestamp(F.date_trunc("month", F.timestamp_seconds(seconds)))


def local_date(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))


def day_number(seconds: Column) -> Column:
    """Whole local days since 1970-01-01: unlike seconds, equally spaced over clock changes."""
    return F.unix_date(local_date(seconds))


def within_day(seconds: Column, day: Column) -> Column:
    """Strictly between a day's midnight and 24 hours later: exact midnight is in no day."""
    return (seconds > day) & (seconds < day + F.lit(24 * 60 * 60))
