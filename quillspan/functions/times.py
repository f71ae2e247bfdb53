"""Instants: milliseconds since 1970 as longs, ISO strings in UTC, hours and days. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), ISO)


def parse_utc(text: Column) -> Column:
    """Seconds since 1970 as a double; 0 for null and for what isn't an ISO instant."""
    return F.coalesce(F.unix_timestamp(F.try_to_timestamp(text, F.lit(ISO))).cast("double"), F.lit(0.0))


def millis(ts: Column) -> Column:
    """Milliseconds of a timestamp, rounded down."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.round((micros - F.pmod(micros, F.lit(1000))) / F.lit(1000)).cast("long")


def hour_key(ms: Column) -> Column:
    """Hours since 1970, rounded down for instants before it too."""
    return (ms - F.pmod(ms, F.lit(3_600_000))).cast("long") / F.lit(3_600_000)


def hour_number(ms: Column) -> Column:
    return hour_key(ms).cast("long")


def hour_of_day(ms: Column) -> Column:
    return F.pmod(hour_number(ms), F.lit(24))


def day(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")
