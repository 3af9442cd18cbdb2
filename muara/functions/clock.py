"""Time expressions over TIMESTAMP_NTZ that give the same answer in every session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 date, optional time, optional fraction, optional offset.
ISO_STAMP = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
OFFSET_AFTER_TIME = r"(:\d{2}([.]\d{1,6})?)(Z|[+-]\d{2}(:?\d{2})?)$"


def at(moment: datetime) -> Column:
    """A clock reading as a foldable literal, so filters on it reach the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def hour_floor(stamp: Column) -> Column:
    return F.timestamp_add("HOUR", F.hour(stamp), stamp.cast("date").cast("timestamp_ntz"))


def micros_between(older: Column, newer: Column) -> Column:
    """By subtraction: ``timestamp_diff`` goes through the session zone and errs in hours it skips."""
    seconds = (newer - older).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def minutes_between(older: Column, newer: Column) -> Column:
    return micros_between(older, newer) / F.lit(60_000_000.0)


def full_hours_between(older: Column, newer: Column) -> Column:
    """Complete hours, rounded toward zero."""
    micros, hour = micros_between(older, newer), F.lit(3_600_000_000)
    return ((micros - micros % hour) / hour).cast("bigint")


def to_instant(wall: Column) -> Column:
    """Read a wall clock as UTC and return the instant (watermarks need TIMESTAMP)."""
    return F.timestamp_micros(micros_between(epoch(), wall))


def from_instant(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch())


def iso_text(wall: Column, suffix: str = "") -> Column:
    return F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit(suffix))


def wall_clock(text: Column) -> Column:
    """The wall clock as written, offset dropped; NULL when the text is not an ISO stamp."""
    bare = F.regexp_replace(text, OFFSET_AFTER_TIME, "$1")
    return F.when(text.rlike(ISO_STAMP), bare.try_cast("timestamp_ntz"))


def local_time(text: Column, zone: str) -> Column:
    """The stamp moved to ``zone`` in whole seconds; a stamp without offset is already local."""
    instant = F.try_to_timestamp(text)
    utc = F.timestamp_add("SECOND", F.unix_seconds(instant), epoch())
    moved = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    local = wall_clock(text)
    fraction = F.pmod(micros_between(epoch(), local), F.lit(1_000_000))
    whole = F.timestamp_add("MICROSECOND", -fraction, local)
    return F.when(
        text.rlike(ISO_STAMP), F.when(text.rlike(OFFSET_AFTER_TIME), moved).otherwise(whole)
    )
