"""ISO-8601 text to and from timestamps, with Python's ``isoformat`` rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_text(moment: Column) -> Column:
    """Six fractional digits when there are any microseconds, none otherwise.

    Built on the cast to text, which prints wall-clock timestamps as they are;
    pattern formatting would take them through the session's time zone.
    """
    text = F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def iso_seconds(moment: Column) -> Column:
    """Whole seconds, the fraction cut off."""
    return F.substring(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), 1, 19)


def iso_date(moment: Column) -> Column:
    return moment.cast("date").cast("string")


def moment_of(text: Column) -> Column:
    """Read ISO text without its fractional seconds; null when it is no timestamp."""
    return F.split_part(text, F.lit("."), F.lit(1)).try_cast("timestamp_ntz")


def wall_seconds(moment: Column) -> Column:
    """Seconds since 1970 on the wall clock, whatever the session time zone."""
    days = F.datediff(moment, F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def moment_at(seconds: Column) -> Column:
    """Inverse of :func:`wall_seconds`."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return start + F.make_dt_interval(
        (seconds / 86400).cast("int"), zero, zero, (seconds % 86400).cast("decimal(18,6)")
    )
