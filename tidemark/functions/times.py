"""Date and time column functions. The session zone is UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday abbreviation -> label that sorts Monday first.
WEEKDAY_LABELS = {
    "Mon": "1-Mon",
    "Tue": "2-Tue",
    "Wed": "3-Wed",
    "Thu": "4-Thu",
    "Fri": "5-Fri",
    "Sat": "6-Sat",
    "Sun": "7-Sun",
}


def moment(at: datetime) -> Column:
    """A fixed stamp; one without a zone is UTC whatever the driver's zone is."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def micros_to_timestamp(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def millis_to_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the ``[start, start + seconds)`` bucket holding ``ts``, in epoch seconds."""
    epoch = epoch_seconds(ts)
    return epoch - F.pmod(epoch, F.lit(seconds))


def label_bucket(ts: Column, seconds: int, label: str = "end") -> Column:
    """Start or end of the ``(start, end]`` bucket of a period-end stamp.

    Rollups read stamps that mark the *end* of the period below, so a stamp
    exactly on the hour belongs to the hour that just finished: hence the one
    second taken off before bucketing.
    """
    if label not in ("start", "end"):
        raise ValueError(f"label must be 'start' or 'end', got {label!r}")
    start = bucket_start(ts.cast("timestamp") - F.expr("interval 1 second"), seconds)
    return F.timestamp_seconds(start + seconds if label == "end" else start)


def stamp(ts: Column) -> Column:
    """Plain text form, without zone or type differences between engines."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def weekday_label(day: Column) -> Column:
    """``Mon`` as ``1-Mon`` and so on, so that text order is calendar order."""
    pairs = [F.lit(x) for item in WEEKDAY_LABELS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), day)


def calendar_parts(ts: Column) -> list[Column]:
    """Partition columns of a typed stamp."""
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
    ]


def sane_time(ts: Column) -> Column:
    """True for stamps after the epoch and before the far-future corrupt ones."""
    # Bounds outside which a device stamp counts as corrupt.
    return (ts > F.lit("1970-01-01 00:00:00").cast("timestamp")) & (
        ts < F.lit("2339-03-21 22:20:00").cast("timestamp")
    )
