"""Calendar and clock expressions over zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MONTH_LABELS = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)
WEEKEND_DAYS = (0, 6)  # Sunday is 0
RUSH_HOURS = (7, 8, 17, 18)
NIGHT_STARTS = 20
NIGHT_ENDS = 6


def minute_index(ts: Column) -> Column:
    """Number of the minute a timestamp lies in (sessions are pinned to UTC).

    Plain integer arithmetic: several times cheaper per row than truncating
    and differencing timestamps, and it floors before 1970 as well.
    """
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / 60)


def hour_index(ts: Column) -> Column:
    """Number of the hour a timestamp lies in: one long instead of date and hour."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / 3600)


def hour_index_of(date: Column, hour: Column) -> Column:
    """The same number from a date and an hour of the day."""
    return F.unix_date(date).cast("bigint") * 24 + hour


def boundary_minutes(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 10:00:59 -> 10:01:00 is 1, not 0."""
    return (minute_index(end) - minute_index(start)).cast("int")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(ts) - 1


def _true_only(condition: Column) -> Column:
    # An unknown condition counts as false.
    return F.when(condition, True).otherwise(False)


def is_night(hour: Column) -> Column:
    return _true_only((hour >= NIGHT_STARTS) | (hour < NIGHT_ENDS))


def is_weekend(dow: Column) -> Column:
    return _true_only(dow.isin(*WEEKEND_DAYS))


def is_rush_hour(dow: Column, hour: Column) -> Column:
    return _true_only(~dow.isin(*WEEKEND_DAYS) & hour.isin(*RUSH_HOURS))


def month_label(month: Column) -> Column:
    """1..12 -> Jan..Dec; anything else is NULL."""
    return F.get(F.array(*[F.lit(m) for m in MONTH_LABELS]), month - 1)


def parse_local_timestamp(text: Column, pattern: str = "yyyy-MM-dd'T'HH:mm") -> Column:
    """ISO text -> zone-less timestamp, so a skipped DST hour stays as written."""
    return F.to_timestamp_ntz(text, F.lit(pattern))
