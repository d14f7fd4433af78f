"""Date and time expressions. Weeks start on Monday = 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the date that stands for "no return leg"
NO_RETURN = "2001-01-01T00:00:00"

# fixed values: timestamp layouts that occur in the inputs
PLAIN = "yyyy-MM-dd HH:mm:ss"
ISO = "yyyy-MM-dd'T'HH:mm:ss"
TIME_FIRST = "H:m:s::d/M/yyyy"


def parse_ts(text: Column, layout: str = PLAIN) -> Column:
    """Timestamp without zone; NULL if the text does not fit. ISO texts may have a tail."""
    if layout in (PLAIN, ISO):
        text = F.left(text, F.lit(19))
    return F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """The calendar fields of a timestamp by name."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "weekday": F.weekday(ts),
        "day_of_year": F.dayofyear(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
    }


def first_leg(times: Column) -> Column:
    """First entry of a ``;`` list of ISO times; the no-return date for NULL or empty."""
    first = F.substring_index(F.nullif(times, F.lit("")), ";", 1)
    return parse_ts(F.coalesce(first, F.lit(NO_RETURN)), ISO)


def days_until(later: Column, earlier: Column, zero_if_past_year: bool = False) -> Column:
    """Whole days between two dates; optionally 0 if the later one is in an earlier year."""
    days = F.datediff(F.to_date(later), F.to_date(earlier))
    if zero_if_past_year:
        return F.when(F.year(later) >= F.year(earlier), days).otherwise(0)
    return days


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 as double, microseconds kept."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)
