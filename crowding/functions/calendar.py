"""Calendar expressions: hour features, time-of-day bins, month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Time-of-day bins, inclusive hour ranges, in day order. Any
# other hour, and a null hour, falls into the last label.
TIME_WINDOWS = (
    ("early_morning", 0, 6),
    ("morning_peak", 7, 9),
    ("midday", 10, 15),
    ("evening_peak", 16, 19),
)
OTHER_WINDOW = "late_night"
PEAK_WINDOWS = ("morning_peak", "evening_peak")

# Dayofweek numbering, 1 = Sunday ... 7 = Saturday.
WEEKEND_DAYS = (1, 7)


def as_timestamp(df, name: str) -> Column:
    """The column as a wall-clock timestamp (no zone).

    Text is parsed (bad text becomes null, not an error under ANSI); dates and
    zoned timestamps are read at the session zone, which is UTC.
    """
    dtype = dict(df.dtypes)[name]
    if dtype == "timestamp_ntz":
        return F.col(name)
    if dtype == "string":
        return F.try_to_timestamp(F.col(name)).cast(T.TimestampNTZType())
    return F.col(name).cast(T.TimestampNTZType())


def time_window(hour: Column) -> Column:
    expr = None
    for label, lo, hi in TIME_WINDOWS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(OTHER_WINDOW)


def clock_hour(ts: Column, zone: str) -> Column:
    """What the clocks of ``zone`` make of a wall-clock time: plain, skipped or repeated.

    A skipped time was never shown: taken to UTC and back it is another one. A
    repeated time was shown twice: an hour later, or before, the clocks show it
    again. Holds for changes of an hour; a null time gives null. The session
    zone is UTC.
    """
    local = ts.cast("timestamp")
    moment = F.to_utc_timestamp(local, zone)
    hour = F.expr("INTERVAL 1 HOUR")
    again = (F.from_utc_timestamp(moment + hour, zone) == local) | (F.from_utc_timestamp(moment - hour, zone) == local)
    return (
        F.when(local.isNull(), F.lit(None).cast("string"))
        .when(F.from_utc_timestamp(moment, zone) != local, "skipped")
        .when(again, "repeated").otherwise("plain")
    )


def first_of_month(year, month) -> Column:
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return F.make_date(y, m, F.lit(1))


def month_name(year, month) -> Column:
    """English month name, e.g. 'October'."""
    return F.date_format(first_of_month(year, month), "MMMM")


def previous_month_bounds(as_of) -> tuple[Column, Column]:
    """[first day of the previous month, first day of this month) for a date.

    January maps to the previous December through month arithmetic.
    """
    d = F.to_date(F.lit(as_of)) if not isinstance(as_of, Column) else as_of
    this_month = F.trunc(d, "MM")
    return F.add_months(this_month, -1), this_month


def month_label(day) -> Column:
    """'yyyy_MM' label of a date column, e.g. 2001_10."""
    return F.date_format(day, "yyyy_MM")
