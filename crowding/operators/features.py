"""Hourly station facts, calendar features, month totals and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import WEEKEND_DAYS, as_timestamp, time_window
from ._joins import join_on_keys
from .numbering import group_ranks

HOUR_KEYS = ["station_complex", "station_complex_id", "transit_timestamp", "borough"]
NAME_MONTH = ["station_complex", "year", "month"]


def keep_mode(raw: DataFrame, mode: str = "subway") -> DataFrame:
    """Keep one transit mode (pushed to the Parquet scan)."""
    return raw.filter(F.col("transit_mode") == mode)


def mode_rows(raw: DataFrame, mode: str = "subway") -> DataFrame:
    """Rows of one transit mode, with their time as a timestamp."""
    return keep_mode(raw, mode).withColumn("transit_timestamp", as_timestamp(raw, "transit_timestamp"))


def hourly_fact(raw: DataFrame, mode: str = "subway") -> DataFrame:
    """Ridership per station-hour, merging payment and fare-class rows.

    One hash aggregate with a map-side partial sum: the shuffle carries at
    most one row per station-hour per input split, so a station holding a
    large share of the raw rows is reduced before it leaves its tasks.
    """
    return mode_rows(raw, mode).groupBy(*HOUR_KEYS).agg(F.sum("ridership").alias("ridership"))


def time_features(hours: DataFrame) -> DataFrame:
    """hour_of_day, day_of_week (1 = Sunday), is_weekend, month, year, time_window."""
    ts = F.col("transit_timestamp")
    hour = F.hour(ts)
    dow = F.dayofweek(ts)
    return hours.select(
        *hours.columns,
        hour.alias("hour_of_day"),
        dow.alias("day_of_week"),
        dow.isin(*WEEKEND_DAYS).cast("int").alias("is_weekend"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        time_window(hour).alias("time_window"),
    )


def monthly_totals(hours: DataFrame) -> DataFrame:
    """Station-name x month ridership totals (partial + final aggregate)."""
    return hours.groupBy(*NAME_MONTH).agg(F.sum("ridership").alias("monthly_ridership"))


def rank_in_month(totals: DataFrame) -> DataFrame:
    """Dense rank of station totals within each month, largest first.

    Runs at station-month grain: a month partition holds one row per station,
    not one per station-hour.
    """
    w = Window.partitionBy("year", "month").orderBy(F.col("monthly_ridership").desc_nulls_last())
    return totals.withColumn("monthly_rank", F.dense_rank().over(w))


def monthly_total_rank(hours: DataFrame) -> DataFrame:
    """Attach the month total and rank to every hour row.

    Totals are aggregated and ranked at station-month grain, then joined back
    on (station_complex, year, month), null-safe like the window partition it
    replaces. The ranked side has one row per station-month, so no task gets
    more than its even share of it: it is hashed, and hour rows need no sort.
    A station with many hours is still split over tasks by AQE.
    """
    ranked = rank_in_month(monthly_totals(hours)).hint("shuffle_hash")
    return join_on_keys(hours, ranked, NAME_MONTH, how="left", null_safe=True)


def hour_ranks(hours: DataFrame) -> DataFrame:
    """Dense rank (largest first) and percent rank (smallest first) of every hour row in its month.

    A month of hour rows is too large a group for one window task, so the ranks
    come from ``group_ranks``. Null ridership ranks last, and lowest.
    """
    month = ["year", "month"]
    dense = group_ranks(hours, month, "ridership", descending=True, nulls_last=True, dense="hour_rank", percent="_p")
    return group_ranks(dense.drop("_p"), month, "ridership", dense="_d", percent="hour_pctl").drop("_d")


HOURS_COLUMNS = [
    "station_complex",
    "station_complex_id",
    "transit_timestamp",
    "borough",
    "ridership",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "month",
    "year",
    "time_window",
    "monthly_ridership",
    "monthly_rank",
]


def ridership_transformed(raw: DataFrame, mode: str = "subway") -> DataFrame:
    """The hourly fact table with features, month totals and ranks (C2 + C3)."""
    return monthly_total_rank(time_features(hourly_fact(raw, mode))).select(*HOURS_COLUMNS)
