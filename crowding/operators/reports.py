"""Report tables behind the dashboard (C11-C20).

Each report is ``(hours, csi, **params) -> DataFrame`` and stays lazy. Ties
in every top-k are broken by station name, then year and month, so results
do not depend on file order. The latest month enters as scalar subqueries,
which also prune (year, month) partitions of a lake scan at run time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import first_of_month, month_name
from ..functions.numeric import is_missing, rank_key, stable_round
from ..sources.slices import time_range
from ._joins import join_on_keys
from .features import keep_mode

NAME_MONTH = ["station_complex", "year", "month"]
TREND_METRICS = ["peak_hr_ridership", "csi_6mo_rolling", "apt_6mo_rolling"]


def _present(col: str) -> Column:
    return ~is_missing(col, "double")


# -- C11 ---------------------------------------------------------------------
def borough_totals(raw: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Total subway ridership per borough of each year from first to last, largest first.

    Raw rows add up straight to (year, borough); the time range is a plain
    comparison, so it reaches the scan.
    """
    span = time_range(raw, "transit_timestamp", _dt.date(first_year, 1, 1), _dt.date(last_year + 1, 1, 1))
    return (
        keep_mode(span)
        .filter(F.col("borough").isNotNull())
        .groupBy(F.year("transit_timestamp").alias("year"), "borough")
        .agg(F.sum("ridership").alias("total_ridership"))
        .orderBy("year", rank_key("total_ridership").desc(), "borough")
    )


# -- C12 ---------------------------------------------------------------------
def flagged_by_csi(csi: DataFrame, k: int = 10) -> DataFrame:
    """Top-k flagged station-months by CSI."""
    return (
        csi.filter(F.col("danger_zone") == 1)
        .select(
            "station_complex", "year", "month", "volume_component",
            "hhi_monthly_concentration", "csi", "apt_minutes",
        )
        .orderBy(rank_key("csi").desc_nulls_last(), "station_complex", "year", "month")
        .limit(k)
    )


def flagged_by_apt(csi: DataFrame, k: int = 10) -> DataFrame:
    """Top-k flagged station-months by APT minutes."""
    return (
        csi.filter(F.col("danger_zone") == 1)
        .select("station_complex", "year", "month", "csi", "apt_minutes")
        .orderBy(rank_key("apt_minutes").desc_nulls_last(), "station_complex", "year", "month")
        .limit(k)
    )


# -- A16 / L3 / L6 ---------------------------------------------------------------
def best_row_per_station(df: DataFrame, metric: str, keep: list[str]) -> DataFrame:
    """The row with the largest ``metric`` per station name (earliest month on ties).

    A hash aggregate with ``max_by`` over a composite ordering key: partial
    aggregation per task, no sort of a station's rows; rows with a null or
    NaN metric are skipped.
    """
    order = F.struct(rank_key(metric), -F.col("year"), -F.col("month"))
    best = F.max_by(F.struct(*[F.col(c) for c in keep]), order)
    return (
        df.filter(_present(metric))
        .groupBy("station_complex")
        .agg(best.alias("_best"))
        .select("station_complex", *[F.col(f"_best.{c}").alias(c) for c in keep])
    )


def top_station_months(csi: DataFrame, k: int = 5) -> DataFrame:
    """Stations whose best month has the highest CSI: top k of the argmax rows."""
    best = best_row_per_station(csi, "csi", ["year", "month", "csi"])
    return best.orderBy(rank_key("csi").desc(), "station_complex").limit(k)


# -- C13 ---------------------------------------------------------------------
def _stations_of(hours: DataFrame, stations: DataFrame, year=None, month=None) -> DataFrame:
    names = stations.select("station_complex").distinct()
    out = hours.join(names, "station_complex", "left_semi").filter(
        F.col("day_of_week").isNotNull() & F.col("hour_of_day").isNotNull()
    )
    if year is not None:
        out = out.filter(F.col("year") == year)
    if month is not None:
        out = out.filter(F.col("month") == month)
    return out


def heatmap_long(hours: DataFrame, stations: DataFrame, year=None, month=None) -> DataFrame:
    """Mean hourly ridership by station x weekday x hour.

    All months by default (the dashboard's behaviour); ``year``/``month``
    restrict it to one period."""
    return (
        _stations_of(hours, stations, year, month)
        .groupBy("station_complex", "day_of_week", "hour_of_day")
        .agg(F.avg("ridership").alias("avg_ridership"))
    )


def heatmap_pivot(hours: DataFrame, stations: DataFrame, year=None, month=None) -> DataFrame:
    """Weekday rows x 24 hour columns h00..h23 of mean ridership (null if empty)."""
    hours_list = list(range(24))
    wide = (
        _stations_of(hours, stations, year, month)
        .groupBy("station_complex", "day_of_week")
        .pivot("hour_of_day", hours_list)
        .agg(F.avg("ridership"))
    )
    return wide.select(
        "station_complex",
        "day_of_week",
        *[F.col(str(h)).alias(f"h{h:02d}") for h in hours_list],
    )


def heatmap_range(long: DataFrame) -> DataFrame:
    """Shared colour range of the heatmaps: min and max cell value."""
    return long.agg(
        F.min("avg_ridership").alias("vmin"), F.max("avg_ridership").alias("vmax")
    )


# -- A15 / C14 -----------------------------------------------------------------
def latest_month_key(csi: DataFrame) -> DataFrame:
    """One row: the latest (year, month) present."""
    return csi.agg(F.max(F.struct("year", "month")).alias("ym")).select(
        F.col("ym.year").alias("year"), F.col("ym.month").alias("month")
    )


def latest_month(csi: DataFrame) -> DataFrame:
    """Latest year, latest month in it, and the month's English name."""
    return latest_month_key(csi).withColumn("month_name", month_name("year", "month"))


def in_month(df: DataFrame, csi: DataFrame, month: tuple[int, int] | None = None) -> DataFrame:
    """Rows of ``df`` in ``month`` (year, month); by default the latest of ``csi``.

    Plain comparisons of the partition columns with literals or scalar
    subqueries, so a scan of a table partitioned by (year, month) reads one.
    """
    if month is not None:
        year, number = (F.lit(v) for v in month)
    else:
        latest = csi.agg(F.max(F.struct("year", "month")).alias("ym"))
        year, number = latest.select("ym.year").scalar(), latest.select("ym.month").scalar()
    return df.filter((F.col("year") == year) & (F.col("month") == number))


def month_table(csi: DataFrame, totals: DataFrame, month: tuple[int, int] | None = None) -> DataFrame:
    """A month's CSI rows with the station's monthly ridership (default: the latest).

    ``totals`` has ``monthly_ridership`` per station name, year and month.
    """
    own = in_month(totals, csi, month).select(*NAME_MONTH, "monthly_ridership")
    return join_on_keys(in_month(csi, csi, month), own, NAME_MONTH, how="left")


# -- C15 ---------------------------------------------------------------------
def _fmt(col: str, digits: int) -> Column:
    return F.format_number(stable_round(col, 6), digits)


def top_per_borough(latest: DataFrame, boroughs, k: int = 5) -> DataFrame:
    """Top k stations by monthly ridership in each listed borough, in list order."""
    w = Window.partitionBy("borough").orderBy(
        rank_key("monthly_ridership").desc(), F.col("station_complex")
    )
    order = F.array_position(F.array(*[F.lit(b) for b in boroughs]), F.col("borough"))
    return (
        latest.filter(F.col("borough").isin(*boroughs) & _present("monthly_ridership"))
        .withColumn("rank_in_borough", F.row_number().over(w))
        .filter(F.col("rank_in_borough") <= k)
        .select(
            order.cast("int").alias("borough_order"),
            "rank_in_borough",
            "station_complex",
            "borough",
            "monthly_ridership",
            "csi",
            "apt_minutes",
            "csi_pctl",
            "apt_minutes_pctl",
            _fmt("monthly_ridership", 0).alias("monthly_ridership_fmt"),
            _fmt("csi", 3).alias("csi_fmt"),
            _fmt("apt_minutes", 1).alias("apt_minutes_fmt"),
            _fmt("csi_pctl", 2).alias("csi_pctl_fmt"),
            _fmt("apt_minutes_pctl", 2).alias("apt_minutes_pctl_fmt"),
        )
        .orderBy("borough_order", "rank_in_borough")
    )


# -- C16 ---------------------------------------------------------------------
def flagged_latest_top(latest: DataFrame, k: int = 10) -> DataFrame:
    """Top k flagged stations of the latest month by monthly ridership."""
    return (
        latest.filter((F.col("danger_zone") == 1) & _present("monthly_ridership"))
        .orderBy(rank_key("monthly_ridership").desc(), "station_complex")
        .limit(k)
        .select(
            "station_complex", "borough", "year", "month", "monthly_ridership",
            "csi", "apt_minutes", "csi_pctl", "apt_minutes_pctl",
        )
    )


# -- C17 ---------------------------------------------------------------------
def scatter_points(latest: DataFrame) -> DataFrame:
    """Latest-month points with APT: axes, size, colour and a flag label."""
    return latest.filter(_present("apt_minutes")).select(
        "station_complex",
        "borough",
        "volume_component",
        "hhi_monthly_concentration",
        "peak_hr_ridership",
        "csi",
        "apt_minutes",
        "csi_pctl",
        "apt_minutes_pctl",
        "danger_zone",
        F.col("danger_zone").cast("string").alias("danger_zone_str"),
    )


# -- C18-C20 -----------------------------------------------------------------
def high_rolling_stations(
    csi: DataFrame, year: int, from_month: int, k: int = 5, flagged_only: bool = True
) -> DataFrame:
    """Top k stations by their best rolling CSI from ``from_month`` of ``year``."""
    cond = (F.col("year") == year) & (F.col("month") >= from_month)
    if flagged_only:
        cond = cond & (F.col("danger_zone") == 1)
    best = best_row_per_station(csi.filter(cond), "csi_6mo_rolling", ["year", "month", "csi_6mo_rolling"])
    return best.orderBy(rank_key("csi_6mo_rolling").desc(), "station_complex").limit(k)


def trend_rows(csi: DataFrame, stations: DataFrame, start: _dt.date) -> DataFrame:
    """CSI rows of the listed stations from ``start`` on, in month order.

    ``date`` is the first of the month as a zone-less timestamp (a plotting
    axis value, like a parsed date-time)."""
    names = stations.select("station_complex").distinct()
    return (
        csi.join(names, "station_complex", "left_semi")
        .withColumn("date", first_of_month("year", "month").cast("timestamp_ntz"))
        .filter(F.col("date") >= F.lit(start).cast("timestamp_ntz"))
        .orderBy("year", "month", "station_complex")
    )


def trend_long(trend: DataFrame) -> DataFrame:
    """Wide -> long: one (metric, value) row per plotted series point."""
    return trend.unpivot(
        ["station_complex", "station_complex_id", "year", "month", "date"],
        TREND_METRICS,
        "metric",
        "value",
    ).orderBy("year", "month", "station_complex", "metric")


def trend_series(
    csi: DataFrame,
    latest_top: DataFrame | None,
    year: int | None,
    from_month: int,
    start: _dt.date,
    k: int = 5,
) -> DataFrame:
    """Trend points for flagged latest-month stations and/or high rolling-CSI stations."""
    parts = []
    if year is not None:
        parts.append(high_rolling_stations(csi, year, from_month, k).select("station_complex"))
    if latest_top is not None:
        parts.append(latest_top.select("station_complex"))
    stations = parts[0]
    for p in parts[1:]:
        stations = stations.union(p)
    return trend_long(trend_rows(csi, stations.distinct(), start))


def trend_high_unflagged(
    csi: DataFrame, year: int, from_month: int, start: _dt.date, k: int = 5
) -> DataFrame:
    """Rolling-CSI series of the historically high stations, flag ignored."""
    stations = high_rolling_stations(csi, year, from_month, k, flagged_only=False)
    return trend_rows(csi, stations, start).select(
        "station_complex", "station_complex_id", "year", "month", "date", "csi_6mo_rolling"
    )


# -- L8 ------------------------------------------------------------------------
def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First n rows in a stated order (the head of a table)."""
    return df.orderBy(*order).limit(n)
