"""Capacity stress index: peak volume against a baseline, times HHI."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import PEAK_WINDOWS, first_of_month
from ..functions.numeric import hhi_from_moments, safe_div
from .features import NAME_MONTH

STATION_MONTH = ["station_complex", "station_complex_id", "borough", "year", "month"]

# Percentile sketch accuracy: relative rank error 1 / accuracy. The sketch is
# merged partially per task, so its memory is bounded by the accuracy, not by
# the data; station-month counts below ~1e5 per year are answered exactly.
BASELINE_ACCURACY = 100_000
BASELINE_QUANTILE = 0.9


def _is_peak_row() -> F.Column:
    return F.col("time_window").isin(*PEAK_WINDOWS)


def peak_volume(hours: DataFrame) -> DataFrame:
    """Ridership summed over peak-window hours per station-month."""
    return (
        hours.filter(_is_peak_row())
        .groupBy(*STATION_MONTH)
        .agg(F.sum("ridership").alias("peak_hr_ridership"))
    )


def baseline_p90(
    peak: DataFrame,
    year: int,
    quantile: float = BASELINE_QUANTILE,
    accuracy: int = BASELINE_ACCURACY,
) -> DataFrame:
    """One-row table: the 90th percentile of station-month peak volume in ``year``.

    Stays in the plan (no driver round trip); a global aggregate always yields
    exactly one row, null when the year has no data.
    """
    return (
        peak.filter(F.col("year") == F.lit(year))
        .agg(F.percentile_approx("peak_hr_ridership", quantile, accuracy).alias("p"))
        .select(
            F.lit(year).cast("int").alias("baseline_year"),
            F.col("p").cast("double").alias("p90_peak_hr_ridership"),
        )
    )


# Items that a peak-volume sketch keeps at its top level. A sketch of fewer
# values is exact; beyond, a rank is off by at most ``sketch_rank_error``.
SKETCH_K = 4096


def sketch_rank_error(k: int = SKETCH_K) -> float:
    """Rank error, as a share of all values, that a KLL sketch keeps with 99 % confidence."""
    return 2.296 / k**0.9021


def peak_sketches(peak: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One quantile sketch of the station peak volumes of each month: (year, month, n, sketch).

    A sketch has a few times ``k`` numbers whatever the number of stations, and
    sketches of any months can be merged, so a baseline of another period needs
    neither the raw rows nor the station-months again.
    """
    return peak.where(F.col("peak_hr_ridership").isNotNull()).groupBy("year", "month").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("peak_hr_ridership", k).alias("sketch")
    )


def baseline_from_sketches(
    sketches: DataFrame, start, end, quantile: float = BASELINE_QUANTILE, k: int = SKETCH_K
) -> DataFrame:
    """One-row baseline of the months in [start, end) from their sketches.

    ``baseline_year`` is the period's first year; ``n`` its station-months. As
    ``baseline_p90``, null without any. Exact up to ``k`` station-months, then
    within ``sketch_rank_error(k)`` of the quantile's rank.
    """
    day = first_of_month("year", "month")
    inside = sketches.where((day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date")))
    merged = inside.agg(F.kll_merge_agg_double("sketch", k).alias("s"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return merged.select(
        F.lit(start.year).cast("int").alias("baseline_year"),
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(quantile))).alias("p90_peak_hr_ridership"),
        F.col("n"),
    )


def concentration(hours: DataFrame) -> DataFrame:
    """HHI of hourly shares per station-name month: sum r^2 / (sum r)^2."""
    r = F.col("ridership")
    return hours.groupBy(*NAME_MONTH).agg(
        hhi_from_moments(F.sum(r * r), F.sum(r)).alias("hhi_monthly_concentration")
    )


def station_month_moments(hours: DataFrame) -> DataFrame:
    """Peak volume, peak-row count and the two HHI moments in one aggregate.

    Peak volume (station id grain) and HHI (station name grain) both reduce
    hour rows to station-months; computing them together costs one exchange
    of partial aggregates instead of two aggregates and a join.
    """
    r = F.col("ridership")
    peak = _is_peak_row()
    return hours.groupBy(*STATION_MONTH).agg(
        F.sum(F.when(peak, r)).alias("peak_hr_ridership"),
        F.count(F.when(peak, F.lit(1))).alias("peak_rows"),
        F.sum(r).alias("ridership_sum"),
        F.sum(r * r).alias("ridership_sq_sum"),
    )


def _baseline_value(baseline) -> F.Column:
    """The p90 as a scalar column: a literal, or a one-row scalar subquery.

    A scalar subquery runs once and enters the plan as a value, so the
    station-month rows are neither joined nor shuffled against it; Spark
    raises if the baseline table does not hold exactly one row.
    """
    if isinstance(baseline, (int, float)):
        return F.lit(float(baseline))
    return baseline.select(F.col("p90_peak_hr_ridership").cast("double")).scalar()


def stress_from_moments(moments: DataFrame, baseline) -> DataFrame:
    """CSI rows from a station-month moments table (see ``station_month_moments``).

    Lets a run aggregate the hour rows once, store the small moments table and
    derive both the baseline and the CSI from it.
    """
    name_month = Window.partitionBy(*NAME_MONTH)
    with_hhi = moments.withColumn(
        "hhi_monthly_concentration",
        hhi_from_moments(
            F.sum("ridership_sq_sum").over(name_month), F.sum("ridership_sum").over(name_month)
        ),
    ).filter((F.col("peak_rows") > 0) & F.col("station_complex").isNotNull())
    volume = safe_div(F.col("peak_hr_ridership"), _baseline_value(baseline))
    return with_hhi.select(
        "station_complex",
        "year",
        "month",
        "station_complex_id",
        "borough",
        "peak_hr_ridership",
        volume.alias("volume_component"),
        "hhi_monthly_concentration",
        (volume * F.col("hhi_monthly_concentration")).alias("csi"),
    )


def stress_index(hours: DataFrame, baseline) -> DataFrame:
    """CSI per station-month: (peak volume / baseline p90) x HHI.

    ``baseline`` is a one-row DataFrame from ``baseline_p90``/``read_baseline``
    or a number. A station-month without any peak-window hour has no row (the
    inner-join semantics of peak volume with HHI); a zero month gives null HHI.
    """
    return stress_from_moments(station_month_moments(hours), baseline)


def peak_from_moments(moments: DataFrame) -> DataFrame:
    """The peak-volume table (station-months with a peak hour) from moments."""
    return moments.filter(F.col("peak_rows") > 0).select(*STATION_MONTH, "peak_hr_ridership")


def month_totals(moments: DataFrame) -> DataFrame:
    """Monthly ridership per station name from station-month moments."""
    return moments.groupBy(*NAME_MONTH).agg(F.sum("ridership_sum").alias("monthly_ridership"))


def variation_cv(hours: DataFrame) -> DataFrame:
    """Coefficient of variation of hourly ridership per station-name month.

    The documented alternative to HHI: sample stddev / mean.
    """
    r = F.col("ridership")
    return hours.groupBy(*NAME_MONTH).agg(
        safe_div(F.stddev_samp(r), F.avg(r)).alias("ridership_cv")
    )
