"""Station delay merge, monthly percentiles, risk flags and rolling trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import rank_key
from ._joins import join_on_keys

PERCENTILE_CUT = 0.9
# The documented absolute thresholds of the alternative rule.
CSI_THRESHOLD = 0.65
APT_THRESHOLD = 3.0
ROLLING_ROWS = 6


def attach_delay(csi: DataFrame, delay: DataFrame) -> DataFrame:
    """Left join of station delay onto CSI rows by (id, year, month).

    A station whose routes match no APT line keeps its CSI row with nulls.
    """
    keyed = delay.withColumnRenamed("complex_id", "station_complex_id")
    return join_on_keys(csi, keyed, ["station_complex_id", "year", "month"], how="left")


def month_percentiles(df: DataFrame) -> DataFrame:
    """percent_rank of CSI and of APT within each (year, month).

    Nulls sort first and still count in n: a station without APT gets
    percentile 0 and lifts the others' percentiles. Both windows share one
    partitioning, so Spark sorts twice but shuffles once.
    """
    w = Window.partitionBy("year", "month")
    return df.withColumns({
        "csi_pctl": F.percent_rank().over(w.orderBy(rank_key("csi").asc_nulls_first())),
        "apt_minutes_pctl": F.percent_rank().over(
            w.orderBy(rank_key("apt_minutes").asc_nulls_first())
        ),
    })


def percentile_flag(df: DataFrame, cut: float = PERCENTILE_CUT) -> DataFrame:
    """danger_zone = 1 when both percentiles reach ``cut`` (>=), else 0."""
    return df.withColumn(
        "danger_zone",
        ((F.col("csi_pctl") >= cut) & (F.col("apt_minutes_pctl") >= cut)).cast("int"),
    )


def threshold_flag(
    df: DataFrame, csi_min: float = CSI_THRESHOLD, apt_min: float = APT_THRESHOLD
) -> DataFrame:
    """Alternative rule: danger_zone = csi > csi_min and apt > apt_min (null if unknown)."""
    return df.withColumn(
        "danger_zone",
        ((F.col("csi") > csi_min) & (F.col("apt_minutes") > apt_min)).cast("int"),
    )


def risk_flag(csi: DataFrame, delay: DataFrame, cut: float = PERCENTILE_CUT) -> DataFrame:
    """CSI rows with station delay, both monthly percentiles and the flag."""
    return percentile_flag(month_percentiles(attach_delay(csi, delay)), cut)


def rolling_window(rows: int = ROLLING_ROWS):
    """Last ``rows`` rows of a station ordered by month (rows, not months)."""
    return (
        Window.partitionBy("station_complex_id")
        .orderBy("year", "month", "station_complex", "borough")
        .rowsBetween(-(rows - 1), Window.currentRow)
    )


def rolling_means(df: DataFrame, rows: int = ROLLING_ROWS) -> DataFrame:
    """6-row rolling means of CSI and APT per station id (nulls ignored)."""
    w = rolling_window(rows)
    return df.withColumns({
        "csi_6mo_rolling": F.avg("csi").over(w),
        "apt_6mo_rolling": F.avg("apt_minutes").over(w),
    })


def calendar_rolling_means(df: DataFrame, months: int = ROLLING_ROWS) -> DataFrame:
    """Variant framed by calendar months: a gap does not stretch the frame."""
    idx = F.col("year") * 12 + F.col("month")
    w = (
        Window.partitionBy("station_complex_id")
        .orderBy(idx)
        .rangeBetween(-(months - 1), Window.currentRow)
    )
    return df.withColumns({
        "csi_6mo_rolling": F.avg("csi").over(w),
        "apt_6mo_rolling": F.avg("apt_minutes").over(w),
    })


CSI_TABLE_COLUMNS = [
    "station_complex",
    "year",
    "month",
    "station_complex_id",
    "borough",
    "peak_hr_ridership",
    "volume_component",
    "hhi_monthly_concentration",
    "csi",
    "apt_minutes",
    "cjtp",
    "total_line_passengers",
    "num_lines_serving",
    "csi_pctl",
    "apt_minutes_pctl",
    "danger_zone",
    "csi_6mo_rolling",
    "apt_6mo_rolling",
]
