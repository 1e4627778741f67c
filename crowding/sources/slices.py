"""Time slices and numeric coercion of landed records."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_label, previous_month_bounds


def _bound(df: DataFrame, col: str, value) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    return v.cast(dict(df.dtypes)[col])


def time_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Half-open range [start, end) on a time column.

    Bounds are literals or constant expressions, folded at planning time and
    pushed into the Parquet scan (and used for partition pruning).
    """
    c = F.col(col)
    return df.filter((c >= _bound(df, col, start)) & (c < _bound(df, col, end)))


def year_slice(df: DataFrame, year: int, col: str = "transit_timestamp", ordered: bool = True) -> DataFrame:
    """One calendar year, ordered by time like the paged extract."""
    out = time_range(df, col, _dt.datetime(year, 1, 1), _dt.datetime(year + 1, 1, 1))
    # The station id splits an hour with very many rows over range partitions.
    return out.orderBy(col, "station_complex_id") if ordered else out


def previous_month_slice(df: DataFrame, as_of, col: str = "transit_timestamp") -> DataFrame:
    """Rows of the calendar month before ``as_of`` (January -> previous December)."""
    start, end = previous_month_bounds(as_of)
    return time_range(df, col, start, end)


def previous_month(as_of: _dt.date) -> tuple[_dt.date, _dt.date]:
    """Driver-side twin of the bounds, for naming files and folders."""
    first_this = as_of.replace(day=1)
    last_prev = first_this - _dt.timedelta(days=1)
    return last_prev.replace(day=1), first_this


def landing_label(dataset: str, as_of) -> Column:
    """'<dataset>_yyyy_MM' of the month before ``as_of``."""
    start, _ = previous_month_bounds(as_of)
    return F.concat(F.lit(f"{dataset}_"), month_label(start))


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Cast the listed columns to double where present; bad values become null."""
    present = set(df.columns)
    return df.select(
        *[F.col(c).try_cast("double").alias(c) if c in cols and c in present else F.col(c) for c in df.columns]
    )
