"""Lazily built inputs and intermediate tables for one dataset directory.

Every property is a lazy DataFrame over the driver's tables, except
``csi_stored``, which writes the station-month table once to the shared
folder (as the lake holds it for reports). Registered queries pick the stage
they need, so a query pays only for its own part of the plan.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import delay, features, risk, stress
from ..session import scratch_path
from ..sources import fixtures, lake
from ..sources.slices import time_range


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, baseline_year: int = fixtures.BASELINE_YEAR):
        self.spark = spark
        self.sf_dir = sf_dir
        self.baseline_year = baseline_year

    # -- domain inputs -------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.ridership(self.spark, self.sf_dir)

    @cached_property
    def apt(self) -> DataFrame:
        return fixtures.apt(self.spark, self.sf_dir)

    @cached_property
    def stations(self) -> DataFrame:
        return fixtures.stations(self.spark, self.sf_dir)

    # -- hourly facts ----------------------------------------------------------
    @cached_property
    def hour_features(self) -> DataFrame:
        """Hour rows with calendar features, without month totals."""
        return features.time_features(features.hourly_fact(self.raw))

    @cached_property
    def hours(self) -> DataFrame:
        """The full hourly table (features + month total + rank)."""
        return features.ridership_transformed(self.raw)

    # -- station-month tables ---------------------------------------------------
    @cached_property
    def baseline(self) -> DataFrame:
        """From the baseline year's rows alone: the range reaches the scan."""
        year = self.baseline_year
        raw = time_range(self.raw, "transit_timestamp", _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1))
        hours = features.time_features(features.hourly_fact(raw))
        return stress.baseline_p90(stress.peak_volume(hours), year)

    @cached_property
    def moments_stored(self) -> DataFrame:
        """Station-month moments, written once to the shared folder and read back.

        The one pass over the raw rows; the baseline (a scalar subquery) and
        the CSI then both read this small table instead of each re-scanning
        the raw extract.
        """
        path = scratch_path(self.spark, "station-month-moments")
        lake.write_table(stress.station_month_moments(self.hour_features), path)
        return lake.read_table(self.spark, path, schemas.MOMENTS)

    @cached_property
    def stress(self) -> DataFrame:
        moments = self.moments_stored
        baseline = stress.baseline_p90(stress.peak_from_moments(moments), self.baseline_year)
        return stress.stress_from_moments(moments, baseline)

    @cached_property
    def bridge(self) -> DataFrame:
        return delay.route_bridge(self.stations)

    @cached_property
    def delay(self) -> DataFrame:
        return delay.station_delay(self.bridge, self.apt)

    @cached_property
    def flagged(self) -> DataFrame:
        return risk.risk_flag(self.stress, self.delay)

    @cached_property
    def csi(self) -> DataFrame:
        """The station-month result table with rolling trends."""
        return risk.rolling_means(self.flagged).select(*risk.CSI_TABLE_COLUMNS)

    # -- stored tables for the report queries ------------------------------
    @cached_property
    def csi_stored(self) -> DataFrame:
        """The station-month table, written by (year, month) and read back.

        Computed once per query from the stored moments instead of once per
        reference in a report's plan; a report of one month reads one folder.
        """
        path = scratch_path(self.spark, "csi-table")
        lake.write_partitioned(lake.conform(self.csi, schemas.CSI), path)
        return lake.read_table(self.spark, path, schemas.CSI)

    @cached_property
    def month_totals(self) -> DataFrame:
        """Monthly ridership per station name, from the stored moments."""
        return stress.month_totals(self.moments_stored)
