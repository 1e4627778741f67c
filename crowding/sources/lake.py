"""Typed readers and writers of the partitioned result lake.

Every write is an overwrite of whole partitions ("dynamic" mode), so a
re-run or a retried task replaces its months instead of appending twice. The
audit log has one folder per run, replaced likewise. Reads pass an explicit
schema.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


@dataclass(frozen=True)
class LakePaths:
    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def ridership(self) -> str:
        return self._p("ridership")

    @property
    def landing(self) -> str:
        return self._p("landing")

    @property
    def feed_checkpoint(self) -> str:
        return self._p("_feed_checkpoint")

    @property
    def hours(self) -> str:
        return self._p("ridership_transformed")

    @property
    def csi(self) -> str:
        return self._p("csi")

    @property
    def baseline(self) -> str:
        return self._p("csi_baseline")

    @property
    def sketches(self) -> str:
        return self._p("peak_sketches")

    @property
    def apt(self) -> str:
        return self._p("apt")

    @property
    def route_lookup(self) -> str:
        return self._p("station_route_lookup")

    @property
    def station_names(self) -> str:
        return self._p("station_name_check")

    @property
    def audit(self) -> str:
        return self._p("audit_log")

    @property
    def ledger(self) -> str:
        return self._p("run_ledger")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast; absent columns become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_partitioned(df: DataFrame, path: str, cols=("year", "month")) -> None:
    """Overwrite only the partitions present in ``df`` (idempotent re-runs).

    The rebalance hint lets AQE size the write tasks per partition value:
    small months are packed together, a large month is split across tasks,
    so each (year, month) folder gets a few files of the advisory size rather
    than one small file from every upstream task.
    """
    (
        df.hint("rebalance", *cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )


def exists(spark: SparkSession, path: str) -> bool:
    """If the file or folder is there, in whatever store the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def upsert_apt_month(apt_month: DataFrame, path: str) -> None:
    """Replace the APT months present in ``apt_month`` in the APT lake."""
    write_partitioned(conform(apt_month, schemas.APT), path, ("year", "month_num"))


def write_baseline(baseline: DataFrame, path: str) -> None:
    """Persist the one-row baseline (one small file)."""
    write_table(conform(baseline, schemas.BASELINE).coalesce(1), path)


def read_baseline(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    b = read_table(spark, path, schemas.BASELINE)
    return b.filter(F.col("baseline_year") == year) if year is not None else b


def require_baseline(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """The stored baseline, checked to be one row with a positive p90; raises otherwise.

    A missing baseline would otherwise surface as a silently null CSI: a year
    without data leaves a null p90, a year of zeros a zero one.
    """
    b = read_baseline(spark, path, year)
    rows = [r["p90_peak_hr_ridership"] for r in b.limit(2).collect()]
    if len(rows) != 1 or rows[0] is None or not rows[0] > 0:
        which = f"year {year}" if year is not None else "any year"
        raise ValueError(f"expected one positive baseline for {which} at {path}, found {rows}")
    return b


def drop_months(spark: SparkSession, path: str, months, cols=("year", "month")) -> None:
    """Remove the folders of (year, month) partitions, as a re-run without rows needs.

    Dynamic overwrite only touches partitions that the new rows have.
    """
    jvm = spark._jvm
    for year, month in months:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{cols[0]}={year}/{cols[1]}={month}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that isn't there is fine."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def append_audit(records: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add a run's audit rows to the log; rows of the same ``run_id`` are replaced.

    Without an id the rows are those of a run of their own.
    """
    rows = conform(records, schemas.AUDIT).withColumn("run_id", F.lit(run_id or uuid.uuid4().hex))
    write_partitioned(rows.coalesce(1), path, ("run_id",))
