"""A run ledger: monthly runs that take effect once, as a whole.

A run writes all its tables to a folder of its own first. When the last is
complete, one ledger row marks the run ``committed``; only then are the staged
months copied over those of the lake, and a second row marks it ``published``.
Before the first mark nothing of a run can be seen; after it the run is carried
to its end, by itself or by the next run to start, as the copying can be done
again from the same staged tables. The audit rows are staged like the rest, so
they appear once with their run.

A run is known by its id. A run that starts again under the id of a published
one has nothing left to do.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources import lake

COMMITTED, PUBLISHED = "committed", "published"


@dataclass(frozen=True)
class Stage:
    """Folders of one attempt of a run; names as in the lake."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def _tables(paths: lake.LakePaths) -> list[tuple]:
    """(staged name, path in the lake, schema, partition columns), in order of publishing."""
    months = ("year", "month")
    return [
        ("apt", paths.apt, schemas.APT, ("year", "month_num")),
        ("ridership", paths.ridership, schemas.RIDERSHIP_MONTHS, months),
        ("hours", paths.hours, schemas.HOURS, months),
        ("sketches", paths.sketches, schemas.PEAK_SKETCHES, months),
        ("csi", paths.csi, schemas.CSI, months),
        ("csi_following", paths.csi, schemas.CSI, months),
        ("audit", paths.audit, schemas.AUDIT, ("run_id",)),
    ]


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.paths = spark, lake.LakePaths(root)

    def rows(self) -> DataFrame:
        if not lake.exists(self.spark, self.paths.ledger):
            return self.spark.createDataFrame([], schemas.LEDGER)
        return lake.read_table(self.spark, self.paths.ledger, schemas.LEDGER)

    def state(self, run_id: str) -> str | None:
        states = {r["state"] for r in self.rows().where(F.col("run_id") == run_id).select("state").collect()}
        return PUBLISHED if PUBLISHED in states else COMMITTED if COMMITTED in states else None

    def new_stage(self) -> Stage:
        """A fresh folder in the lake's root: what an attempt that failed left is never read."""
        return Stage(f"{self.paths.root.rstrip('/')}/_runs/{uuid.uuid4().hex}")

    def _mark(self, run_id: str, state: str, stage: Stage) -> None:
        row = self.spark.range(1).select(
            F.lit(stage.root).alias("stage"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("marked_at"),
            F.lit(run_id).alias("run_id"), F.lit(state).alias("state"),
        )
        lake.write_partitioned(lake.conform(row, schemas.LEDGER), self.paths.ledger, ("run_id", "state"))

    def commit(self, run_id: str, stage: Stage) -> None:
        """From here on the staged tables are the run's result; they are published."""
        self._mark(run_id, COMMITTED, stage)
        self._publish(run_id, stage)

    def _publish(self, run_id: str, stage: Stage) -> None:
        publish(self.spark, stage, self.paths)
        self._mark(run_id, PUBLISHED, stage)
        lake.drop_folder(self.spark, stage.root)

    def recover(self) -> list[str]:
        """Publish what was committed and not published, in order; returns the runs' ids."""
        rows = self.rows()
        done = rows.where(F.col("state") == PUBLISHED).select("run_id")
        open_ = rows.where(F.col("state") == COMMITTED).join(done, "run_id", "left_anti").orderBy("marked_at").collect()
        for r in open_:
            self._publish(r["run_id"], Stage(r["stage"]))
        return [r["run_id"] for r in open_]


def publish(spark: SparkSession, stage: Stage, paths: lake.LakePaths) -> None:
    """Replace the lake's months by the staged ones; can be repeated.

    The stage is complete: each of its folders that is there was written to its
    end. Stored months that the run's range covers and its rows don't have go.
    """
    for name, path, schema, cols in _tables(paths):
        if lake.exists(spark, stage.path(name)):
            lake.write_partitioned(lake.read_table(spark, stage.path(name), schema), path, cols)
    if lake.exists(spark, stage.path("gone")):
        gone = [(r["year"], r["month"]) for r in lake.read_table(spark, stage.path("gone"), schemas.MONTHS).collect()]
        for path in (paths.ridership, paths.hours, paths.sketches, paths.csi):
            lake.drop_months(spark, path, gone)
