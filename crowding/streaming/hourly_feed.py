"""Hourly feed: station-hours aggregated as their rows arrive.

An event-time aggregation with a watermark: an hour stays open until rows
``delay`` later than it have been seen; then it is written once, complete with
all rows that came in time, late ones among them. Rows that come later still are
not in what was written; the hours they belong to are found by comparing with a
batch aggregation of the landed files, which also has the hours still open.

Hours are not held in memory between batches. A batch adds its rows to the hours
that the batch before has left open, and writes those that its watermark closes
to one table and those still open to another. What it stores counts once its
mark, the watermark it has reached, is stored too; a batch that was cut off is
done again from the same open hours. Open hours are bounded by the delay,
whatever the history.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.features import HOUR_KEYS, keep_mode, mode_rows
from ..sources import lake

DELAY = "2 days"
HOUR_US = 3_600_000_000


@dataclass(frozen=True)
class _Paths:
    """Tables of one feed, a folder a batch, and its checkpoint."""

    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def closed(self) -> str:
        return self._p("closed_hours")

    @property
    def open(self) -> str:
        return self._p("open_hours")

    @property
    def marks(self) -> str:
        return self._p("marks")

    @property
    def checkpoint(self) -> str:
        return self._p("_hours_checkpoint")


def _of_batch(table: str, batch_id: int) -> str:
    return f"{table}/batch={batch_id}"


def _last_mark(spark: SparkSession, paths: _Paths) -> tuple[int, int]:
    """The last complete batch and the watermark it has reached, in microseconds; at first -1 and 0."""
    if not lake.exists(spark, paths.marks):
        return -1, 0
    rows = lake.read_table(spark, paths.marks, schemas.MARKS).collect()
    return max(((r["batch"], r["mark"]) for r in rows), default=(-1, 0))


def _event_us() -> Column:
    # A watermark needs a time with a zone; the session's is UTC, so nothing shifts.
    return F.unix_micros(F.col("transit_timestamp").cast("timestamp"))


def _close_hours(batch: DataFrame, batch_id: int, paths: _Paths, delay_us: int) -> None:
    """Add a batch's rows to the open hours, write those that it closes and those still open."""
    spark = batch.sparkSession
    last, before = _last_mark(spark, paths)
    if batch_id <= last:  # complete, though the feed was stopped before it knew
        return
    # Spark's watermarks are in milliseconds and don't go back.
    seen = batch.agg(F.max(_event_us())).first()[0]
    mark = before if seen is None else max(before, seen // 1000 * 1000 - delay_us)
    end = _event_us() - F.pmod(_event_us(), F.lit(HOUR_US)) + HOUR_US
    rows = batch.where(end > before)
    if last >= 0:
        rows = rows.unionByName(lake.read_table(spark, _of_batch(paths.open, last), schemas.HOUR_FACT))
    hours = rows.groupBy(*HOUR_KEYS).agg(F.sum("ridership").alias("ridership"))
    lake.write_table(hours.where(end <= mark), _of_batch(paths.closed, batch_id))
    lake.write_table(hours.where(end > mark), _of_batch(paths.open, batch_id))
    lake.write_table(spark.range(0, 1, 1, 1).select(F.lit(mark).cast("long").alias("mark")), _of_batch(paths.marks, batch_id))
    # A reader may be at the last but one.
    for table in (paths.open, paths.marks):
        lake.drop_folder(spark, _of_batch(table, last - 1))


def start_hourly_feed(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    delay: str = DELAY,
    mode: str = "subway",
    available_now: bool = True,
) -> StreamingQuery:
    """Start the feed on the files landed in ``landing_dir``'s folders.

    The checkpoint lies in ``root``: a feed that stopped goes on with the hours
    it had open, and each finished batch's hours count once. With
    ``available_now`` it takes what is landed, closes what can be closed and
    stops. Rows without a time belong to no hour here and are left to the batch.
    """
    paths = _Paths(root)
    rows = keep_mode(spark.readStream.schema(schemas.RIDERSHIP).parquet(f"{landing_dir.rstrip('/')}/*"), mode)
    timed = rows.where(F.col("transit_timestamp").isNotNull()).select(*HOUR_KEYS, "ridership")
    delay_us = spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL '{delay}')").first()[0]
    if delay_us < 0:
        raise ValueError(f"the delay must not be negative: {delay}")
    writer = (
        timed.writeStream.foreachBatch(lambda batch, batch_id: _close_hours(batch, batch_id, paths, delay_us))
        .option("checkpointLocation", paths.checkpoint)
        .queryName(f"hourly_feed_{hashlib.sha1(root.encode()).hexdigest()[:8]}")
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 minutes")).start()


def streamed_hours(spark: SparkSession, root: str) -> DataFrame:
    """The hours that the feed has written."""
    paths = _Paths(root)
    last, _ = _last_mark(spark, paths)
    if last < 0 and lake.exists(spark, paths.checkpoint):
        return spark.createDataFrame([], schemas.HOUR_FACT)
    closed = lake.read_table(spark, paths.closed, schemas.CLOSED_HOURS)
    return closed.where(F.col("batch") <= last).select(*HOUR_KEYS, "ridership")


def settled_hours(spark: SparkSession, landing_dir: str, root: str, mode: str = "subway") -> DataFrame:
    """Every hour of the landed rows with its total and its ``state``.

    ``streamed``: as the feed has written it; ``corrected``: written without
    rows that came too late, or only such rows came; ``open``: not written yet.
    Totals compare to six decimals. Landed rows and written hours go through
    one aggregate, so they are shuffled once and not sorted for a join.
    """
    landed = mode_rows(spark.read.schema(schemas.RIDERSHIP).parquet(f"{landing_dir.rstrip('/')}/*"), mode)
    written = streamed_hours(spark, root)
    latest = written.agg(F.max("transit_timestamp").alias("t"))
    total, null = F.col("ridership"), F.lit(None).cast("double")
    both = landed.select(*HOUR_KEYS, total, null.alias("streamed"), F.lit(False).alias("is_written")).unionAll(
        written.select(*HOUR_KEYS, null, total, F.lit(True))
    )
    hours = both.groupBy(*HOUR_KEYS).agg(
        F.sum("ridership").alias("ridership"),
        F.max("streamed").alias("streamed"),
        F.max("is_written").alias("is_written"),
        F.min("is_written").alias("only_written"),
    )
    near = F.round("streamed", 6).eqNullSafe(F.round("ridership", 6))
    # Hours close in the order of time: one after the last written is open.
    is_open = ~F.col("is_written") & F.coalesce(F.col("transit_timestamp") > latest.scalar(), F.lit(True))
    state = F.when(is_open, "open").when(F.col("is_written") & near, "streamed").otherwise("corrected")
    return hours.where(~F.col("only_written")).select(*HOUR_KEYS, "ridership", state.alias("state"))
