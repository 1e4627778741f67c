"""Monthly feed: landed raw month files drive the incremental run.

A Structured Streaming file source watches the landing folder; each
micro-batch names the months it brought and those months are recomputed from
*all* landed files of the same months (so a month split across batches, or a
re-landed month, still ends up whole), then written with partition overwrite.
The stream checkpoint records which files were processed. A month of a batch is
a run under the stream's id, the batch's number and the month, so a batch that
is restarted or retried finishes what it had begun, and adds nothing twice.

A month that lands late also refreshes the rolling means of the months stored
after it.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import quality
from ..plans.runs import run_landed_month
from ..sources.lake import LakePaths
from ..sources.slices import time_range


def _months(batch: DataFrame) -> list[_dt.date]:
    """First days of the months in the batch, in order."""
    month = F.trunc(F.to_date("transit_timestamp"), "MM").alias("m")
    return sorted(r["m"] for r in batch.select(month).distinct().collect() if r["m"] is not None)


def start_monthly_feed(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    checkpoint: str | None = None,
    baseline_year: int | None = None,
    available_now: bool = True,
    gates: tuple[quality.GateSpec, quality.GateSpec] = (quality.RIDERSHIP_GATE, quality.APT_GATE),
    apt_dir: str | None = None,
    run_time: str | None = None,
) -> StreamingQuery:
    """Start the feed; with ``available_now`` it processes what is landed and stops.

    Every month of a batch goes through ``run_landed_month``: gates, APT load
    (from the files landed in ``apt_dir``, where given), transform and audit. A
    failing gate is audited and stops the feed. The checkpoint lies in the
    lake's root, so a restarted feed goes on where it stopped.
    """
    source = f"{landing_dir.rstrip('/')}/*"
    stream = spark.readStream.schema(schemas.RIDERSHIP).parquet(source)

    checkpoint = checkpoint or LakePaths(root).feed_checkpoint

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # The stream's own id: a new checkpoint numbers its batches anew.
        stream_id = json.loads(session.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        for start in _months(batch):
            end = (start.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
            landed = session.read.schema(schemas.RIDERSHIP).parquet(source)
            apt = None
            if apt_dir:
                apt = session.read.schema(schemas.APT).parquet(f"{apt_dir.rstrip('/')}/*")
                apt = time_range(apt, "month", start, end)
            run_landed_month(
                session, time_range(landed, "transit_timestamp", start, end), apt, root, start,
                f"ridership_{start:%Y_%m}", gates, baseline_year, run_time,
                f"{stream_id}-{batch_id}-{start:%Y_%m}",
            )

    name = hashlib.sha1(root.encode()).hexdigest()[:8]
    writer = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .queryName(f"monthly_feed_{name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
