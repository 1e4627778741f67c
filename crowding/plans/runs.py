"""Full-history build and the incremental monthly run.

Both are sequences of Spark jobs that meet at written tables: each stage writes
one and the next reads it back, which cuts the lineage (a lost executor
never forces recomputation from the raw extract) and lets later scans prune
(year, month) partitions. A monthly run stages all its tables and replaces
whole partitions of the lake at its end, so a re-run or retry of a month
replaces it, and a run that is cut off leaves no half.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.calendar import as_timestamp, first_of_month
from ..operators import delay, features, quality, risk, stress
from ..session import scratch_path
from ..sources import lake, landing, records
from ..sources.slices import previous_month, time_range
from .ledger import Ledger, Stage, publish

ROLLING_HISTORY = risk.ROLLING_ROWS - 1
CSI_BASE_COLUMNS = [c for c in risk.CSI_TABLE_COLUMNS if c not in ("csi_6mo_rolling", "apt_6mo_rolling")]


def _with_month(raw: DataFrame) -> DataFrame:
    """Raw rows with the year and month of their time, as the raw table has them."""
    ts = as_timestamp(raw, "transit_timestamp")
    return lake.conform(
        raw.withColumns({"transit_timestamp": ts, "year": F.year(ts), "month": F.month(ts)}),
        schemas.RIDERSHIP_MONTHS,
    )


def _months_between(df: DataFrame, start, end) -> DataFrame:
    """Rows whose (year, month) lies in [start, end); a partition-column filter."""
    d = first_of_month("year", "month")
    return df.filter((d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date")))


def _apt_months_between(df: DataFrame, start, end) -> DataFrame:
    d = first_of_month("year", "month_num")
    return df.filter((d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date")))


def _moments(spark: SparkSession, hours: DataFrame, path: str) -> DataFrame:
    """Station-month moments, written once: sketches, baseline and CSI read them, not the hours."""
    lake.write_table(lake.conform(stress.station_month_moments(hours), schemas.MOMENTS), path)
    return lake.read_table(spark, path, schemas.MOMENTS)


def station_month_table(moments: DataFrame, baseline, route_lookup: DataFrame, apt: DataFrame) -> DataFrame:
    """CSI rows with delay, percentiles and flag (no rolling columns yet)."""
    csi = stress.stress_from_moments(moments, baseline)
    return risk.risk_flag(csi, delay.station_delay(route_lookup, apt)).select(*CSI_BASE_COLUMNS)


def _write_sketches(moments: DataFrame, path: str) -> None:
    """The months' quantile sketches of peak volume: what a later baseline is made from."""
    sketches = stress.peak_sketches(stress.peak_from_moments(moments))
    lake.write_partitioned(lake.conform(sketches, schemas.PEAK_SKETCHES), path)


def rebase(spark: SparkSession, root: str, start: _dt.date, end: _dt.date) -> DataFrame:
    """Make the months [start, end) the baseline of the runs that follow; returns it.

    Only the months' sketches are read. Months that are stored already keep
    their CSI until they are run again.
    """
    p = lake.LakePaths(root)
    sketches = lake.read_table(spark, p.sketches, schemas.PEAK_SKETCHES)
    lake.write_baseline(stress.baseline_from_sketches(sketches, start, end), p.baseline)
    return lake.require_baseline(spark, p.baseline)


def build_history(
    spark: SparkSession,
    raw: DataFrame,
    apt: DataFrame,
    stations: DataFrame,
    root: str,
    baseline_year: int,
) -> lake.LakePaths:
    """First load of a full history: dimensions, hours, baseline, CSI."""
    p = lake.LakePaths(root)
    lake.upsert_apt_month(apt, p.apt)
    lake.write_table(delay.route_bridge(stations), p.route_lookup)
    lake.write_partitioned(_with_month(raw), p.ridership)
    raw = lake.read_table(spark, p.ridership, schemas.RIDERSHIP_MONTHS)
    # One year's partitions of the raw table.
    first_year = raw.filter(F.col("year") == baseline_year)
    lake.write_table(quality.known_names(first_year), p.station_names)

    lake.write_partitioned(lake.conform(features.ridership_transformed(raw), schemas.HOURS), p.hours)
    hours = lake.read_table(spark, p.hours, schemas.HOURS)

    moments = _moments(spark, hours, scratch_path(spark, "history-moments"))
    lake.write_baseline(stress.baseline_p90(stress.peak_from_moments(moments), baseline_year), p.baseline)
    _write_sketches(moments, p.sketches)
    baseline = lake.require_baseline(spark, p.baseline, baseline_year)

    table = station_month_table(
        moments,
        baseline,
        lake.read_table(spark, p.route_lookup, schemas.ROUTE_LOOKUP),
        lake.read_table(spark, p.apt, schemas.APT),
    )
    lake.write_partitioned(lake.conform(risk.rolling_means(table), schemas.CSI), p.csi)
    return p


def last_rows_per_station(csi: DataFrame, n: int = ROLLING_HISTORY) -> DataFrame:
    """The last ``n`` stored rows of every station id, in rolling-window order.

    ``row_number() <= n`` lets Spark keep only n rows per station inside each
    task before the window's exchange (window group limit).
    """
    w = Window.partitionBy("station_complex_id").orderBy(
        F.col("year").desc(), F.col("month").desc(),
        F.col("station_complex").desc(), F.col("borough").desc(),
    )
    return csi.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def _month_list(df: DataFrame) -> set[tuple[int, int]]:
    """The (year, month) pairs of a few months' rows."""
    return {(r["year"], r["month"]) for r in df.select("year", "month").distinct().collect()}


def _following(before: DataFrame, after: DataFrame, end) -> DataFrame | None:
    """Rows of stored months whose rolling means reach back before ``end``, recomputed.

    ``before`` and ``after`` are the station-month rows before and from ``end``.
    Those concerned are the next five stored rows of each station. The months
    that hold them are recomputed as a whole, from their own rows and the five
    before. None, where there are no such months.
    """
    month = first_of_month("year", "month")
    w = Window.partitionBy("station_complex_id").orderBy("year", "month", "station_complex", "borough")
    numbered = after.withColumn("_rn", F.row_number().over(w))
    last = numbered.filter(F.col("_rn") <= ROLLING_HISTORY).agg(F.max(month).alias("m")).first()["m"]
    if last is None:
        return None
    span = after.filter(month <= F.lit(last)).select(*CSI_BASE_COLUMNS)
    rolled = risk.rolling_means(span.unionByName(last_rows_per_station(before).select(*CSI_BASE_COLUMNS)))
    return rolled.filter(month >= F.lit(end).cast("date"))


def stage_months(spark: SparkSession, raw_new: DataFrame, apt_new: DataFrame | None, paths: lake.LakePaths,
                 stage: Stage, start, end, baseline_year: int | None = None) -> None:
    """Recompute hours and CSI for the months in [start, end) of ``raw_new``, in the stage.

    Nothing in the lake changes. Month totals, ranks and percentiles only need
    the new months; the 6-row rolling means also need each station's last five
    stored rows, which are read from the CSI table and unioned in before the
    window. When later months are stored already, the rolling means that reach
    back into the recomputed ones are staged too. Stored months of the range
    that the new rows don't have are listed as gone. APT months that
    ``apt_new`` has take the place of the stored ones.
    """
    lake.write_partitioned(_with_month(time_range(raw_new, "transit_timestamp", start, end)), stage.path("ridership"))
    raw = lake.read_table(spark, stage.path("ridership"), schemas.RIDERSHIP_MONTHS)
    stored_raw = lake.read_table(spark, paths.ridership, schemas.RIDERSHIP_MONTHS)
    gone = _month_list(_months_between(stored_raw, start, end)) - _month_list(raw)
    if gone:
        lake.write_table(spark.createDataFrame(sorted(gone), schemas.MONTHS), stage.path("gone"))
    lake.write_partitioned(lake.conform(features.ridership_transformed(raw), schemas.HOURS), stage.path("hours"))
    hours = lake.read_table(spark, stage.path("hours"), schemas.HOURS)
    moments = _moments(spark, hours, stage.path("moments"))
    _write_sketches(moments, stage.path("sketches"))

    baseline = lake.require_baseline(spark, paths.baseline, baseline_year)
    apt = _apt_months_between(lake.read_table(spark, paths.apt, schemas.APT), start, end)
    if apt_new is not None:
        lake.write_partitioned(lake.conform(apt_new, schemas.APT), stage.path("apt"), ("year", "month_num"))
        fresh = lake.read_table(spark, stage.path("apt"), schemas.APT)
        replaced = fresh.select("year", "month_num").distinct()
        apt = apt.join(replaced, ["year", "month_num"], "left_anti").unionByName(_apt_months_between(fresh, start, end))
    new_rows = station_month_table(
        moments, baseline, lake.read_table(spark, paths.route_lookup, schemas.ROUTE_LOOKUP), apt
    )

    stored = lake.read_table(spark, paths.csi, schemas.CSI)
    month = first_of_month("year", "month")
    before = stored.filter(month < F.lit(start).cast("date"))
    history = last_rows_per_station(before).select(*CSI_BASE_COLUMNS)
    rolled = risk.rolling_means(new_rows.unionByName(history))
    lake.write_partitioned(lake.conform(_months_between(rolled, start, end), schemas.CSI), stage.path("csi"))
    fresh = lake.read_table(spark, stage.path("csi"), schemas.CSI)
    following = _following(before.unionByName(fresh), stored.filter(month >= F.lit(end).cast("date")), end)
    if following is not None:
        lake.write_partitioned(lake.conform(following, schemas.CSI), stage.path("csi_following"))


def update_months(spark: SparkSession, raw_new: DataFrame, paths: lake.LakePaths, start, end,
                  baseline_year: int | None = None) -> None:
    """Stage and publish the months in [start, end) of ``raw_new``, outside any run."""
    stage = Ledger(spark, paths.root).new_stage()
    stage_months(spark, raw_new, None, paths, stage, start, end, baseline_year)
    publish(spark, stage, paths)
    lake.drop_folder(spark, stage.root)


def run_landed_month(
    spark: SparkSession,
    raw_month: DataFrame,
    apt_month: DataFrame | None,
    root: str,
    start: _dt.date,
    source_file: str = "",
    gates: tuple[quality.GateSpec, quality.GateSpec] = (quality.RIDERSHIP_GATE, quality.APT_GATE),
    baseline_year: int | None = None,
    run_time: str | None = None,
    run_id: str | None = None,
    rejected: DataFrame | None = None,
) -> None:
    """Gate, APT load, transform and audit of one landed month, as one run.

    The gate report is computed once and stored; it decides, and it is what
    the audit log gets. A failed gate is audited and raised. The run takes
    effect as a whole (see ``ledger``). With a ``run_id``, a run that was cut
    off and starts again under the same id equals one that was not, audit
    included, and one that starts again after its end does nothing; without one,
    every call is a run of its own. ``rejected`` has the ridership records that
    could not be read; they are counted by the gate and in the audit.
    """
    p, ledger = lake.LakePaths(root), Ledger(spark, root)
    ledger.recover()
    if run_id is not None and ledger.state(run_id):
        return
    run_id = run_id or uuid.uuid4().hex
    rid_gate, apt_gate = gates
    end = (start.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    known = lake.read_table(spark, p.station_names, schemas.STATION_NAMES)
    checks = quality.quality_report(raw_month, rid_gate, known)
    if rejected is not None:
        checks = checks.unionByName(quality.rejection_report(rejected, rid_gate))
    if apt_month is not None:
        checks = checks.unionByName(quality.quality_report(apt_month, apt_gate))
    stage = ledger.new_stage()
    lake.write_table(checks, stage.path("gate-report"))
    report = lake.read_table(spark, stage.path("gate-report"), checks.schema)
    audit = quality.audit_records(report, source_file, run_time)
    try:
        quality.enforce(report)
    except quality.GateFailure:
        lake.append_audit(audit, p.audit, run_id)
        raise
    stage_months(spark, raw_month, apt_month, p, stage, start, end, baseline_year)
    lake.append_audit(audit, stage.path("audit"), run_id)
    ledger.commit(run_id, stage)


def run_month(
    spark: SparkSession,
    raw_records: DataFrame,
    apt_records: DataFrame,
    root: str,
    as_of: _dt.date,
    source_file: str = "",
    gates: tuple[quality.GateSpec, quality.GateSpec] = (quality.RIDERSHIP_GATE, quality.APT_GATE),
    baseline_year: int | None = None,
    run_time: str | None = None,
    run_id: str | None = None,
) -> None:
    """The monthly run for the month before ``as_of``.

    Both records are sliced, coerced and landed once; everything after reads
    the landed month. ``run_id``: see ``run_landed_month``.
    """
    p = lake.LakePaths(root)
    start, _ = previous_month(as_of)
    raw_path = landing.land_month(raw_records, as_of, p.landing, "ridership", "transit_timestamp", gates[0].numeric_cols)
    apt_path = landing.land_month(apt_records, as_of, p.landing, "apt", "month", gates[1].numeric_cols)
    raw_month = lake.read_table(spark, raw_path, schemas.RIDERSHIP)
    apt_month = lake.read_table(spark, apt_path, schemas.APT)
    run_landed_month(spark, raw_month, apt_month, root, start, source_file, gates, baseline_year, run_time, run_id)


def run_csv_month(
    spark: SparkSession,
    csv_path: str,
    apt_records: DataFrame | None,
    root: str,
    as_of: _dt.date,
    source_file: str = "",
    gates: tuple[quality.GateSpec, quality.GateSpec] = (quality.RIDERSHIP_GATE, quality.APT_GATE),
    baseline_year: int | None = None,
    run_time: str | None = None,
    run_id: str | None = None,
    header: bool = True,
) -> None:
    """The monthly run on ridership delivered as CSV text.

    The month's good records and all rejected ones are landed in one pass;
    rejected ones stay in quarantine beside the month with their reason.
    """
    p = lake.LakePaths(root)
    start, _ = previous_month(as_of)
    raw_path = records.land_checked_month(
        records.read_checked_csv(spark, csv_path, schemas.RIDERSHIP, header), as_of, p.landing, "ridership",
        schemas.RIDERSHIP, "transit_timestamp",
    )
    apt_month = None
    if apt_records is not None:
        apt_path = landing.land_month(apt_records, as_of, p.landing, "apt", "month", gates[1].numeric_cols)
        apt_month = lake.read_table(spark, apt_path, schemas.APT)
    good = records.read_good(spark, raw_path, schemas.RIDERSHIP)
    run_landed_month(
        spark, good, apt_month, root, start, source_file, gates, baseline_year, run_time, run_id,
        records.read_rejected(spark, raw_path),
    )
