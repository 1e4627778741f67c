"""Lake writes, incremental runs and the streaming feed on sf0.001."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crowding import schemas
from crowding.operators import quality
from crowding.plans import runs
from crowding.session import scratch_path
from crowding.sources import lake, landing
from crowding.streaming import start_monthly_feed

GATES = (
    quality.GateSpec(**{**quality.RIDERSHIP_GATE.__dict__, "min_rows": 1}),
    quality.GateSpec(**{**quality.APT_GATE.__dict__, "min_rows": 1}),
)
CSI_KEYS = ["station_complex_id", "station_complex", "borough", "year", "month"]


def _rounded(df):
    return {
        tuple(r) for r in df.select(
            *CSI_KEYS,
            *[F.round(c, 9).alias(c) for c in ("csi", "apt_minutes", "csi_pctl", "apt_minutes_pctl",
                                                 "csi_6mo_rolling", "apt_6mo_rolling")],
            "danger_zone",
        ).collect()
    }


def _before(df, day):
    return df.filter(F.col("transit_timestamp") < F.lit(day).cast("timestamp_ntz"))


def test_incremental_equals_full_and_rerun(spark, inputs):
    root = scratch_path(spark, "t-incr")
    runs.build_history(spark, _before(inputs.raw, dt.date(2001, 9, 1)), inputs.apt, inputs.stations, root, 2000)
    runs.run_month(spark, inputs.raw, inputs.apt, root, dt.date(2001, 10, 3), "sep", GATES)
    runs.run_month(spark, inputs.raw, inputs.apt, root, dt.date(2001, 11, 3), "oct", GATES)
    runs.run_month(spark, inputs.raw, inputs.apt, root, dt.date(2001, 12, 3), "nov", GATES)
    p = lake.LakePaths(root)
    stored = lake.read_table(spark, p.csi, schemas.CSI)
    assert _rounded(stored) == _rounded(inputs.csi)
    n_csi = stored.count()
    n_hours = lake.read_table(spark, p.hours, schemas.HOURS).count()
    # re-running a month replaces it (fresh reads: the old file listing is stale)
    runs.run_month(spark, inputs.raw, inputs.apt, root, dt.date(2001, 11, 3), "oct", GATES)
    assert lake.read_table(spark, p.csi, schemas.CSI).count() == n_csi
    assert lake.read_table(spark, p.hours, schemas.HOURS).count() == n_hours
    audit = lake.read_table(spark, p.audit, schemas.AUDIT)
    assert audit.count() == 8 and {r["status"] for r in audit.collect()} == {"success"}


def test_hours_are_added_up_to_months_once(spark, inputs, monkeypatch):
    """Sketches, baseline and CSI of a load read the stored moments, not the hour table."""
    real, calls = runs.stress.station_month_moments, []

    def counted(hours):
        calls.append(hours)
        return real(hours)

    def again(hours):
        raise AssertionError("the hour rows are read again")

    monkeypatch.setattr(runs.stress, "station_month_moments", counted)
    monkeypatch.setattr(runs.stress, "peak_volume", again)
    root = scratch_path(spark, "t-moments")
    runs.build_history(spark, inputs.raw, inputs.apt, inputs.stations, root, 2000)
    assert len(calls) == 1
    assert _rounded(lake.read_table(spark, lake.LakePaths(root).csi, schemas.CSI)) == _rounded(inputs.csi)


def test_hour_rows_are_not_sorted_for_their_month_total(inputs):
    tree = inputs.hours._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in tree and "SortMergeJoin" not in tree


def test_failed_gate_is_audited(spark, inputs):
    root = scratch_path(spark, "t-gate")
    runs.build_history(spark, _before(inputs.raw, dt.date(2001, 10, 1)), inputs.apt, inputs.stations, root, 2000)
    with pytest.raises(quality.GateFailure):
        runs.run_month(spark, inputs.raw, inputs.apt, root, dt.date(2001, 11, 3), "oct")  # 200k floor
    audit = lake.read_table(spark, lake.LakePaths(root).audit, schemas.AUDIT).collect()
    assert {r["status"] for r in audit if r["dataset"] == "ridership"} == {"failed"}


def test_monthly_feed(spark, inputs):
    root = scratch_path(spark, "t-feed")
    landing_dir = scratch_path(spark, "t-landing")
    runs.build_history(spark, _before(inputs.raw, dt.date(2001, 9, 1)), inputs.apt, inputs.stations, root, 2000)
    for as_of in (dt.date(2001, 10, 2), dt.date(2001, 11, 2), dt.date(2001, 12, 2)):
        landing.land_month(inputs.raw, as_of, landing_dir, "ridership", "transit_timestamp",
                           quality.RIDERSHIP_GATE.numeric_cols)
    q = start_monthly_feed(spark, landing_dir, root, gates=GATES)
    q.awaitTermination(300)
    audit = lake.read_table(spark, lake.LakePaths(root).audit, schemas.AUDIT)
    assert {(r["source_file"], r["status"]) for r in audit.collect()} == {
        (f"ridership_2001_{m:02d}", "success") for m in (9, 10, 11)
    }
    # A restarted feed goes on where it stopped: nothing is processed again.
    start_monthly_feed(spark, landing_dir, root, gates=GATES).awaitTermination(300)
    assert lake.read_table(spark, lake.LakePaths(root).audit, schemas.AUDIT).count() == 3
    stored = lake.read_table(spark, lake.LakePaths(root).csi, schemas.CSI)
    assert _rounded(stored) == _rounded(inputs.csi)


def test_baseline_round_trip(spark, inputs):
    path = scratch_path(spark, "t-base")
    lake.write_baseline(inputs.baseline, path)
    back = lake.read_baseline(spark, path, 2000).collect()
    assert len(back) == 1 and back[0]["p90_peak_hr_ridership"] == inputs.baseline.first()["p90_peak_hr_ridership"]


def test_latest_month_filter_prunes_lake_partitions(spark, inputs):
    import contextlib
    import io

    from crowding.operators import reports

    path = scratch_path(spark, "t-prune")
    lake.write_partitioned(lake.conform(inputs.csi, schemas.CSI), path)
    csi = lake.read_table(spark, path, schemas.CSI)
    latest = reports.in_month(csi, csi)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        latest.explain(mode="formatted")
    scans = [b for b in buf.getvalue().split("\n\n") if "Scan parquet" in b and "PartitionFilters" in b]
    assert any("Subquery" in b.split("PartitionFilters")[1].split("\n")[0] for b in scans)
    got = {(r["year"], r["month"]) for r in latest.select("year", "month").distinct().collect()}
    assert got == {(2001, 11)}


def test_missing_baseline_fails_clearly(spark, inputs):
    path = scratch_path(spark, "t-nobase")
    lake.write_baseline(inputs.baseline, path)
    with pytest.raises(ValueError, match="baseline"):
        lake.require_baseline(spark, path, 1999)
    assert lake.require_baseline(spark, path, 2000).count() == 1


@pytest.mark.parametrize("p90", [None, 0.0])
def test_null_or_zero_baseline_fails_clearly(spark, p90):
    path = scratch_path(spark, "t-badbase")
    lake.write_baseline(spark.createDataFrame([(2000, p90)], schemas.BASELINE), path)
    with pytest.raises(ValueError, match="positive baseline"):
        lake.require_baseline(spark, path, 2000)


def test_history_without_baseline_year_fails(spark, inputs):
    root = scratch_path(spark, "t-noyear")
    with pytest.raises(ValueError, match="baseline"):
        runs.build_history(spark, inputs.raw, inputs.apt, inputs.stations, root, 1900)


def test_failing_gate_stops_the_feed(spark, inputs):
    root, landing_dir = scratch_path(spark, "t-feedgate"), scratch_path(spark, "t-landgate")
    runs.build_history(spark, _before(inputs.raw, dt.date(2001, 10, 1)), inputs.apt, inputs.stations, root, 2000)
    landing.land_month(inputs.raw, dt.date(2001, 11, 2), landing_dir, "ridership", "transit_timestamp", ())
    before = _rounded(lake.read_table(spark, lake.LakePaths(root).csi, schemas.CSI))
    q = start_monthly_feed(spark, landing_dir, root)
    with pytest.raises(Exception, match="row_count"):
        q.awaitTermination(300)
    audit = lake.read_table(spark, lake.LakePaths(root).audit, schemas.AUDIT).collect()
    assert [r["status"] for r in audit] == ["failed"]
    assert _rounded(lake.read_table(spark, lake.LakePaths(root).csi, schemas.CSI)) == before


def test_a_month_rerun_without_rows_goes(spark, inputs):
    root = scratch_path(spark, "t-shrink")
    start, end = dt.date(2001, 9, 1), dt.date(2001, 10, 1)
    runs.build_history(spark, inputs.raw, inputs.apt, inputs.stations, root, 2000)
    ts = F.col("transit_timestamp")
    inside = (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))
    runs.update_months(spark, inputs.raw.filter(~inside), lake.LakePaths(root), start, end, 2000)
    other = scratch_path(spark, "t-shrunk")
    runs.build_history(spark, inputs.raw.filter(~inside), inputs.apt, inputs.stations, other, 2000)
    got, want = (
        _rounded(lake.read_table(spark, lake.LakePaths(r).csi, schemas.CSI)) for r in (root, other)
    )
    assert got == want


def test_fixture_reads_every_line_item(spark, inputs):
    li = spark.read.parquet(f"{inputs.sf_dir}/lineitem.parquet").agg(F.sum("l_quantity")).first()[0]
    assert inputs.raw.agg(F.sum("ridership")).first()[0] == li
