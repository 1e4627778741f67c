"""Hand-made inputs for the report operators and optional variants."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowding import schemas
from crowding.operators import delay, features, quality, reports, stress
from crowding.session import scratch_path
from crowding.sources import landing


def test_line_aliases_map_routes_to_lines(spark):
    st_df = spark.createDataFrame([("c1", "s", "D", "M", "S 7")], schemas.STATIONS)
    apt = spark.createDataFrame(
        [(None, "A", "S 42nd", "peak", 4.0, 3.0, None, None, None, None, None, 1.0, 2001, 1),
         (None, "A", "7", "peak", 4.0, 1.0, None, None, None, None, None, 1.0, 2001, 1)],
        schemas.APT,
    )
    bridge = delay.route_bridge(st_df)
    plain = delay.station_delay(bridge, apt).first()
    assert plain["num_lines_serving"] == 1 and plain["apt_minutes"] == 1.0  # 'S' unmatched
    aliases = spark.createDataFrame([("S", "S 42nd")], "route string, line string")
    mapped = delay.station_delay(bridge, apt, aliases).first()
    assert mapped["num_lines_serving"] == 2 and mapped["apt_minutes"] == pytest.approx(2.0)


def test_latest_month_crosses_years(spark):
    csi = spark.createDataFrame([(2000, 12), (2001, 1), (2000, 11)], "year int, month int")
    row = reports.latest_month(csi).first()
    assert (row["year"], row["month"], row["month_name"]) == (2001, 1, "January")


def _latest(spark):
    rows = [
        ("a", "AFRICA", 300.0, 0.1234, 1.26, 0.5, 0.25),
        ("b", "AFRICA", 300.0, 0.2, None, 0.75, 0.0),
        ("c", "AFRICA", 100.0, 0.3, 1.0, 1.0, 1.0),
        ("d", "ASIA", 1234567.0, 0.4, 2.0, 0.5, 0.5),
        ("e", "MIDDLE EAST", 999.0, 0.5, 2.0, 0.5, 0.5),
    ]
    return spark.createDataFrame(
        rows,
        "station_complex string, borough string, monthly_ridership double, csi double, "
        "apt_minutes double, csi_pctl double, apt_minutes_pctl double",
    )


def test_top_per_borough_order_ties_and_format(spark):
    out = reports.top_per_borough(_latest(spark), ["ASIA", "AFRICA"], k=2).collect()
    got = [(r["borough_order"], r["rank_in_borough"], r["station_complex"]) for r in out]
    assert got == [(1, 1, "d"), (2, 1, "a"), (2, 2, "b")]
    d = out[0]
    assert d["monthly_ridership_fmt"] == "1,234,567" and d["csi_fmt"] == "0.400"
    assert out[1]["apt_minutes_fmt"] == "1.3" and out[2]["apt_minutes_fmt"] is None


def test_scatter_points_drop_missing_apt(spark):
    df = _latest(spark).withColumn("danger_zone", F.lit(1)).withColumn("volume_component", F.lit(1.0)) \
        .withColumn("hhi_monthly_concentration", F.lit(0.1)).withColumn("peak_hr_ridership", F.lit(5.0))
    df = df.union(df.limit(1).withColumn("apt_minutes", F.lit(float("nan"))).withColumn("station_complex", F.lit("z")))
    names = {r["station_complex"] for r in reports.scatter_points(df).collect()}
    assert names == {"a", "c", "d", "e"}
    assert reports.scatter_points(df).first()["danger_zone_str"] == "1"


def test_heatmap_pivot_has_24_hour_columns(spark):
    rows = [(dt.datetime(2001, 10, 7, h), "subway", "1", "S", "B", "p", "f", float(h), 0.0, None, None, None)
            for h in (0, 8, 8)]
    raw = spark.createDataFrame(rows, schemas.RIDERSHIP)
    hours = features.time_features(features.hourly_fact(raw))
    out = reports.heatmap_pivot(hours, spark.createDataFrame([("S",)], "station_complex string"))
    row = out.first()
    assert out.columns[2:] == [f"h{h:02d}" for h in range(24)]
    assert row["day_of_week"] == 1 and row["h00"] == 0.0 and row["h08"] == 16.0 and row["h05"] is None


def test_failed_gate_audit_status(spark):
    spec = quality.GateSpec("x", ("ridership",), (), min_rows=5)
    df = spark.createDataFrame([(1.0,)], "ridership double")
    rec = quality.audit_records(quality.quality_report(df, spec), "f").first()
    assert rec["status"] == "failed" and rec["rows_ingested"] == 1 and rec["run_date"].endswith("Z")


def test_pages_round_trip(spark):
    rows = [(dt.datetime(2000, 1, 1, h % 24), "subway", str(h), f"S{h}", "B", "p", "f", float(h), 0.0, None, None, None)
            for h in range(30)]
    raw = spark.createDataFrame(rows, schemas.RIDERSHIP)
    path = scratch_path(spark, "t-pages")
    landing.land_pages(raw, path, page_rows=7)
    back = landing.read_pages(spark, path, schemas.RIDERSHIP)
    assert back.count() == 30 and len([f for f in back.inputFiles() if f.endswith(".csv")]) >= 5
    assert back.exceptAll(raw).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=30))
def test_hhi_bounds_and_share_sum(spark, values):
    rows = [(dt.datetime(2001, 5, 1 + i // 24, i % 24), "subway", "1", "S", "B", "p", "f", float(v), 0.0, None, None, None)
            for i, v in enumerate(values)]
    hours = features.time_features(features.hourly_fact(spark.createDataFrame(rows, schemas.RIDERSHIP)))
    hhi = stress.concentration(hours).first()["hhi_monthly_concentration"]
    total = sum(values)
    if total == 0:
        assert hhi is None
        return
    nonzero = [v for v in values if v]
    assert 1 / len(values) - 1e-12 <= hhi <= 1 + 1e-12
    assert hhi == pytest.approx(sum((v / total) ** 2 for v in nonzero))
    assert sum(v / total for v in values) == pytest.approx(1.0)


def test_heatmap_month_argument(spark):
    rows = [(dt.datetime(2001, m, 7, 8), "subway", "1", "S", "B", "p", "f", float(m), 0.0, None, None, None)
            for m in (9, 10)]
    hours = features.time_features(features.hourly_fact(spark.createDataFrame(rows, schemas.RIDERSHIP)))
    st_df = spark.createDataFrame([("S",)], "station_complex string")
    all_months = reports.heatmap_long(hours, st_df).collect()
    october = reports.heatmap_long(hours, st_df, year=2001, month=10).collect()
    assert len(all_months) == 2 and [r["avg_ridership"] for r in october] == [10.0]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=5)), min_size=1, max_size=25))
def test_percent_rank_matches_brute_force(spark, values):
    from crowding.operators import risk

    rows = [(f"s{i}", f"id{i}", "B", 2001, 1, 1.0, 1.0, 1.0, 1.0,
             None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(
        rows,
        "station_complex string, station_complex_id string, borough string, year int, month int, "
        "peak_hr_ridership double, volume_component double, hhi_monthly_concentration double, "
        "csi double, apt_minutes double",
    )
    got = {r["station_complex"]: r["apt_minutes_pctl"] for r in risk.month_percentiles(df).collect()}
    n = len(values)
    key = [(-1 if v is None else v) for v in values]  # nulls first
    for i, k in enumerate(key):
        smaller = sum(1 for other in key if other < k)
        want = 0.0 if n == 1 else smaller / (n - 1)
        assert got[f"s{i}"] == pytest.approx(want)
