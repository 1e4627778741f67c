"""Hand-made inputs for the edge cases (a few rows each)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crowding import schemas
from crowding.operators import delay, features, quality, reports, risk, stress
from crowding.sources import slices


def ts(*a):
    return dt.datetime(*a)


def raw_rows(spark, rows):
    """rows: (timestamp, station, ridership[, mode])."""
    full = []
    for r in rows:
        t, name, rid = r[:3]
        mode = r[3] if len(r) > 3 else "subway"
        full.append((t, mode, f"id-{name}", name, "B1", "omny", "full", rid, 0.0, None, None, None))
    return spark.createDataFrame(full, schemas.RIDERSHIP)


def hours_of(spark, rows):
    return features.time_features(features.hourly_fact(raw_rows(spark, rows)))


def test_null_hour_is_late_night(spark):
    df = spark.createDataFrame([(None,)], "transit_timestamp timestamp_ntz")
    out = features.time_features(df.withColumn("x", F.lit(1))).first()
    assert out["time_window"] == "late_night"
    assert out["hour_of_day"] is None


def test_time_bins_inclusive(spark):
    hours = [0, 6, 7, 9, 10, 15, 16, 19, 20, 23]
    df = spark.createDataFrame([(ts(2001, 1, 1, h),) for h in hours], "transit_timestamp timestamp_ntz")
    got = [r["time_window"] for r in features.time_features(df).orderBy("transit_timestamp").collect()]
    assert got == [
        "early_morning", "early_morning", "morning_peak", "morning_peak", "midday",
        "midday", "evening_peak", "evening_peak", "late_night", "late_night",
    ]


def test_weekend_flag(spark):
    days = [ts(2001, 10, 7), ts(2001, 10, 6), ts(2001, 10, 8)]  # Sun, Sat, Mon
    df = spark.createDataFrame([(d,) for d in days], "transit_timestamp timestamp_ntz")
    out = features.time_features(df).orderBy("transit_timestamp").collect()
    by_day = {r["transit_timestamp"].weekday(): (r["is_weekend"], r["day_of_week"]) for r in out}
    assert by_day[6] == (1, 1) and by_day[5] == (1, 7) and by_day[0] == (0, 2)


def test_payment_rows_merge(spark):
    h = hours_of(spark, [(ts(2001, 1, 1, 8), "A", 2.0), (ts(2001, 1, 1, 8), "A", 3.0),
                         (ts(2001, 1, 1, 8), "A", 7.0, "tram")])
    rows = h.collect()
    assert len(rows) == 1 and rows[0]["ridership"] == 5.0


def test_uniform_month_hhi(spark):
    n = 8
    h = hours_of(spark, [(ts(2001, 3, 1, i), "A", 10.0) for i in range(n)])
    v = stress.concentration(h).first()["hhi_monthly_concentration"]
    assert v == pytest.approx(1 / n)


def test_one_busy_hour_hhi_is_one(spark):
    h = hours_of(spark, [(ts(2001, 3, 1, 8), "A", 10.0)])
    assert stress.concentration(h).first()["hhi_monthly_concentration"] == pytest.approx(1.0)


def test_zero_month_null_hhi_and_csi(spark):
    h = hours_of(spark, [(ts(2001, 3, 1, 8), "A", 0.0), (ts(2001, 3, 1, 9), "A", 0.0)])
    row = stress.stress_index(h, 100.0).first()
    assert row["hhi_monthly_concentration"] is None and row["csi"] is None


def test_no_peak_rows_absent(spark):
    h = hours_of(spark, [(ts(2001, 3, 1, 3), "A", 5.0), (ts(2001, 3, 1, 8), "B", 5.0)])
    names = [r["station_complex"] for r in stress.stress_index(h, 10.0).collect()]
    assert names == ["B"]


def test_stress_matches_window_form(spark):
    rows = [(ts(2001, 3, d, h), "A", float(d * h % 7 + 1)) for d in range(1, 5) for h in range(0, 24, 3)]
    h = hours_of(spark, rows)
    got = stress.stress_index(h, 50.0).first()
    tot = sum(r[2] for r in rows)
    hhi = sum((r[2] / tot) ** 2 for r in rows)
    peak = sum(r[2] for r in rows if 7 <= r[0].hour <= 9 or 16 <= r[0].hour <= 19)
    assert got["hhi_monthly_concentration"] == pytest.approx(hhi)
    assert got["csi"] == pytest.approx(peak / 50.0 * hhi)


def test_baseline_is_exact_discrete_percentile(spark):
    peak = spark.createDataFrame([(2000, float(v)) for v in range(1, 11)], "year int, peak_hr_ridership double")
    assert stress.baseline_p90(peak, 2000).first()["p90_peak_hr_ridership"] == 9.0
    empty = stress.baseline_p90(peak, 1999).collect()
    assert len(empty) == 1 and empty[0]["p90_peak_hr_ridership"] is None


def _pctl_frame(spark, values):
    rows = [(f"s{i}", f"id{i}", "B", 2001, 1, 1.0, 1.0, 1.0, float(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows,
        "station_complex string, station_complex_id string, borough string, year int, month int, "
        "peak_hr_ridership double, volume_component double, hhi_monthly_concentration double, "
        "csi double, apt_minutes double",
    )


def test_percentiles_with_nulls(spark):
    out = risk.month_percentiles(_pctl_frame(spark, [None, None, 1.0, 2.0, 2.0, 3.0]))
    got = [r["apt_minutes_pctl"] for r in out.orderBy("csi").collect()]
    assert got == pytest.approx([0, 0, 0.4, 0.6, 0.6, 1.0])


def test_single_row_month_and_all_null_apt(spark):
    out = risk.percentile_flag(risk.month_percentiles(_pctl_frame(spark, [None]))).first()
    assert out["csi_pctl"] == 0.0 and out["apt_minutes_pctl"] == 0.0 and out["danger_zone"] == 0
    out = risk.percentile_flag(risk.month_percentiles(_pctl_frame(spark, [None] * 12)))
    assert {r["danger_zone"] for r in out.collect()} == {0}


def test_flag_needs_both_percentiles(spark):
    vals = [float(v) for v in range(20)]
    out = risk.percentile_flag(risk.month_percentiles(_pctl_frame(spark, vals))).collect()
    flagged = [r for r in out if r["danger_zone"] == 1]
    assert flagged and all(r["csi_pctl"] >= 0.9 and r["apt_minutes_pctl"] >= 0.9 for r in flagged)


def test_threshold_flag(spark):
    df = spark.createDataFrame([(0.7, 3.5), (0.7, 2.0), (0.5, None), (0.9, None)], "csi double, apt_minutes double")
    got = [r["danger_zone"] for r in risk.threshold_flag(df).collect()]
    assert got == [1, 0, 0, None]


def test_weighted_mean_null_metric_keeps_weight(spark):
    bridge = spark.createDataFrame([("c1", "A", "D", "M"), ("c1", "B", "D", "M")], schemas.ROUTE_LOOKUP)
    apt = spark.createDataFrame(
        [(None, "A DIV", "A", "peak", 10.0, None, None, None, None, None, None, 1.0, 2001, 1),
         (None, "A DIV", "B", "peak", 10.0, 2.0, None, None, None, None, None, 1.0, 2001, 1)],
        schemas.APT,
    )
    row = delay.station_delay(bridge, apt).first()
    assert row["apt_minutes"] == pytest.approx(1.0)
    assert row["num_lines_serving"] == 2 and row["total_line_passengers"] == 20.0


def test_route_parsing(spark):
    st = spark.createDataFrame(
        [("c1", "s1", "D1", "M", "A  C E "), ("c2", "s2", "D1", "M", None),
         ("c3", "s3", "D1", "M", "G"), ("c3", "s4", "D2", "M", "G")],
        schemas.STATIONS,
    )
    b = delay.route_bridge(st)
    assert sorted(r["route"] for r in b.filter("complex_id = 'c1'").collect()) == ["A", "C", "E"]
    assert b.filter("complex_id = 'c2'").count() == 0
    assert b.filter("complex_id = 'c3'").count() == 2  # lookup keeps both divisions
    apt = spark.createDataFrame(
        [(None, "B DIV", "G", "peak", 5.0, 1.0, None, None, None, None, None, 1.0, 2001, 1)], schemas.APT
    )
    d = delay.station_delay(b, apt).filter("complex_id = 'c3'").first()
    assert d["num_lines_serving"] == 1  # ... but the route counts once


def test_rolling_counts_rows_across_gaps(spark):
    rows = [("s", "id", "B", 2001, m, 0.0, 0.0, 0.0, float(m), None) for m in (1, 2, 9)]
    df = spark.createDataFrame(
        rows,
        "station_complex string, station_complex_id string, borough string, year int, month int, "
        "peak_hr_ridership double, volume_component double, hhi_monthly_concentration double, "
        "csi double, apt_minutes double",
    )
    got = [r["csi_6mo_rolling"] for r in risk.rolling_means(df).orderBy("month").collect()]
    assert got == pytest.approx([1.0, 1.5, 4.0])
    cal = [r["csi_6mo_rolling"] for r in risk.calendar_rolling_means(df).orderBy("month").collect()]
    assert cal == pytest.approx([1.0, 1.5, 9.0])


def test_top_k_ties_by_name(spark):
    csi = spark.createDataFrame(
        [("b", 2001, 1, 1.0, 1), ("a", 2001, 1, 1.0, 1), ("c", 2001, 1, 0.5, 1)],
        "station_complex string, year int, month int, csi double, danger_zone int",
    )
    got = [r["station_complex"] for r in reports.top_station_months(csi, k=2).collect()]
    assert got == ["a", "b"]


def test_best_row_earliest_month_on_ties(spark):
    csi = spark.createDataFrame(
        [("a", 2001, 3, 1.0), ("a", 2001, 1, 1.0), ("a", 2001, 2, None)],
        "station_complex string, year int, month int, csi double",
    )
    row = reports.best_row_per_station(csi, "csi", ["year", "month", "csi"]).first()
    assert (row["year"], row["month"]) == (2001, 1)


def test_january_slice(spark):
    df = spark.createDataFrame(
        [(ts(2025, 11, 30, 23),), (ts(2025, 12, 1, 0),), (ts(2025, 12, 31, 23),), (ts(2026, 1, 1, 0),)],
        "transit_timestamp timestamp_ntz",
    )
    got = slices.previous_month_slice(df, dt.date(2026, 1, 15)).collect()
    assert sorted(r[0] for r in got) == [ts(2025, 12, 1, 0), ts(2025, 12, 31, 23)]
    assert slices.previous_month(dt.date(2026, 1, 15)) == (dt.date(2025, 12, 1), dt.date(2026, 1, 1))


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5", "x"), ("n/a", "y")], "ridership string, other string")
    out = slices.coerce_numeric(df, ["ridership", "latitude"]).collect()
    assert [r["ridership"] for r in out] == [1.5, None] and [r["other"] for r in out] == ["x", "y"]


def _gate(spark, names, ridership=1.0, drop=None):
    rows = [(ts(2001, 10, 1, 8), f"n{i}", ridership) for i in range(len(names))]
    df = raw_rows(spark, rows)
    df = df.withColumn("station_complex", F.element_at(F.array(*[F.lit(n) for n in names]),
                                                         F.monotonically_increasing_id().cast("int") + 1))
    return df.drop(drop) if drop else df


def test_gates(spark):
    spec = quality.GateSpec("ridership", ("station_complex", "ridership"), ("ridership",), min_rows=3,
                            name_check=True, max_unknown=10)
    known = spark.createDataFrame([("k",)], "station_complex string")

    def passed(df):
        return quality.quality_report(df, spec, known).filter(~F.col("passed")).count() == 0

    def rows(names, rid=1.0):
        data = [(ts(2001, 10, 1, 8), "subway", "id", n, "B", "p", "f", rid, 0.0, None, None, None) for n in names]
        return spark.createDataFrame(data, schemas.RIDERSHIP)

    assert not passed(rows(["k", "k"]))                       # too few rows
    assert not passed(rows(["k", "k", "k"], rid=None))        # null in a critical column
    assert passed(rows(["k"] + [f"u{i}" for i in range(10)]))  # 10 unknown names
    assert not passed(rows(["k"] + [f"u{i}" for i in range(11)]))  # 11
    assert not passed(rows(["k", "k", "k"]).drop("ridership"))  # missing column
    rep = quality.quality_report(rows(["k", "k", "k"]).drop("ridership"), spec, known)
    with pytest.raises(quality.GateFailure):
        quality.enforce(rep)


def test_nan_counts_as_missing(spark):
    spec = quality.GateSpec("x", ("ridership",), (), min_rows=1)
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "ridership double")
    nulls = quality.quality_report(df, spec).filter("check = 'nulls'").first()
    assert nulls["value"] == 1 and not nulls["passed"]


def test_names_with_several_ids(spark):
    rows = [(ts(2001, 1, 1, 8), "subway", i, n, "B", "p", "f", 1.0, 0.0, None, None, None)
            for i, n in [("1", "86 St"), ("2", "86 St"), ("3", "Main"), ("3", "Main"), (None, "Solo")]]
    df = spark.createDataFrame(rows, schemas.RIDERSHIP)
    got = [(r["station_complex"], r["id_count"]) for r in quality.names_with_several_ids(df).collect()]
    assert got == [("86 St", 2)]


def test_stable_round_keeps_what_it_cannot_count(spark):
    from crowding.functions.numeric import stable_round

    values = [1e10, 1e13, -1e18, float("inf"), float("-inf"), None, 1.23456749, 3e-8]
    df = spark.createDataFrame([(v,) for v in values] + [(float("nan"),)], "x double")
    got = [r[0] for r in df.select(stable_round("x", 6)).collect()]
    assert got[:6] == values[:6] and got[6] == 1.234567 and got[7] == 0.0 and got[8] != got[8]
    nine = [r[0] for r in df.select(stable_round("x", 9)).collect()]
    assert nine[:3] == [1e10, 1e13, -1e18] and nine[7] == 3e-8


def test_rank_key_is_relative(spark):
    from crowding.functions.numeric import rank_key

    values = [1.23e-8, 1.23e-8 * (1 + 1e-15), 1.23001e-8, 1e13, 1e13 * (1 + 1e-15), 1e13 + 1e3, float("inf")]
    df = spark.createDataFrame([(v,) for v in values] + [(float("nan"),)], "x double")
    k = [r[0] for r in df.select(rank_key("x")).collect()]
    assert k[0] == k[1] < k[2] and k[3] == k[4] < k[5] and k[6] == float("inf") and k[7] != k[7]
