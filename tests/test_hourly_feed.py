"""The hourly feed with late rows, and baselines from stored sketches."""

import contextlib
import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowding import schemas
from crowding.operators import stress
from crowding.plans import runs
from crowding.session import scratch_path
from crowding.sources import lake
from crowding.streaming import settled_hours, start_hourly_feed, streamed_hours


def _deliver(spark, folder, rows):
    """Rows (hour as 'ddThh', station, ridership) landed as one delivery."""
    made = [
        (dt.datetime(2001, 5, int(t[:2]), int(t[3:])), "subway" if s != "tram" else "tram", s, f"Station {s}", "B",
         "card", "full", float(r), 0.0, None, None, None)
        for t, s, r in rows
    ]
    lake.write_table(spark.createDataFrame(made, schemas.RIDERSHIP).repartition(2), folder)


def _feed(spark, landing, root):
    feed = start_hourly_feed(spark, landing, root, "2 days")
    feed.awaitTermination(300)
    assert feed.exception() is None


def _hours(df):
    return {(r["station_complex_id"], f"{r['transit_timestamp']:%dT%H}"): r for r in df.collect()}


def test_late_rows_count_until_their_hour_is_written(spark):
    landing, root = scratch_path(spark, "t-hl"), scratch_path(spark, "t-hf")
    _deliver(spark, f"{landing}/a", [("01T08", "1", 5), ("01T08", "1", 7), ("02T08", "1", 1), ("05T09", "2", 3), ("09T09", "tram", 3)])
    _feed(spark, landing, root)
    # The watermark is at 03T09: the first two hours are written, the third is open.
    first = _hours(streamed_hours(spark, root))
    assert {k: r["ridership"] for k, r in first.items()} == {("1", "01T08"): 12.0, ("1", "02T08"): 1.0}
    assert {k: r["state"] for k, r in _hours(settled_hours(spark, landing, root)).items()} == {
        ("1", "01T08"): "streamed", ("1", "02T08"): "streamed", ("2", "05T09"): "open"
    }
    # After a restart: late but in time for open hours, too late for a written and for an unseen one.
    _deliver(spark, f"{landing}/b", [("05T09", "2", 4), ("04T01", "1", 2), ("01T08", "1", 100), ("02T10", "3", 9), ("20T00", "1", 1)])
    _feed(spark, landing, root)
    _feed(spark, landing, root)  # nothing new: nothing happens
    second = _hours(streamed_hours(spark, root))
    assert {k: r["ridership"] for k, r in second.items()} == {
        ("1", "01T08"): 12.0, ("1", "02T08"): 1.0, ("2", "05T09"): 7.0, ("1", "04T01"): 2.0
    }
    settled = _hours(settled_hours(spark, landing, root))
    assert {k: (r["ridership"], r["state"]) for k, r in settled.items()} == {
        ("1", "01T08"): (112.0, "corrected"), ("1", "02T08"): (1.0, "streamed"), ("2", "05T09"): (7.0, "streamed"),
        ("1", "04T01"): (2.0, "streamed"), ("3", "02T10"): (9.0, "corrected"), ("1", "20T00"): (1.0, "open"),
    }


def test_nothing_written_yet_is_open(spark):
    landing, root = scratch_path(spark, "t-hl"), scratch_path(spark, "t-hf")
    _deliver(spark, f"{landing}/a", [("01T08", "1", 5)])
    _feed(spark, landing, root)
    assert [r["state"] for r in settled_hours(spark, landing, root).collect()] == ["open"]


def test_hours_are_not_held_in_memory(spark):
    landing, root = scratch_path(spark, "t-hl"), scratch_path(spark, "t-hf")
    for part, rows in (("a", [("01T08", "1", 5), ("05T09", "2", 3)]), ("b", [("05T09", "2", 4)]), ("c", [("09T09", "tram", 3)])):
        _deliver(spark, f"{landing}/{part}", rows)
        feed = start_hourly_feed(spark, landing, root, "2 days")
        feed.awaitTermination(300)
        assert feed.exception() is None
        # A delivery is one batch, whatever its size: no state store may have to hold it.
        assert feed.recentProgress and not any(p["stateOperators"] for p in feed.recentProgress)
    assert {k: r["ridership"] for k, r in _hours(streamed_hours(spark, root)).items()} == {("1", "01T08"): 5.0}
    settled = _hours(settled_hours(spark, landing, root))
    assert {k: (r["ridership"], r["state"]) for k, r in settled.items()} == {
        ("1", "01T08"): (5.0, "streamed"), ("2", "05T09"): (7.0, "open")
    }


@pytest.mark.parametrize("cut", ["open_hours", "marks"])
def test_a_batch_that_was_cut_off_counts_once(spark, monkeypatch, cut):
    landing, root = scratch_path(spark, "t-hl"), scratch_path(spark, "t-hf")
    _deliver(spark, f"{landing}/a", [("01T08", "1", 5), ("05T09", "2", 3)])
    _feed(spark, landing, root)
    _deliver(spark, f"{landing}/b", [("05T09", "2", 4), ("01T08", "1", 1), ("20T00", "1", 1)])
    write = lake.write_table

    def broken(df, path):
        if cut in path:
            raise OSError("cut off")
        write(df, path)

    with monkeypatch.context() as m:
        m.setattr(lake, "write_table", broken)
        with pytest.raises(Exception, match="cut off"):
            _feed(spark, landing, root)
    # What the batch had stored by then is not seen.
    assert {k: r["ridership"] for k, r in _hours(streamed_hours(spark, root)).items()} == {("1", "01T08"): 5.0}
    _feed(spark, landing, root)
    assert sorted((r["station_complex_id"], r["ridership"]) for r in streamed_hours(spark, root).collect()) == [("1", 5.0), ("2", 7.0)]
    settled = _hours(settled_hours(spark, landing, root))
    assert {k: (r["ridership"], r["state"]) for k, r in settled.items()} == {
        ("1", "01T08"): (6.0, "corrected"), ("2", "05T09"): (7.0, "streamed"), ("1", "20T00"): (1.0, "open")
    }


def test_a_first_batch_without_rows_of_the_mode(spark):
    landing, root = scratch_path(spark, "t-hl"), scratch_path(spark, "t-hf")
    _deliver(spark, f"{landing}/a", [("09T09", "tram", 3)])
    _feed(spark, landing, root)
    assert streamed_hours(spark, root).count() == settled_hours(spark, landing, root).count() == 0
    _deliver(spark, f"{landing}/b", [("01T08", "1", 5), ("05T09", "2", 3)])
    _feed(spark, landing, root)
    assert {k: r["state"] for k, r in _hours(settled_hours(spark, landing, root)).items()} == {
        ("1", "01T08"): "streamed", ("2", "05T09"): "open"
    }


def test_hours_with_nulls_settle(spark):
    landing, root = scratch_path(spark, "t-hl"), scratch_path(spark, "t-hf")
    at = dt.datetime(2001, 5, 1, 8)
    made = [
        (t, "subway", None, name, "B", "card", "full", riders, 0.0, None, None, None)
        for t, name, riders in ((at, None, 2.0), (at, None, 3.0), (at, "x", None), (None, "x", 1.0), (at + dt.timedelta(9), "x", 1.0))
    ]
    lake.write_table(spark.createDataFrame(made, schemas.RIDERSHIP).repartition(2), f"{landing}/a")
    _feed(spark, landing, root)
    settled = {(r["station_complex"], r["transit_timestamp"]): (r["ridership"], r["state"]) for r in settled_hours(spark, landing, root).collect()}
    assert settled == {
        (None, at): (5.0, "streamed"), ("x", at): (None, "streamed"),
        ("x", None): (1.0, "open"), ("x", at + dt.timedelta(9)): (1.0, "open"),
    }


def test_settled_hours_are_shuffled_once_and_not_sorted(spark):
    landing, root = scratch_path(spark, "t-hl"), scratch_path(spark, "t-hf")
    _deliver(spark, f"{landing}/a", [("01T08", "1", 5), ("09T09", "2", 3)])
    _feed(spark, landing, root)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        settled_hours(spark, landing, root).explain(mode="formatted")
    tree = out.getvalue().split("\n\n")[0]
    assert tree.count("- Exchange (") == 1 and "Join" not in tree and "Sort" not in tree, tree


def _peaks(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(f"s{i}", str(i), "B", 2000 + i % 2, 1 + i % 12, float(v)) for i, v in enumerate(rng.lognormal(3, 1, n))]
    rows += [("none", "x", "B", 2000, 1, None)]
    return spark.createDataFrame(
        rows, "station_complex string, station_complex_id string, borough string, year int, month int, peak_hr_ridership double"
    ).repartition(6)


def test_sketches_of_few_values_are_exact(spark):
    peak = _peaks(spark, 3000)
    sketches = stress.peak_sketches(peak)
    assert sketches.count() == 12  # odd months fall in one year, even ones in the other
    for year in (2000, 2001):
        got = stress.baseline_from_sketches(sketches, dt.date(year, 1, 1), dt.date(year + 1, 1, 1)).first()
        want = stress.baseline_p90(peak, year).first()
        assert got["p90_peak_hr_ridership"] == want["p90_peak_hr_ridership"] and got["n"] == 1500
    none = stress.baseline_from_sketches(sketches, dt.date(1990, 1, 1), dt.date(1991, 1, 1)).first()
    assert none["p90_peak_hr_ridership"] is None and none["n"] == 0


@pytest.mark.parametrize("k", [64, 512])
def test_merged_sketches_keep_their_rank_error(spark, k):
    peak = _peaks(spark, 40_000, k)
    sketches = stress.peak_sketches(peak, k)
    got = stress.baseline_from_sketches(sketches, dt.date(2000, 3, 1), dt.date(2001, 9, 1), k=k).first()["p90_peak_hr_ridership"]
    day = F.make_date("year", "month", F.lit(1))
    inside = peak.where((day >= dt.date(2000, 3, 1)) & (day < dt.date(2001, 9, 1))).where("peak_hr_ridership IS NOT NULL")
    rank = inside.agg(F.avg((F.col("peak_hr_ridership") <= got).cast("int"))).first()[0]
    assert abs(rank - 0.9) <= 1.5 * stress.sketch_rank_error(k)
    # The merged sketch is bounded by k, not by what went in.
    size = sketches.agg(F.max(F.octet_length("sketch"))).first()[0]
    assert size < 60 * k


def test_another_baseline_needs_no_rows(spark, inputs):
    root = scratch_path(spark, "t-rebase")
    p = runs.build_history(spark, inputs.raw, inputs.apt, inputs.stations, root, 2000)
    for path in (p.ridership, p.hours):  # not read any more
        lake.drop_folder(spark, path)
    got = runs.rebase(spark, root, dt.date(1998, 1, 1), dt.date(1999, 1, 1)).first()
    peak = stress.peak_volume(inputs.hour_features)
    assert tuple(got) == tuple(stress.baseline_p90(peak, 1998).first())
    with pytest.raises(ValueError, match="baseline"):
        runs.rebase(spark, root, dt.date(1890, 1, 1), dt.date(1891, 1, 1))
