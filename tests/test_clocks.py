"""Local hours that clocks skip or show twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crowding import schemas
from crowding.functions.calendar import clock_hour
from crowding.operators import quality


def _kinds(spark, zone, times):
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    return {r["t"]: r["k"] for r in df.select("t", clock_hour(F.col("t"), zone).alias("k")).collect()}


@pytest.mark.parametrize(
    "zone, skipped, repeated",
    [
        ("America/New_York", dt.datetime(2025, 3, 9, 2), dt.datetime(2025, 11, 2, 1)),
        ("America/New_York", dt.datetime(2001, 4, 1, 2), dt.datetime(2001, 10, 28, 1)),
        ("Europe/Berlin", dt.datetime(2025, 3, 30, 2), dt.datetime(2025, 10, 26, 2)),
        ("Australia/Sydney", dt.datetime(2025, 10, 5, 2), dt.datetime(2025, 4, 6, 2)),
    ],
)
def test_changes_of_a_zone(spark, zone, skipped, repeated):
    hour = dt.timedelta(hours=1)
    times = [day + n * hour for day in (skipped.replace(hour=0), repeated.replace(hour=0)) for n in range(24)]
    times += [t + dt.timedelta(minutes=30) for t in (skipped, repeated)]
    kinds = _kinds(spark, zone, [*times, None])
    assert {t for t, k in kinds.items() if k == "skipped"} == {skipped, skipped + hour / 2}
    assert {t for t, k in kinds.items() if k == "repeated"} == {repeated, repeated + hour / 2}
    assert kinds[None] is None


def test_a_zone_without_changes(spark):
    day = dt.datetime(2025, 3, 9)
    assert set(_kinds(spark, "UTC", [day + dt.timedelta(hours=n) for n in range(24)]).values()) == {"plain"}


def _rows(spark, times):
    made = [(t, "subway", "1", "A", "B", "m", "f", 2.0, 0.0, None, None, None) for t in times]
    return spark.createDataFrame(made, schemas.RIDERSHIP)


def test_the_gate_counts_them(spark):
    skipped, repeated = dt.datetime(2025, 3, 9, 2), dt.datetime(2025, 11, 2, 1)
    rows = _rows(spark, [skipped, repeated, repeated, dt.datetime(2025, 6, 1, 2), None])
    report = {r["check"]: r for r in quality.clock_report(rows, quality.RIDERSHIP_GATE, "America/New_York").collect()}
    assert (report["skipped_hours"]["value"], report["skipped_hours"]["passed"]) == (1, False)
    assert (report["repeated_hours"]["value"], report["repeated_hours"]["passed"]) == (2, True)
    assert report["skipped_hours"].asDict().keys() == set(quality.REPORT_COLUMNS)
    with pytest.raises(quality.GateFailure, match="skipped_hours"):
        quality.enforce(quality.clock_report(rows, quality.RIDERSHIP_GATE, "America/New_York"))
    days = quality.changeover_hours(rows, "America/New_York").collect()
    assert {(r["hour"], r["clock"], r["records"]) for r in days} == {(skipped, "skipped", 1), (repeated, "repeated", 2)}
    none = {r["check"]: r["value"] for r in quality.clock_report(rows.limit(0), quality.RIDERSHIP_GATE, "UTC").collect()}
    assert none == {"skipped_hours": 0, "repeated_hours": 0}


def test_changeovers_are_looked_up_after_the_rows_are_added_up(spark):
    """The lookup of a day costs two dozen clock conversions: a few per hour of data, none per row."""
    found = quality.changeover_hours(_rows(spark, [dt.datetime(2025, 3, 9, 2)]), "America/New_York")
    tree = found._jdf.queryExecution().optimizedPlan().toString()
    below = tree[tree.index("Aggregate ["):]
    assert "exists(" in tree and "from_utc_timestamp" not in below[below.index("\n"):], tree
