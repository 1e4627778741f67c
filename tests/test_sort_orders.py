"""Queries that promise an order: the rows come in it."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORDERS = {
    "borough_totals": lambda r: (r["year"], -r["total_ridership"]),
    "flagged_by_csi": lambda r: -r["csi"],
    "flagged_by_apt": lambda r: -r["apt_minutes"],
    "top_station_months": lambda r: -r["csi"],
    "top5_per_borough_month": lambda r: (r["borough_order"], r["rank_in_borough"]),
    "trend_series_month": lambda r: (r["year"], r["month"], r["station_complex"], r["metric"]),
    "trend_high_unflagged": lambda r: (r["year"], r["month"], r["station_complex"]),
    "preview": lambda r: (r["transit_timestamp"], r["station_complex"]),
    "year_slice": lambda r: (r["transit_timestamp"], r["station_complex_id"]),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    keys = [ORDERS[name](r) for r in entry.queries()[name](spark, SF).collect()]
    assert keys == sorted(keys)
