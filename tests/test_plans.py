"""Physical-plan guards: what every registered query must (not) contain."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from crowding.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES = {n: fn for n, fn in entry.queries().items() if n in REGISTRY}


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(fn(spark, SF)) for name, fn in QUERIES.items()}


def test_no_cartesian_or_nested_loop_joins(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_no_python_udfs(plans):
    bad = {n for n, p in plans.items() if "EvalPython" in p or "PythonUDF" in p}
    assert not bad


def test_fact_scans_push_filters_and_prune_columns(plans):
    for name, p in plans.items():
        blocks = [b for b in p.split("\n\n") if "Scan parquet" in b and "lineitem.parquet" in b]
        for b in blocks:
            read = [l for l in b.splitlines() if l.startswith("ReadSchema")][0]
            assert "l_comment" not in read and "l_extendedprice" not in read, (name, read)


def test_stress_index_shuffles_hour_rows_once(inputs):
    from crowding.operators import stress

    tree = plan_of(stress.stress_index(inputs.hour_features, 100.0)).split("\n\n")[0]
    # hour-grain aggregate, station-month moments, station-name-month window
    assert tree.count("- Exchange (") == 3, tree
    assert "Window" in tree and "SortMergeJoin" not in tree


def test_flagship_reads_stored_moments(plans):
    tree = plans["stress_index"].split("\n\n")[0].split("Subquery")[0]
    # the raw extract was aggregated once into the stored moments; the CSI
    # plan only shuffles station-month rows for the HHI window
    assert tree.count("- Exchange (") == 1, tree
    assert "lineitem" not in plans["stress_index"]


def test_top_k_reports_plan_as_take_ordered(plans):
    for name in ("flagged_by_csi", "flagged_by_apt", "top_station_months", "flagged_latest_top10"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_raw_rows_are_combined_before_the_shuffle(plans):
    """The hour-level aggregate sums map-side first, so a hot station's raw
    rows are reduced inside their own tasks before any exchange."""
    for name in ("hourly_fact", "monthly_total_rank", "concentration_hhi"):
        p = plans[name]
        # node details are listed leaves first: the partial sum precedes the
        # first hash exchange on the station keys
        first_exchange = p.index("Arguments: hashpartitioning(station_complex")
        assert "partial_sum(ridership" in p[:first_exchange], name


@pytest.fixture(scope="module")
def raw_file(spark, inputs):
    """The mapped records as a landed Parquet file with a real time column."""
    from crowding import schemas
    from crowding.session import scratch_path
    from crowding.sources import lake

    path = scratch_path(spark, "t-raw")
    lake.write_table(lake.conform(inputs.raw, schemas.RIDERSHIP), path)
    return lake.read_table(spark, path, schemas.RIDERSHIP)


def test_year_ranges_reach_the_scan(raw_file):
    from crowding.operators import reports
    from crowding.sources import slices

    totals = plan_of(reports.borough_totals(raw_file, 2000, 2000))
    year = plan_of(slices.year_slice(raw_file, 2000))
    for plan in (totals, year):
        pushed = plan.split("PushedFilters: [")[1].split("]\n")[0]
        assert "GreaterThanOrEqual(transit_timestamp,2000-01-01T00:00)" in pushed
        assert "LessThan(transit_timestamp,2001-01-01T00:00)" in pushed


def test_month_reports_read_one_partition(inputs):
    from crowding.operators import reports

    stated = plan_of(reports.month_table(inputs.csi_stored, inputs.month_totals, (2001, 10)))
    blocks = [b for b in stated.split("\n\n") if "Scan parquet" in b and "PartitionFilters" in b]
    assert any("(year#" in b and "= 2001)" in b and "= 10)" in b for b in blocks)
    latest = plan_of(reports.month_table(inputs.csi_stored, inputs.month_totals))
    assert "lineitem" not in latest


def test_heatmap_names_are_looked_up_below_the_hour_aggregate(plans):
    """The few names cut the raw rows, before they are added up to hours."""
    for name in ("heatmap_long", "heatmap_pivot"):
        tree = plans[name].split("\n\n")[0]
        at = tree.index("LeftSemi")
        # Above it: both steps of the hours' aggregate and of the heatmap's.
        assert tree[:at].count("HashAggregate") >= 4, tree
        assert "lineitem" not in tree[:at]


def test_delay_reaches_the_percentiles_without_raw_rows(plans):
    """Station-months join station delays; line items are aggregated on either side first."""
    tree = plans["risk_flag"].split("\n\n")[0]
    at = tree.index("LeftOuter")
    assert "Window" in tree[:at] and "HashAggregate" not in tree[:at], tree


def test_new_queries_have_no_window_without_partitions_over_rows(plans):
    """The only unpartitioned windows are those over one row per partition."""
    for name in ("landed_pages", "hour_ranks"):
        for block in plans[name].split("\n\n"):
            if ") Window" in block and "[], " in block:
                assert "_part" in block, block
