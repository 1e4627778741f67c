"""Numbered pages, distributed ranks and records that can't be read."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crowding import schemas
from crowding.operators import quality
from crowding.operators.numbering import group_ranks, numbered
from crowding.session import scratch_path
from crowding.sources import lake, landing, records


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small inputs keep all shuffle partitions, so that there are borders between them."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def _rows(spark, n, hot=0.0, seed=1):
    rng = random.Random(seed)
    data = [(0 if rng.random() < hot else rng.randrange(n), i) for i in range(n)]
    return spark.createDataFrame(data, "k long, i long").repartition(5)


@pytest.mark.parametrize("hot", [0.0, 0.5, 1.0])
def test_numbers_run_from_one_in_order(spark, hot):
    got = numbered(_rows(spark, 3000, hot), [F.col("k")]).orderBy("row_number").collect()
    assert [r["row_number"] for r in got] == list(range(1, 3001))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)
    assert sorted(r["i"] for r in got) == list(range(3000))


def test_numbers_of_no_rows(spark):
    assert numbered(_rows(spark, 3).limit(0), [F.col("k")]).count() == 0


def test_one_value_is_spread_over_partitions(spark):
    from crowding.operators.numbering import stored_in_order

    parts = stored_in_order(_rows(spark, 4000, 1.0), [F.col("k")], scratch_path(spark, "t-hot")).groupBy("_part").count()
    assert parts.count() > 1


def _page_files(path):
    import glob

    return sorted(glob.glob(f"{path.removeprefix('file:')}/pages/page=*/part-*"))


@pytest.mark.parametrize("n, size, pages", [(1000, 100, 10), (1001, 100, 11), (99, 100, 1), (0, 100, 0)])
def test_every_page_but_the_last_is_full(spark, n, size, pages):
    path = scratch_path(spark, "t-pages")
    df = spark.range(n).select(F.floor((F.col("id") * 7919) % 1009 / 10).alias("k"), "id").repartition(3)
    assert landing.land_fixed_pages(df, path, ("k",), size, pages_a_job=4) == pages
    if not pages:
        return
    manifest = [tuple(r) for r in landing.read_manifest(spark, path).orderBy("page").collect()]
    sizes = [min(size, n - p * size) for p in range(pages)]
    assert manifest == [(p, p * size + 1, sizes[p]) for p in range(pages)]
    back = landing.read_fixed_pages(spark, path, df.schema)
    assert len(_page_files(path)) == pages
    got = {p: sorted(r["k"] for r in back.where(F.col("page") == p).collect()) for p in range(pages)}
    flat = [k for p in range(pages) for k in got[p]]
    assert flat == sorted(r["k"] for r in df.collect()) and [len(got[p]) for p in range(pages)] == sizes
    assert sorted(r["id"] for r in back.collect()) == list(range(n))


def test_a_stopped_landing_goes_on_at_its_page(spark, monkeypatch):
    path = scratch_path(spark, "t-stopped")
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(4)
    assert landing.land_fixed_pages(df, path, ("k",), 100, 2, most_jobs=2) == 4
    first = {r["id"]: r["page"] for r in landing.read_fixed_pages(spark, path, df.schema).collect()}
    before = _page_files(path)
    # A failure after the pages of a lot and before its manifest: the lot lands again.
    real, calls = landing.read_manifest, []

    def failing(*a):
        calls.append(a)
        raise OSError("gone")

    monkeypatch.setattr(landing, "read_manifest", failing)
    with pytest.raises(OSError):
        landing.land_fixed_pages(df, path, ("k",), 100, 2)
    monkeypatch.setattr(landing, "read_manifest", real)
    # Another order of the input must not renumber what has landed.
    assert landing.land_fixed_pages(df.repartition(7), path, ("k",), 100, 2) == 10
    back = {r["id"]: r["page"] for r in landing.read_fixed_pages(spark, path, df.schema).collect()}
    assert len(back) == 1000 and all(back[i] == p for i, p in first.items())
    assert set(before) <= set(_page_files(path))
    assert landing.land_fixed_pages(df, path, ("k",), 100, 2) == 10


def test_the_number_of_lots_is_bounded(spark, monkeypatch):
    """More pages make larger lots, not more jobs; each is still a lot of its own."""
    monkeypatch.setattr(landing, "MOST_LOTS", 3)
    path = scratch_path(spark, "t-lots")
    df = spark.range(95).select((F.col("id") % 7).alias("k"), "id").repartition(4)
    landed = [landing.land_fixed_pages(df, path, ("k",), 10, 1, most_jobs=1) for _ in range(4)]
    assert landed == [4, 8, 10, 10]
    manifest = sorted(tuple(r) for r in landing.read_manifest(spark, path).collect())
    assert manifest == [(p, p * 10 + 1, min(10, 95 - p * 10)) for p in range(10)]
    back = landing.read_fixed_pages(spark, path, df.schema).collect()
    assert sorted(r["id"] for r in back) == list(range(95))


def test_ranks_equal_the_window(spark):
    rng = random.Random(4)
    values = [None, float("nan"), -0.0, 0.0, *map(float, range(40))]
    data = [(2000 if rng.random() < 0.8 else 2001, rng.choice([1, 1, 1, None]), rng.choice(values), i) for i in range(2500)]
    data += [(1999, 5, 1.0, -1), (1998, 5, None, -2)]
    df = spark.createDataFrame(data, "year int, month int, v double, i long").repartition(6)
    for down, last, side in (
        (True, True, F.desc_nulls_last), (False, False, F.asc_nulls_first), (True, False, F.desc_nulls_first), (False, True, F.asc_nulls_last),
    ):
        w = Window.partitionBy("year", "month").orderBy(side("v"))
        want = {r["i"]: (r["d"], r["p"]) for r in df.withColumns({"d": F.dense_rank().over(w), "p": F.percent_rank().over(w)}).collect()}
        got = group_ranks(df, ["year", "month"], "v", descending=down, nulls_last=last).collect()
        assert len(got) == len(data)
        assert {r["i"]: (r["dense_rank"], r["percent_rank"]) for r in got} == want


def test_no_task_of_the_ranks_holds_a_month(spark):
    """The windows are by (group, partition) or over one row per partition, never by the group's rows."""
    import contextlib
    import io

    df = spark.range(20_000).select(F.lit(1).alias("g"), "id")
    out = group_ranks(df, ["g"], "id")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain("formatted")
    windows = [x for x in text.getvalue().split("\n\n") if ") Window" in x]
    assert windows
    for x in windows:
        assert "_part" in x or "_n#" in x or "_m#" in x, x


LINES = [
    "2001-11-01T05:00:00.000,subway,1,A,X,m,f,10.5,1.0,,,",
    "2001-11-02T05:00:00.000,subway,1,\"A, B\",X,m,f,NaN,,40.5,,",
    "2001-11-03T05:00:00.000,subway,1,A,X,m,f,n/a,1.0,,,",
    "soon,subway,1,A,X,m,f,3,one,,,",
    "2001-11-04T05:00:00.000,subway,1",
    "2001-11-05T05:00:00.000,subway,1,A,X,m,f,1,1,1,1,g,more",
    "2001-10-31T05:00:00.000,subway,1,A,X,m,f,7,1.0,,,",
    ",,,,,,,,,,,",
    "2001-11-06T05:00:00.000,subway,1,A,X,m,f,  8 ,1.0,,,",
]
REASONS = {
    "number: ridership": 1, "time: transit_timestamp; number: transfers": 1, "number of fields": 2,
}


def _delivery(spark, header):
    path = scratch_path(spark, "t-csv")
    lines = ([",".join(f.name for f in schemas.RIDERSHIP.fields)] if header else []) + LINES
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("header", [True, False])
def test_records_are_good_or_rejected_with_a_reason(spark, header):
    rows = records.read_checked_csv(spark, _delivery(spark, header), schemas.RIDERSHIP, header)
    bad = records.rejected_rows(rows).collect()
    reasons = [r["reject_reason"] for r in bad]
    assert {x: reasons.count(x) for x in reasons} == REASONS
    assert {r["record"] for r in bad} == {LINES[2], LINES[3], LINES[4], LINES[5]}
    assert all(r["source_file"].startswith("part-") for r in bad)
    good = records.good_rows(rows, schemas.RIDERSHIP)
    assert good.schema.simpleString() == schemas.RIDERSHIP.simpleString()
    assert good.count() == 5 and good.where("ridership = 8").count() == 1


def test_a_foreign_header_is_an_error(spark):
    path = scratch_path(spark, "t-header")
    spark.createDataFrame([("a,b,c,d,e,f,g,h,i,j,k,l",), (LINES[0],)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="(?i)header"):
        records.read_checked_csv(spark, path, schemas.RIDERSHIP).collect()


def test_month_and_quarantine_land_together(spark):
    root = scratch_path(spark, "t-land")
    for _ in range(2):  # a repeated landing replaces
        rows = records.read_checked_csv(spark, _delivery(spark, True), schemas.RIDERSHIP)
        path = records.land_checked_month(rows, dt.date(2001, 12, 3), root, "ridership", schemas.RIDERSHIP, "transit_timestamp")
    assert path.endswith("ridership_2001_11")
    good = records.read_good(spark, path, schemas.RIDERSHIP)
    assert sorted(r["transit_timestamp"].day for r in good.collect()) == [1, 2, 6]
    rejected = records.read_rejected(spark, path)
    assert rejected.count() == 4
    spec = quality.GateSpec(**{**quality.RIDERSHIP_GATE.__dict__, "max_rejected": 3})
    report = {(r["check"], r["column"]): r for r in quality.rejection_report(rejected, spec).collect()}
    assert report["rejected_rows", None]["value"] == 4 and not report["rejected_rows", None]["passed"]
    assert {c: r["value"] for (k, c), r in report.items() if k == "rejected_reason"} == REASONS
    with pytest.raises(quality.GateFailure, match="rejected_rows"):
        quality.enforce(quality.rejection_report(rejected, spec))
    empty = quality.rejection_report(rejected.limit(0), spec).collect()
    assert [(r["check"], r["value"], r["passed"]) for r in empty] == [("rejected_rows", 0, True)]


def test_absent_folder_or_file(spark):
    assert not lake.exists(spark, scratch_path(spark, "t-nothing"))
