"""Data-quality gates: row floor, nulls in critical columns, unknown names.

``quality_report`` is lazy and computes every check of a dataset in one scan
(one aggregate by station name, then a global one).
``enforce`` is the only action: it fetches the failed checks (a handful of
rows) and raises.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import clock_hour
from ..functions.numeric import is_missing


@dataclass(frozen=True)
class GateSpec:
    dataset: str
    critical_cols: tuple[str, ...]
    numeric_cols: tuple[str, ...]
    min_rows: int
    name_check: bool = False
    max_unknown: int = 10
    #: Records that a delivery may have which can't be read; None: any number.
    max_rejected: int | None = None


# The reference's gate configuration per dataset.
RIDERSHIP_GATE = GateSpec(
    dataset="ridership",
    critical_cols=("transit_timestamp", "station_complex", "station_complex_id", "ridership"),
    numeric_cols=("ridership", "transfers", "latitude", "longitude"),
    min_rows=200_000,
    name_check=True,
    max_unknown=10,
)
APT_GATE = GateSpec(
    dataset="apt",
    critical_cols=("month", "line", "division", "additional_platform_time", "num_passengers"),
    numeric_cols=(
        "additional_platform_time",
        "num_passengers",
        "customer_journey_time",
        "total_apt",
        "total_att",
        "over_five_mins",
        "over_five_mins_perc",
    ),
    min_rows=20,
    name_check=False,
)

REPORT_COLUMNS = ["dataset", "check", "column", "value", "threshold", "passed"]


class GateFailure(ValueError):
    pass


def unknown_names(df: DataFrame, known: DataFrame, col: str = "station_complex") -> DataFrame:
    """Distinct names in ``df`` that are not on the known list (set minus)."""
    names = known.select(F.col(col)).distinct()
    return df.select(col).distinct().join(names, col, "left_anti")


def known_names(df: DataFrame) -> DataFrame:
    """Distinct (name, id, borough) triples: the station name check table."""
    return df.select("station_complex", "station_complex_id", "borough").distinct()


def quality_report(df: DataFrame, spec: GateSpec, known: DataFrame | None = None) -> DataFrame:
    """One row per check: (dataset, check, column, value, threshold, passed).

    Null counts include NaN on floating columns. A critical column missing
    from the input is a failed check, not an error. With a name check, counts
    are first taken per station name (partial sums in each task), the names are
    looked up in the known list, and the few rows left are added up.
    """
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in spec.critical_cols:
        if c in dtypes:
            aggs.append(F.count_if(is_missing(c, dtypes[c])).alias(f"nulls__{c}"))
    named = spec.name_check and known is not None
    if named:
        names = known.select(F.col("station_complex").alias("known_name")).distinct()
        by_name = df.groupBy("station_complex").agg(*aggs)
        counts = [c for c in by_name.columns if c != "station_complex"]
        stats = by_name.join(names, F.col("station_complex") == F.col("known_name"), "left").agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
            F.count_if(F.col("known_name").isNull()).alias("unknown"),
        )
    else:
        stats = df.agg(*aggs)

    def row(check, column, value, threshold, passed):
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column"),
            value.cast("long").alias("value"),
            F.lit(threshold).cast("long").alias("threshold"),
            passed.alias("passed"),
        )

    n = F.col("row_count")
    checks = [row("row_count", None, n, spec.min_rows, n >= spec.min_rows)]
    for c in spec.critical_cols:
        if c in dtypes:
            v = F.col(f"nulls__{c}")
            checks.append(row("nulls", c, v, 0, v == 0))
        else:
            checks.append(row("missing_column", c, F.lit(None), None, F.lit(False)))
    if named:
        unknown = F.col("unknown")
        checks.append(
            row("unknown_names", "station_complex", unknown, spec.max_unknown, unknown <= spec.max_unknown)
        )
    return stats.select(F.explode(F.array(*checks)).alias("c")).select(
        F.lit(spec.dataset).alias("dataset"), "c.*"
    )


def rejection_report(rejected: DataFrame, spec: GateSpec) -> DataFrame:
    """Report rows of the records that could not be read: the total, then one per reason.

    The total is checked against ``max_rejected``; the reasons are for information.
    """
    limit = F.lit(spec.max_rejected).cast("long")
    columns = lambda check, reason, n, passed: [
        F.lit(spec.dataset).alias("dataset"), F.lit(check).alias("check"), reason.alias("column"),
        n.cast("long").alias("value"), limit.alias("threshold"), passed.alias("passed"),
    ]
    by_reason = rejected.groupBy("reject_reason").agg(F.count("*").alias("n"))
    total = rejected.agg(F.count("*").alias("n"))
    within = F.coalesce(F.col("n") <= limit, F.lit(True))
    return total.select(*columns("rejected_rows", F.lit(None).cast("string"), F.col("n"), within)).unionByName(
        by_reason.select(*columns("rejected_reason", F.col("reject_reason"), F.col("n"), F.lit(True)))
    )


def clock_report(df: DataFrame, spec: GateSpec, zone: str, col: str = "transit_timestamp") -> DataFrame:
    """Report rows of local hours that the zone's clocks skip or show twice.

    A row in a skipped hour has a wrong time and fails the check. Rows of a
    repeated hour are of two hours that the source doesn't tell apart; hour facts
    add them up, so they are counted, for information.
    """
    kind = clock_hour(F.col(col), zone)
    counts = df.agg(*[F.count_if(kind == k).alias(k) for k in ("skipped", "repeated")])
    row = lambda check, k, limit, ok: F.struct(
        F.lit(check).alias("check"), F.lit(col).alias("column"), F.col(k).alias("value"),
        F.lit(limit).cast("long").alias("threshold"), ok.alias("passed"),
    )
    checks = [row("skipped_hours", "skipped", 0, F.col("skipped") == 0), row("repeated_hours", "repeated", None, F.lit(True))]
    return counts.select(F.explode(F.array(*checks)).alias("c")).select(F.lit(spec.dataset).alias("dataset"), "c.*")


def changeover_hours(df: DataFrame, zone: str, col: str = "transit_timestamp") -> DataFrame:
    """All hours of the days on which the zone's clocks change: (hour, clock, records, ridership).

    The rows are added up by hour first; days are looked up for these few rows.
    """
    hour = F.date_trunc("hour", F.col(col)).cast("timestamp_ntz")
    # The lookup goes by an aggregate: a filter on the grouping key would be
    # pushed below it, to every row.
    hours = df.groupBy(hour.alias("hour")).agg(
        F.count("*").alias("records"), F.sum("ridership").alias("ridership"), F.max(hour).alias("_at")
    )
    day = F.to_date("_at")
    all_day = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: day.cast("timestamp") + F.make_interval(hours=h))
    changes = F.exists(all_day, lambda t: clock_hour(t, zone) != "plain")
    return hours.where(changes).select("hour", clock_hour(F.col("hour"), zone).alias("clock"), "records", "ridership")


def enforce(report: DataFrame) -> None:
    """Raise ``GateFailure`` listing the failed checks, if any."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        detail = "; ".join(
            f"{r['dataset']}:{r['check']}[{r['column']}]={r['value']} (limit {r['threshold']})"
            for r in failed
        )
        raise GateFailure(detail)


def gate_status(report: DataFrame) -> DataFrame:
    """One row per dataset: rows seen and 'success' / 'failed'."""
    return report.groupBy("dataset").agg(
        F.max(F.when(F.col("check") == "row_count", F.col("value"))).alias("rows_ingested"),
        F.when(F.bool_and("passed"), F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.max(F.when(F.col("check") == "rejected_rows", F.col("value"))).alias("rows_rejected"),
    )


def audit_records(report: DataFrame, source_file: str, run_time: str | None = None) -> DataFrame:
    """Audit rows for a gate report: run time (UTC, ISO text; default: now) and status."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return gate_status(report).select(
        (F.lit(run_time) if run_time else now).alias("run_date"),
        "dataset",
        "rows_ingested",
        F.lit(source_file).alias("source_file"),
        "status",
        "rows_rejected",
    )


def names_with_several_ids(df: DataFrame) -> DataFrame:
    """Station names that map to more than one station id, with the id count.

    Month totals and HHI are keyed on the name while peak volume and delay
    are keyed on the id; such names mix several complexes in their HHI. The
    report is informational (duplicate names exist in real systems), not a
    gate. Two aggregates with partial aggregation, no collected id lists.
    """
    pairs = df.select("station_complex", "station_complex_id").distinct()
    return (
        pairs.groupBy("station_complex")
        .agg(F.count("station_complex_id").alias("id_count"))
        .filter(F.col("id_count") > 1)
    )
