"""Explicit schemas of every stored table (no inference anywhere)."""

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
# Source hours are local wall-clock times: a timestamp without a zone.
TS = T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw hourly entries: hour x station x payment x fare class.
RIDERSHIP = _struct(
    ("transit_timestamp", TS),
    ("transit_mode", S),
    ("station_complex_id", S),
    ("station_complex", S),
    ("borough", S),
    ("payment_method", S),
    ("fare_class_category", S),
    ("ridership", D),
    ("transfers", D),
    ("latitude", D),
    ("longitude", D),
    ("georeference", S),
)

# The raw table of the lake, partitioned by year and month.
RIDERSHIP_MONTHS = T.StructType([*RIDERSHIP.fields, *_struct(("year", I), ("month", I)).fields])

# Monthly line-level journey metrics (one row per month x line x period).
APT_MEASURES = (
    "num_passengers",
    "additional_platform_time",
    "additional_train_time",
    "total_apt",
    "total_att",
    "over_five_mins",
    "over_five_mins_perc",
    "customer_journey_time",
)
APT = _struct(
    ("month", TS),
    ("division", S),
    ("line", S),
    ("period", S),
    *[(m, D) for m in APT_MEASURES],
    ("year", I),
    ("month_num", I),
)

# Station reference: one row per stop; daytime_routes is space separated.
STATIONS = _struct(
    ("complex_id", S),
    ("stop_name", S),
    ("division", S),
    ("borough", S),
    ("daytime_routes", S),
)

ROUTE_LOOKUP = _struct(
    ("complex_id", S), ("route", S), ("division", S), ("borough_code", S)
)

STATION_NAMES = _struct(
    ("station_complex", S), ("station_complex_id", S), ("borough", S)
)

# Hourly station facts with calendar features and month totals.
HOURS = _struct(
    ("station_complex", S),
    ("station_complex_id", S),
    ("transit_timestamp", TS),
    ("borough", S),
    ("ridership", D),
    ("hour_of_day", I),
    ("day_of_week", I),
    ("is_weekend", I),
    ("time_window", S),
    ("monthly_ridership", D),
    ("monthly_rank", I),
    ("year", I),
    ("month", I),
)

# Hour facts alone.
HOUR_FACT = _struct(*[(f.name, f.dataType) for f in HOURS.fields[:5]])

# Hours that the hourly feed has closed, and the watermark of each of its batches.
CLOSED_HOURS = T.StructType([*HOUR_FACT.fields, T.StructField("batch", L, True)])
MARKS = _struct(("mark", L), ("batch", L))

# Hour facts with calendar features only (before month totals and ranks).
HOUR_FEATURES = _struct(*[(f.name, f.dataType) for f in HOURS.fields
                          if f.name not in ("monthly_ridership", "monthly_rank")])

# Station-month stress, delay, risk and trend columns.
CSI = _struct(
    ("station_complex", S),
    ("station_complex_id", S),
    ("borough", S),
    ("peak_hr_ridership", D),
    ("volume_component", D),
    ("hhi_monthly_concentration", D),
    ("csi", D),
    ("apt_minutes", D),
    ("cjtp", D),
    ("total_line_passengers", D),
    ("num_lines_serving", L),
    ("csi_pctl", D),
    ("apt_minutes_pctl", D),
    ("danger_zone", I),
    ("csi_6mo_rolling", D),
    ("apt_6mo_rolling", D),
    ("year", I),
    ("month", I),
)

# Station-month moments: peak volume, peak-row count and the HHI moments.
MOMENTS = _struct(
    ("station_complex", S),
    ("station_complex_id", S),
    ("borough", S),
    ("year", I),
    ("month", I),
    ("peak_hr_ridership", D),
    ("peak_rows", L),
    ("ridership_sum", D),
    ("ridership_sq_sum", D),
)

# Quantile sketches of a month's station peak volumes.
PEAK_SKETCHES = _struct(("n", L), ("sketch", T.BinaryType()), ("year", I), ("month", I))

BASELINE = _struct(("baseline_year", I), ("p90_peak_hr_ridership", D))

AUDIT = _struct(
    ("run_date", S),
    ("dataset", S),
    ("rows_ingested", L),
    ("source_file", S),
    ("status", S),
    # Records that could not be read; null where none were looked for.
    ("rows_rejected", L),
    ("run_id", S),
)

# One row per state that a run has reached.
LEDGER = _struct(("stage", S), ("marked_at", S), ("run_id", S), ("state", S))

MONTHS = _struct(("year", I), ("month", I))

# Records that the reader rejected, as they were found.
REJECTED = _struct(("source_file", S), ("reject_reason", S), ("record", S))
