"""DuckDB SQL for every registered query, written from the semantics.

The same fixture mapping as ``sources/fixtures.py`` appears as CTEs. The
reference form of each computation is used where it differs from ours (HHI
as a window of squared shares, exact discrete percentile), so a match also
checks that our rewrites are equivalent. Doubles are snapped with the same
``stable_round`` grid as the Spark side.
"""

from __future__ import annotations


def r6(expr: str) -> str:
    """SQL twin of ``stable_round(x, 6)``."""
    v = f"({expr})"
    return (
        f"CASE WHEN abs({v} * 1e6 + 0.5001) < 9007199254740992.0 "
        f"THEN floor({v} * 1e6 + 0.5001) / 1e6 ELSE CAST({v} AS DOUBLE) END"
    )


def key(col: str) -> str:
    """SQL twin of ``rank_key``."""
    return f"(CASE WHEN abs({col}) < 1e300 THEN {col} * 4097.0 - ({col} * 4097.0 - {col}) ELSE {col} END)"


RIDERSHIP = """
ridership AS (
  SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS transit_timestamp,
         CASE WHEN l_linenumber = 7 THEN 'tram' ELSE 'subway' END AS transit_mode,
         CAST(s_suppkey AS VARCHAR) AS station_complex_id,
         s_name AS station_complex,
         r_name AS borough,
         l_returnflag AS payment_method,
         l_linestatus AS fare_class_category,
         l_quantity AS ridership,
         CAST(l_linenumber AS DOUBLE) AS transfers,
         CAST(NULL AS DOUBLE) AS latitude,
         CAST(NULL AS DOUBLE) AS longitude,
         CAST(NULL AS VARCHAR) AS georeference
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

APT = """
apt AS (
  SELECT make_timestamp(CAST(year(l_shipdate) AS BIGINT), CAST(month(l_shipdate) AS BIGINT), 1, 0, 0, 0) AS month,
         CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) <= 8 THEN 'A DIVISION' ELSE 'B DIVISION' END AS division,
         p_brand AS line,
         CASE WHEN l_orderkey % 24 BETWEEN 7 AND 9 OR l_orderkey % 24 BETWEEN 16 AND 19
              THEN 'peak' ELSE 'offpeak' END AS period,
         SUM(l_quantity) AS num_passengers,
         AVG(l_discount) * 20 AS additional_platform_time,
         AVG(1 - l_tax) AS customer_journey_time,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS INTEGER) AS month_num
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY ALL
)"""

STATIONS = """
stations AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS complex_id,
         s_name || ' stop ' || CAST(stop_no AS VARCHAR) AS stop_name,
         'D' || CAST(s_suppkey % 2 AS VARCHAR) AS division,
         CAST(n_regionkey AS VARCHAR) AS borough,
         CASE WHEN s_suppkey % 10 = 0 THEN 'JZ '
              ELSE 'Brand#' || CAST(s_suppkey % 25 + 1 AS VARCHAR)
                   || ' Brand#' || CAST((7 * s_suppkey) % 25 + 1 AS VARCHAR)
                   || '  Brand#' || CAST((3 * s_suppkey) % 25 + 1 AS VARCHAR) END AS daytime_routes
  FROM supplier JOIN nation ON s_nationkey = n_nationkey,
       (VALUES (1), (2)) AS copies(stop_no)
)"""

HOURS = """
hourly AS (
  SELECT station_complex, station_complex_id, transit_timestamp, borough,
         SUM(ridership) AS ridership
  FROM ridership WHERE transit_mode = 'subway'
  GROUP BY station_complex, station_complex_id, transit_timestamp, borough
),
feat AS (
  SELECT *,
         CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(transit_timestamp) + 1 AS INTEGER) AS day_of_week,
         CAST(dayofweek(transit_timestamp) IN (0, 6) AS INTEGER) AS is_weekend,
         CAST(month(transit_timestamp) AS INTEGER) AS month,
         CAST(year(transit_timestamp) AS INTEGER) AS year,
         CASE WHEN hour(transit_timestamp) BETWEEN 0 AND 6 THEN 'early_morning'
              WHEN hour(transit_timestamp) BETWEEN 7 AND 9 THEN 'morning_peak'
              WHEN hour(transit_timestamp) BETWEEN 10 AND 15 THEN 'midday'
              WHEN hour(transit_timestamp) BETWEEN 16 AND 19 THEN 'evening_peak'
              ELSE 'late_night' END AS time_window
  FROM hourly
),
hours AS (
  SELECT *,
         SUM(ridership) OVER (PARTITION BY station_complex, year, month) AS monthly_ridership
  FROM feat
),
hours_ranked AS (
  SELECT h.*, CAST(r.monthly_rank AS INTEGER) AS monthly_rank
  FROM hours h JOIN (
    SELECT station_complex, year, month,
           dense_rank() OVER (PARTITION BY year, month ORDER BY monthly_ridership DESC NULLS LAST) AS monthly_rank
    FROM (SELECT DISTINCT station_complex, year, month, monthly_ridership FROM hours)
  ) r USING (station_complex, year, month)
)"""

CSI = """
peak AS (
  SELECT station_complex, station_complex_id, borough, year, month,
         SUM(ridership) AS peak_hr_ridership
  FROM feat WHERE time_window IN ('morning_peak', 'evening_peak')
  GROUP BY station_complex, station_complex_id, borough, year, month
),
baseline AS (
  SELECT CAST(2000 AS INTEGER) AS baseline_year,
         CAST(quantile_disc(peak_hr_ridership, 0.9) AS DOUBLE) AS p90_peak_hr_ridership
  FROM peak WHERE year = 2000
),
hhi AS (
  SELECT station_complex, year, month,
         SUM(power(ridership / monthly_ridership, 2)) AS hhi_monthly_concentration
  FROM hours GROUP BY station_complex, year, month
),
stress AS (
  SELECT station_complex, year, month, station_complex_id, borough, peak_hr_ridership,
         peak_hr_ridership / (SELECT p90_peak_hr_ridership FROM baseline) AS volume_component,
         hhi_monthly_concentration,
         peak_hr_ridership / (SELECT p90_peak_hr_ridership FROM baseline) * hhi_monthly_concentration AS csi
  FROM peak JOIN hhi USING (station_complex, year, month)
),
bridge AS (
  SELECT DISTINCT complex_id, route, division, borough_code FROM (
    SELECT complex_id, division, borough AS borough_code, trim(unnest(string_split(daytime_routes, ' '))) AS route
    FROM stations
  ) WHERE route <> ''
),
delay AS (
  SELECT complex_id, year, month,
         SUM(apt_minutes * line_passengers) / SUM(line_passengers) AS apt_minutes,
         SUM(cjtp * line_passengers) / SUM(line_passengers) AS cjtp,
         SUM(line_passengers) AS total_line_passengers,
         COUNT(line) AS num_lines_serving
  FROM (SELECT DISTINCT complex_id, route FROM bridge) b
  JOIN (SELECT line, year, month_num AS month, additional_platform_time AS apt_minutes,
               num_passengers AS line_passengers, customer_journey_time AS cjtp
        FROM apt WHERE period = 'peak') a ON b.route = a.line
  GROUP BY complex_id, year, month
),
merged AS (
  SELECT s.*, d.apt_minutes, d.cjtp, d.total_line_passengers, d.num_lines_serving
  FROM stress s LEFT JOIN delay d
    ON s.station_complex_id = d.complex_id AND s.year = d.year AND s.month = d.month
),
flagged AS (
  SELECT *, CAST(csi_pctl >= 0.9 AND apt_minutes_pctl >= 0.9 AS INTEGER) AS danger_zone
  FROM (
    SELECT *,
      percent_rank() OVER (PARTITION BY year, month ORDER BY {csi_key} ASC NULLS FIRST) AS csi_pctl,
      percent_rank() OVER (PARTITION BY year, month ORDER BY {apt_key} ASC NULLS FIRST) AS apt_minutes_pctl
    FROM merged
  )
),
csi AS (
  SELECT *,
    AVG(csi) OVER (PARTITION BY station_complex_id ORDER BY year, month
                   ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS csi_6mo_rolling,
    AVG(apt_minutes) OVER (PARTITION BY station_complex_id ORDER BY year, month
                   ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS apt_6mo_rolling
  FROM flagged
)""".format(csi_key=key("csi"), apt_key=key("apt_minutes"))


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


BASE = (RIDERSHIP, HOURS)
FULL = (RIDERSHIP, APT, STATIONS, HOURS, CSI)


def q(body: str, ctes=FULL) -> str:
    return with_ctes(*ctes, body=body)


QUERIES: dict[str, str] = {
    "hourly_fact": q(
        f"SELECT station_complex, station_complex_id, transit_timestamp, borough, {r6('ridership')} AS ridership FROM hourly",
        BASE,
    ),
    "time_features": q(
        f"""SELECT station_complex, station_complex_id, transit_timestamp, borough, {r6('ridership')} AS ridership,
                  hour_of_day, day_of_week, is_weekend, month, year, time_window FROM feat""",
        BASE,
    ),
    "monthly_total_rank": q(
        f"""SELECT station_complex, station_complex_id, transit_timestamp, borough, {r6('ridership')} AS ridership,
                  hour_of_day, day_of_week, is_weekend, month, year, time_window,
                  {r6('monthly_ridership')} AS monthly_ridership, monthly_rank FROM hours_ranked""",
        BASE,
    ),
    "peak_volume": q(
        f"""SELECT station_complex, station_complex_id, borough, year, month,
                  {r6('peak_hr_ridership')} AS peak_hr_ridership FROM peak"""
    ),
    "baseline_p90": q(
        f"SELECT baseline_year, {r6('p90_peak_hr_ridership')} AS p90_peak_hr_ridership FROM baseline"
    ),
    "concentration_hhi": q(
        f"SELECT station_complex, year, month, {r6('hhi_monthly_concentration')} AS hhi_monthly_concentration FROM hhi"
    ),
    "stress_index": q(
        f"""SELECT station_complex, year, month, station_complex_id, borough,
                  {r6('peak_hr_ridership')} AS peak_hr_ridership,
                  {r6('volume_component')} AS volume_component,
                  {r6('hhi_monthly_concentration')} AS hhi_monthly_concentration,
                  {r6('csi')} AS csi FROM stress"""
    ),
}


CSI_COLS_BASE = [
    "station_complex", "year", "month", "station_complex_id", "borough",
]
CSI_DOUBLES = [
    "peak_hr_ridership", "volume_component", "hhi_monthly_concentration", "csi",
    "apt_minutes", "cjtp", "total_line_passengers",
]


def _sel(cols, doubles) -> str:
    parts = [
        f"CAST({c} AS DOUBLE) AS {c}" if c == "num_lines_serving"
        else (c if c not in doubles else f"{r6(c)} AS {c}")
        for c in cols
    ]
    return ", ".join(parts)


FLAG_COLS = CSI_COLS_BASE + [
    "peak_hr_ridership", "volume_component", "hhi_monthly_concentration", "csi",
    "apt_minutes", "cjtp", "total_line_passengers", "num_lines_serving",
    "csi_pctl", "apt_minutes_pctl", "danger_zone",
]
ALL_DOUBLES = CSI_DOUBLES + ["csi_pctl", "apt_minutes_pctl", "csi_6mo_rolling", "apt_6mo_rolling",
                             "monthly_ridership"]

LATEST_MONTH = "latest AS (SELECT year, month FROM csi ORDER BY year DESC, month DESC LIMIT 1)"
STATED_MONTH = "latest AS (SELECT 2001 AS year, 10 AS month)"

LATEST = """
{latest},
lt AS (
  SELECT c.*, t.monthly_ridership
  FROM csi c JOIN latest l ON c.year = l.year AND c.month = l.month
  LEFT JOIN (SELECT DISTINCT station_complex, year, month, monthly_ridership FROM hours) t
    ON c.station_complex = t.station_complex AND c.year = t.year AND c.month = t.month
),
ftop AS (
  SELECT * FROM lt WHERE danger_zone = 1 AND monthly_ridership IS NOT NULL
  ORDER BY {km} DESC, station_complex LIMIT 10
),
top5 AS (
  SELECT station_complex, year, month, csi FROM (
    SELECT *, row_number() OVER (PARTITION BY station_complex
                                 ORDER BY {k} DESC, year, month) AS rn
    FROM csi WHERE csi IS NOT NULL AND NOT isnan(csi)
  ) WHERE rn = 1 ORDER BY {k} DESC, station_complex LIMIT 5
),
high_flagged AS (
  SELECT station_complex FROM (
    SELECT *, row_number() OVER (PARTITION BY station_complex
                                 ORDER BY {kr} DESC, year, month) AS rn
    FROM csi WHERE year = 2000 AND month >= 6 AND danger_zone = 1
      AND csi_6mo_rolling IS NOT NULL AND NOT isnan(csi_6mo_rolling)
  ) WHERE rn = 1 ORDER BY {kr} DESC, station_complex LIMIT 5
),
high_any AS (
  SELECT station_complex FROM (
    SELECT *, row_number() OVER (PARTITION BY station_complex
                                 ORDER BY {kr} DESC, year, month) AS rn
    FROM csi WHERE year = 2000 AND month >= 6
      AND csi_6mo_rolling IS NOT NULL AND NOT isnan(csi_6mo_rolling)
  ) WHERE rn = 1 ORDER BY {kr} DESC, station_complex LIMIT 5
),
heat AS (
  SELECT station_complex, day_of_week, hour_of_day, AVG(ridership) AS avg_ridership
  FROM feat WHERE station_complex IN (SELECT station_complex FROM top5)
    AND day_of_week IS NOT NULL AND hour_of_day IS NOT NULL
  GROUP BY station_complex, day_of_week, hour_of_day
)""".format(
    k=key("csi"), kr=key("csi_6mo_rolling"), km=key("monthly_ridership"), latest=LATEST_MONTH
)

REPORT = FULL + (LATEST,)


def _trend_long(station_sql: str) -> str:
    parts = []
    for m in ("peak_hr_ridership", "csi_6mo_rolling", "apt_6mo_rolling"):
        parts.append(
            f"""SELECT station_complex, station_complex_id, year, month, CAST(make_date(year, month, 1) AS TIMESTAMP) AS date,
                       '{m}' AS metric, {r6(m)} AS value
                FROM csi WHERE station_complex IN ({station_sql})
                  AND make_date(year, month, 1) >= DATE '2000-06-01'"""
        )
    return " UNION ALL ".join(parts)


def _fmt(col: str, digits: int) -> str:
    return f"format('{{:,.{digits}f}}', {r6(col)})"


QUERIES.update({
    "route_bridge": q("SELECT complex_id, route, division, borough_code FROM bridge"),
    "station_delay": q(
        f"""SELECT complex_id, year, month, {r6('apt_minutes')} AS apt_minutes, {r6('cjtp')} AS cjtp,
                  {r6('total_line_passengers')} AS total_line_passengers, CAST(num_lines_serving AS DOUBLE) AS num_lines_serving FROM delay"""
    ),
    "risk_flag": q(f"SELECT {_sel(FLAG_COLS, ALL_DOUBLES)} FROM flagged"),
    "risk_flag_threshold": q(
        f"""SELECT {_sel(FLAG_COLS[:13], ALL_DOUBLES)},
                  CAST(CAST(csi > 0.65 AND apt_minutes > 1.0 AS INTEGER) AS DOUBLE) AS danger_zone FROM merged"""
    ),
    "rolling_trend": q(
        f"SELECT {_sel(FLAG_COLS + ['csi_6mo_rolling', 'apt_6mo_rolling'], ALL_DOUBLES)} FROM csi"
    ),
    "borough_totals": q(
        f"""SELECT year, borough, {r6('SUM(ridership)')} AS total_ridership FROM feat
            WHERE year IN (2000, 2001) AND borough IS NOT NULL GROUP BY year, borough""",
        BASE,
    ),
    "flagged_by_csi": q(
        f"""SELECT station_complex, year, month, {r6('volume_component')} AS volume_component,
                  {r6('hhi_monthly_concentration')} AS hhi_monthly_concentration,
                  {r6('csi')} AS csi, {r6('apt_minutes')} AS apt_minutes
            FROM csi WHERE danger_zone = 1
            ORDER BY {key('csi')} DESC NULLS LAST, station_complex, year, month LIMIT 10"""
    ),
    "flagged_by_apt": q(
        f"""SELECT station_complex, year, month, {r6('csi')} AS csi, {r6('apt_minutes')} AS apt_minutes
            FROM csi WHERE danger_zone = 1
            ORDER BY {key('apt_minutes')} DESC NULLS LAST, station_complex, year, month LIMIT 10"""
    ),
    "top_station_months": q(
        f"SELECT station_complex, year, month, {r6('csi')} AS csi FROM top5", REPORT
    ),
    "heatmap_long": q(
        f"SELECT station_complex, day_of_week, hour_of_day, {r6('avg_ridership')} AS avg_ridership FROM heat",
        REPORT,
    ),
    "heatmap_pivot": q(
        "SELECT station_complex, day_of_week, "
        + ", ".join(
            f"{r6(f'AVG(ridership) FILTER (WHERE hour_of_day = {h})')} AS h{h:02d}" for h in range(24)
        )
        + """ FROM feat WHERE station_complex IN (SELECT station_complex FROM top5)
              AND day_of_week IS NOT NULL AND hour_of_day IS NOT NULL
              GROUP BY station_complex, day_of_week""",
        REPORT,
    ),
    "heatmap_range": q(
        f"SELECT {r6('MIN(avg_ridership)')} AS vmin, {r6('MAX(avg_ridership)')} AS vmax FROM heat", REPORT
    ),
    "latest_month": q(
        "SELECT year, month, strftime(make_date(year, month, 1), '%B') AS month_name FROM latest", REPORT
    ),
    "latest_month_table": q(
        f"SELECT {_sel(FLAG_COLS + ['csi_6mo_rolling', 'apt_6mo_rolling', 'monthly_ridership'], ALL_DOUBLES)} FROM lt",
        REPORT,
    ),
    "top5_per_borough": q(
        f"""SELECT CAST(list_position(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE'], borough) AS INTEGER) AS borough_order,
                  CAST(rn AS INTEGER) AS rank_in_borough, station_complex, borough,
                  {r6('monthly_ridership')} AS monthly_ridership, {r6('csi')} AS csi,
                  {r6('apt_minutes')} AS apt_minutes, {r6('csi_pctl')} AS csi_pctl,
                  {r6('apt_minutes_pctl')} AS apt_minutes_pctl,
                  {_fmt('monthly_ridership', 0)} AS monthly_ridership_fmt,
                  {_fmt('csi', 3)} AS csi_fmt,
                  {_fmt('apt_minutes', 1)} AS apt_minutes_fmt,
                  {_fmt('csi_pctl', 2)} AS csi_pctl_fmt,
                  {_fmt('apt_minutes_pctl', 2)} AS apt_minutes_pctl_fmt
            FROM (
              SELECT *, row_number() OVER (PARTITION BY borough
                                           ORDER BY {key('monthly_ridership')} DESC, station_complex) AS rn
              FROM lt WHERE borough IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')
                AND monthly_ridership IS NOT NULL AND NOT isnan(monthly_ridership)
            ) WHERE rn <= 5""",
        REPORT,
    ),
    "flagged_latest_top10": q(
        f"""SELECT station_complex, borough, year, month, {r6('monthly_ridership')} AS monthly_ridership,
                  {r6('csi')} AS csi, {r6('apt_minutes')} AS apt_minutes,
                  {r6('csi_pctl')} AS csi_pctl, {r6('apt_minutes_pctl')} AS apt_minutes_pctl FROM ftop""",
        REPORT,
    ),
    "scatter_points": q(
        f"""SELECT station_complex, borough, {r6('volume_component')} AS volume_component,
                  {r6('hhi_monthly_concentration')} AS hhi_monthly_concentration,
                  {r6('peak_hr_ridership')} AS peak_hr_ridership, {r6('csi')} AS csi,
                  {r6('apt_minutes')} AS apt_minutes, {r6('csi_pctl')} AS csi_pctl,
                  {r6('apt_minutes_pctl')} AS apt_minutes_pctl, danger_zone,
                  CAST(danger_zone AS VARCHAR) AS danger_zone_str
            FROM lt WHERE apt_minutes IS NOT NULL AND NOT isnan(apt_minutes)""",
        REPORT,
    ),
    "trend_series_all": q(
        _trend_long(
            "SELECT station_complex FROM high_flagged UNION SELECT station_complex FROM ftop"
        ),
        REPORT,
    ),
    "trend_series_flagged": q(_trend_long("SELECT station_complex FROM ftop"), REPORT),
    "trend_high_unflagged": q(
        f"""SELECT station_complex, station_complex_id, year, month, CAST(make_date(year, month, 1) AS TIMESTAMP) AS date,
                  {r6('csi_6mo_rolling')} AS csi_6mo_rolling
            FROM csi WHERE station_complex IN (SELECT station_complex FROM high_any)
              AND make_date(year, month, 1) >= DATE '2000-06-01'""",
        REPORT,
    ),
    "preview": q(
        f"""SELECT station_complex, station_complex_id, transit_timestamp, borough, {r6('ridership')} AS ridership,
                  hour_of_day, day_of_week, is_weekend, month, year, time_window,
                  {r6('monthly_ridership')} AS monthly_ridership, monthly_rank
            FROM hours_ranked
            ORDER BY transit_timestamp, station_complex, station_complex_id, borough LIMIT 5""",
        BASE,
    ),
    "variation_cv": q(
        f"""SELECT station_complex, year, month,
                  {r6('stddev_samp(ridership) / AVG(ridership)')} AS ridership_cv
            FROM feat GROUP BY station_complex, year, month""",
        BASE,
    ),
})


RAW_COLS = (
    "transit_timestamp, transit_mode, station_complex_id, station_complex, borough, payment_method, "
    f"fare_class_category, {r6('ridership')} AS ridership, {r6('transfers')} AS transfers, "
    f"{r6('latitude')} AS latitude, {r6('longitude')} AS longitude, georeference"
)
KNOWN = "known AS (SELECT s_name AS station_complex FROM supplier WHERE s_acctbal >= 0)"
AS_OF = "DATE '2001-12-15'"
PREV_START = f"(date_trunc('month', {AS_OF}) - INTERVAL 1 MONTH)"
PREV_END = f"date_trunc('month', {AS_OF})"

_QR = """
q AS (SELECT * REPLACE (nullif(ridership, 1) AS ridership) FROM ridership),
stats AS (
  SELECT count(*) AS n,
         count_if(transit_timestamp IS NULL) AS n_ts,
         count_if(station_complex IS NULL) AS n_name,
         count_if(station_complex_id IS NULL) AS n_id,
         count_if(ridership IS NULL OR isnan(ridership)) AS n_r
  FROM q
),
unk AS (
  SELECT count(*) AS u FROM (SELECT DISTINCT station_complex FROM q) d
  WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.station_complex = d.station_complex)
)"""


def _check(check: str, column: str | None, value: str, threshold: str, passed: str) -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT 'ridership' AS dataset, '{check}' AS \"check\", {col} AS \"column\", "
        f"CAST({value} AS BIGINT) AS value, CAST({threshold} AS BIGINT) AS threshold, "
        f"{passed} AS passed FROM stats, unk"
    )


QUERIES.update({
    "year_slice": q(
        f"""SELECT {RAW_COLS} FROM ridership
            WHERE transit_timestamp >= TIMESTAMP '2000-01-01' AND transit_timestamp < TIMESTAMP '2001-01-01'""",
        (RIDERSHIP,),
    ),
    "previous_month_slice": q(
        f"""SELECT {RAW_COLS}, 'ridership_' || strftime({PREV_START}, '%Y_%m') AS landing_name
            FROM ridership
            WHERE transit_timestamp >= {PREV_START} AND transit_timestamp < {PREV_END}""",
        (RIDERSHIP,),
    ),
    "coerce_numeric": """
        SELECT o_orderkey,
               floor(TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END
                              AS DOUBLE) * 1e6 + 0.5001) / 1e6 AS o_totalprice
        FROM orders""",
    "quality_report": q(
        " UNION ALL ".join([
            _check("row_count", None, "n", "200000", "n >= 200000"),
            _check("nulls", "transit_timestamp", "n_ts", "0", "n_ts = 0"),
            _check("nulls", "station_complex", "n_name", "0", "n_name = 0"),
            _check("nulls", "station_complex_id", "n_id", "0", "n_id = 0"),
            _check("nulls", "ridership", "n_r", "0", "n_r = 0"),
            _check("unknown_names", "station_complex", "u", "10", "u <= 10"),
        ]),
        (RIDERSHIP, KNOWN, _QR),
    ),
    "unknown_names": q(
        """SELECT DISTINCT station_complex FROM ridership r
           WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.station_complex = r.station_complex)""",
        (RIDERSHIP, KNOWN),
    ),
    "known_names": q(
        """SELECT DISTINCT station_complex, station_complex_id, borough FROM ridership
           WHERE transit_timestamp >= TIMESTAMP '2000-01-01' AND transit_timestamp < TIMESTAMP '2001-01-01'""",
        (RIDERSHIP,),
    ),
    "apt_upsert": q(
        f"""SELECT month, division, line, period, {r6('num_passengers')} AS num_passengers,
                  {r6('additional_platform_time')} AS additional_platform_time,
                  CAST(NULL AS DOUBLE) AS additional_train_time, CAST(NULL AS DOUBLE) AS total_apt,
                  CAST(NULL AS DOUBLE) AS total_att, CAST(NULL AS DOUBLE) AS over_five_mins,
                  CAST(NULL AS DOUBLE) AS over_five_mins_perc,
                  {r6('customer_journey_time')} AS customer_journey_time, year, month_num FROM apt""",
        (APT,),
    ),
})
QUERIES["lake_round_trip"] = QUERIES["monthly_total_rank"]
QUERIES["incremental_equals_full"] = QUERIES["rolling_trend"]
QUERIES["page_union"] = QUERIES["year_slice"]
QUERIES["csv_route_bridge"] = QUERIES["route_bridge"]
QUERIES["baseline_round_trip"] = QUERIES["baseline_p90"]
QUERIES["monthly_landing"] = q(
    f"""SELECT {RAW_COLS} FROM ridership
        WHERE transit_timestamp >= {PREV_START} AND transit_timestamp < {PREV_END}""",
    (RIDERSHIP,),
)
QUERIES["monthly_feed"] = QUERIES["rolling_trend"]
QUERIES["names_with_several_ids"] = q(
    """SELECT station_complex, CAST(count(station_complex_id) AS BIGINT) AS id_count
       FROM (SELECT DISTINCT CASE WHEN CAST(station_complex_id AS BIGINT) % 3 = 0
                             THEN 'Shared ' || CAST(CAST(station_complex_id AS BIGINT) % 2 AS VARCHAR)
                             ELSE station_complex END AS station_complex, station_complex_id FROM ridership)
       GROUP BY station_complex HAVING count(station_complex_id) > 1""",
    (RIDERSHIP,),
)
QUERIES["text_timestamps"] = QUERIES["hourly_fact"]

# Reports of a stated month instead of the latest.
for _stated, _latest in (
    ("month_table", "latest_month_table"),
    ("top5_per_borough_month", "top5_per_borough"),
    ("flagged_month_top10", "flagged_latest_top10"),
    ("scatter_points_month", "scatter_points"),
    ("trend_series_month", "trend_series_all"),
    ("trend_series_flagged_month", "trend_series_flagged"),
):
    QUERIES[_stated] = QUERIES[_latest].replace(LATEST_MONTH, STATED_MONTH)
_FLAGGED_HEAT = """
fheat AS (
  SELECT station_complex, day_of_week, hour_of_day, AVG(ridership) AS avg_ridership
  FROM feat WHERE station_complex IN (SELECT station_complex FROM ftop)
    AND day_of_week IS NOT NULL AND hour_of_day IS NOT NULL
  GROUP BY station_complex, day_of_week, hour_of_day
)"""
_STATED = FULL + (LATEST.replace(LATEST_MONTH, STATED_MONTH), _FLAGGED_HEAT)
QUERIES["heatmap_flagged"] = q(
    f"SELECT station_complex, day_of_week, hour_of_day, {r6('avg_ridership')} AS avg_ridership FROM fheat", _STATED
)
QUERIES["heatmap_flagged_range"] = q(
    f"SELECT {r6('MIN(avg_ridership)')} AS vmin, {r6('MAX(avg_ridership)')} AS vmax FROM fheat", _STATED
)

QUERIES["monthly_landing_apt"] = QUERIES["apt_upsert"] + (
    f" WHERE month >= {PREV_START} AND month < {PREV_END}"
)
_APT_STATS = """
stats AS (
  SELECT count(*) AS n, count_if(month IS NULL) AS n_month, count_if(line IS NULL) AS n_line,
         count_if(division IS NULL) AS n_division,
         count_if(additional_platform_time IS NULL OR isnan(additional_platform_time)) AS n_time,
         count_if(num_passengers IS NULL OR isnan(num_passengers)) AS n_riders
  FROM apt
), unk AS (SELECT 0 AS u)"""
QUERIES["quality_report_apt"] = q(
    " UNION ALL ".join([
        _check("row_count", None, "n", "20", "n >= 20"),
        _check("nulls", "month", "n_month", "0", "n_month = 0"),
        _check("nulls", "line", "n_line", "0", "n_line = 0"),
        _check("nulls", "division", "n_division", "0", "n_division = 0"),
        _check("nulls", "additional_platform_time", "n_time", "0", "n_time = 0"),
        _check("nulls", "num_passengers", "n_riders", "0", "n_riders = 0"),
    ]).replace("'ridership' AS dataset", "'apt' AS dataset"),
    (APT, _APT_STATS),
)
QUERIES["audit_rows"] = q(
    """SELECT '2001-12-15T06:00:00.000000Z' AS run_date, dataset, CAST(n AS BIGINT) AS rows_ingested,
              'ridership_2001_11' AS source_file, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status
       FROM st, range(2)""",
    (
        RIDERSHIP, APT, KNOWN,
        f"m AS (SELECT * FROM ridership WHERE transit_timestamp >= {PREV_START} AND transit_timestamp < {PREV_END})",
        f"a AS (SELECT * FROM apt WHERE month >= {PREV_START} AND month < {PREV_END})",
        """st AS (
          SELECT 'ridership' AS dataset, count(*) AS n,
                 count(*) >= 1 AND count_if(transit_timestamp IS NULL OR station_complex IS NULL
                   OR station_complex_id IS NULL OR ridership IS NULL OR isnan(ridership)) = 0
                 AND (SELECT count(*) FROM (SELECT DISTINCT station_complex FROM m) d WHERE NOT EXISTS
                      (SELECT 1 FROM known k WHERE k.station_complex = d.station_complex)) <= 10 AS ok
          FROM m
          UNION ALL
          SELECT 'apt', count(*), count(*) >= 1 AND count_if(month IS NULL OR line IS NULL OR division IS NULL
                   OR additional_platform_time IS NULL OR isnan(additional_platform_time)
                   OR num_passengers IS NULL OR isnan(num_passengers)) = 0
          FROM a)""",
    ),
)
_SEPTEMBER = "transit_timestamp >= TIMESTAMP '2001-09-01' AND transit_timestamp < TIMESTAMP '2001-10-01'"
QUERIES["correction_equals_full"] = QUERIES["rolling_trend"].replace(
    RIDERSHIP,
    RIDERSHIP.replace("ridership AS (", "recorded AS (", 1)
    + f""",
ridership AS (
  SELECT * REPLACE (CASE WHEN {_SEPTEMBER} THEN ridership * 2 ELSE ridership END AS ridership) FROM recorded
  WHERE NOT ({_SEPTEMBER} AND CAST(station_complex_id AS BIGINT) % 5 = 0)
)""",
)

QUERIES["landed_pages"] = q(
    f"""SELECT CAST((rn - 1) // 5000 AS BIGINT) AS page, CAST(min(rn) AS BIGINT) AS first_row,
               CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS rows_read,
               min(transit_timestamp) AS first_time, max(transit_timestamp) AS last_time,
               {r6('SUM(ridership)')} AS ridership
        FROM (SELECT *, row_number() OVER (ORDER BY transit_timestamp, station_complex_id, payment_method,
                fare_class_category, transfers, ridership) AS rn FROM ridership)
        GROUP BY 1""",
    (RIDERSHIP,),
)
QUERIES["baseline_from_sketches"] = q(
    f"""SELECT year AS baseline_year, CAST(count(*) AS BIGINT) AS n,
               {r6("CAST(quantile_disc(peak_hr_ridership, 0.9) AS DOUBLE)")} AS p90_peak_hr_ridership, TRUE AS within_error
        FROM peak WHERE year BETWEEN 1995 AND 2001 GROUP BY year""",
)
QUERIES["hour_ranks"] = q(
    f"""SELECT station_complex, station_complex_id, transit_timestamp, borough, {r6('ridership')} AS ridership,
               CAST(dense_rank() OVER (PARTITION BY year, month ORDER BY ridership DESC NULLS LAST) AS INTEGER) AS hour_rank,
               {r6('percent_rank() OVER (PARTITION BY year, month ORDER BY ridership NULLS FIRST)')} AS hour_pctl
        FROM feat""",
    (RIDERSHIP, HOURS),
)
_SPOILED = """
spoiled AS (
  SELECT *, CASE WHEN transfers = 1 AND ridership = 13 THEN 'number: ridership'
                 WHEN transfers = 2 AND ridership = 17 THEN 'time: transit_timestamp'
                 WHEN transfers = 3 AND ridership = 19 THEN 'number of fields'
                 WHEN transfers = 4 AND ridership = 23 THEN 'number: ridership; number: latitude' END AS reject_reason
  FROM ridership)"""
QUERIES["rejected_records"] = q(
    f"""SELECT reject_reason, CAST(count(*) AS BIGINT) AS records,
               {r6('SUM(CASE WHEN reject_reason IS NULL THEN ridership END)')} AS ridership,
               CAST(count(reject_reason) AS BIGINT) AS kept_texts
        FROM spoiled GROUP BY 1""",
    (RIDERSHIP, _SPOILED),
)
QUERIES["checked_monthly_run"] = QUERIES["audit_rows"].replace(
    RIDERSHIP, RIDERSHIP + "," + _SPOILED
).replace(
    "m AS (SELECT * FROM ridership WHERE", "m AS (SELECT * FROM spoiled WHERE reject_reason IS NULL AND"
).replace(
    "FROM st, range(2)",
    ", '2001-11' AS run_id, CASE WHEN dataset = 'ridership' THEN (SELECT CAST(count(*) AS DOUBLE) FROM spoiled "
    "WHERE reject_reason IS NOT NULL) END AS rows_rejected FROM st",
)

# Deliveries: rows of a period, and those held back one (transfers 5) or two (6).
_DELIVERED = """
fed AS (
  SELECT *, CASE WHEN transit_timestamp < TIMESTAMP '1997-07-01' THEN 1
                 WHEN transit_timestamp < TIMESTAMP '1999-07-01' THEN 2 ELSE 3 END AS period
  FROM ridership WHERE transit_mode = 'subway'
),
fed_in AS (SELECT *, least(3, period + CASE WHEN transfers = 5 THEN 1 WHEN transfers = 6 THEN 2 ELSE 0 END) AS delivery FROM fed),
marks AS (
  SELECT d.range AS delivery, max(transit_timestamp) - INTERVAL 400 DAY AS mark
  FROM range(1, 4) d JOIN fed_in f ON f.delivery <= d.range GROUP BY 1
),
fed_rows AS (
  SELECT f.*, f.transit_timestamp + INTERVAL 1 HOUR <= m.mark AS too_late
  FROM fed_in f LEFT JOIN marks m ON m.delivery = f.delivery - 1
)"""
QUERIES["late_hours"] = q(
    f"""SELECT station_complex, station_complex_id, borough, transit_timestamp, {r6('ridership')} AS ridership,
               CASE WHEN any_late THEN 'corrected'
                    WHEN transit_timestamp + INTERVAL 1 HOUR > (SELECT max(mark) FROM marks) THEN 'open'
                    ELSE 'streamed' END AS state
        FROM (SELECT station_complex, station_complex_id, borough, transit_timestamp, SUM(ridership) AS ridership,
                     bool_or(coalesce(too_late, FALSE)) AS any_late
              FROM fed_rows GROUP BY ALL)""",
    (RIDERSHIP, _DELIVERED),
)

# The rule of those years, written out: clocks skip 2 o'clock on
# April's first Sunday and show 1 o'clock twice on October's last.
_CLOCKS = """
clocked AS (
  SELECT date_trunc('hour', transit_timestamp) AS hour, ridership,
         dayofweek(transit_timestamp) = 0 AND month(transit_timestamp) = 4 AND day(transit_timestamp) <= 7 AS spring,
         dayofweek(transit_timestamp) = 0 AND month(transit_timestamp) = 10 AND day(transit_timestamp) > 24 AS autumn
  FROM ridership
),
clocks AS (
  SELECT *, CASE WHEN spring AND hour(hour) = 2 THEN 'skipped'
                 WHEN autumn AND hour(hour) = 1 THEN 'repeated' ELSE 'plain' END AS clock
  FROM clocked
)"""
QUERIES["changeover_hours"] = q(
    f"""SELECT hour, clock, CAST(count(*) AS BIGINT) AS records, {r6('SUM(ridership)')} AS ridership
        FROM clocks WHERE spring OR autumn GROUP BY hour, clock""",
    (RIDERSHIP, _CLOCKS),
)
QUERIES["clock_gate"] = q(
    """SELECT 'ridership' AS dataset, k AS "check", 'transit_timestamp' AS "column",
              CAST(CASE WHEN k = 'skipped_hours' THEN s ELSE r END AS BIGINT) AS value,
              CASE WHEN k = 'skipped_hours' THEN CAST(0 AS DOUBLE) END AS threshold,
              k = 'repeated_hours' OR s = 0 AS passed
       FROM (SELECT count_if(clock = 'skipped') AS s, count_if(clock = 'repeated') AS r FROM clocks),
            (VALUES ('skipped_hours'), ('repeated_hours')) t(k)""",
    (RIDERSHIP, _CLOCKS),
)
