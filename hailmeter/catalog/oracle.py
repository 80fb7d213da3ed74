"""The same questions in DuckDB SQL, written from the definitions.

Only the fixture texts are shared with the Spark side; labels, bands and the names of
features are written down again here.
"""

from __future__ import annotations

from hailmeter.catalog import fixtures

# WMO code and description.
_DESCRIPTION_ROWS = """
  (0, 'Clear sky'), (1, 'Mainly clear'), (2, 'Partly cloudy'), (3, 'Overcast'),
  (45, 'Foggy'), (48, 'Depositing rime fog'),
  (51, 'Light drizzle'), (53, 'Moderate drizzle'), (55, 'Dense drizzle'),
  (56, 'Light freezing drizzle'), (57, 'Dense freezing drizzle'),
  (61, 'Slight rain'), (63, 'Moderate rain'), (65, 'Heavy rain'),
  (66, 'Light freezing rain'), (67, 'Heavy freezing rain'),
  (71, 'Slight snowfall'), (73, 'Moderate snowfall'), (75, 'Heavy snowfall'),
  (77, 'Snow grains'),
  (80, 'Slight rain showers'), (81, 'Moderate rain showers'), (82, 'Violent rain showers'),
  (85, 'Slight snow showers'), (86, 'Heavy snow showers'),
  (95, 'Thunderstorm'), (96, 'Thunderstorm with slight hail'),
  (99, 'Thunderstorm with heavy hail')"""

FEATURES = (
    "trip_count avg_total_amount avg_fare_amount avg_tip_amount avg_duration_minutes"
    " avg_distance pct_rush_hour pct_night pct_weekend pct_adverse_weather"
).split()

_PRELUDE = fixtures.wall_clock(
    f"""
WITH fx_trips AS ({fixtures.TRIPS}),
fx_yellow AS ({fixtures.YELLOW}),
fx_green AS ({fixtures.GREEN}),
fx_zones AS ({fixtures.ZONES}),
fx_weather AS ({fixtures.WEATHER}),
codes(code, label) AS (VALUES {_DESCRIPTION_ROWS}),
weather_hourly AS (
  SELECT datetime_local, temperature_f, apparent_temperature_f, precipitation_inch, rain_inch,
    snowfall_inch, snow_depth_inch, weather_code,
    COALESCE(label, 'Unknown') AS weather_description,
    wind_speed_mph, wind_gusts_mph, relative_humidity_pct, visibility_ft
  FROM fx_weather LEFT JOIN codes ON code = weather_code),
yellow AS (
  SELECT 'yellow' AS taxi_type, CAST(VendorID AS INT) AS vendor_id,
    tpep_pickup_datetime AS pickup_at, tpep_dropoff_datetime AS dropoff_at,
    passenger_count, trip_distance, RatecodeID AS rate_code_id, store_and_fwd_flag,
    CAST(PULocationID AS INT) AS pickup_zone_id, CAST(DOLocationID AS INT) AS dropoff_zone_id,
    CAST(payment_type AS INT) AS payment_type, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
    Airport_fee AS airport_fee, cbd_congestion_fee,
    CAST(NULL AS DOUBLE) AS ehail_fee, CAST(NULL AS INT) AS trip_type
  FROM fx_yellow),
green AS (
  SELECT 'green' AS taxi_type, CAST(VendorID AS INT) AS vendor_id,
    lpep_pickup_datetime AS pickup_at, lpep_dropoff_datetime AS dropoff_at,
    passenger_count, trip_distance, RatecodeID AS rate_code_id, store_and_fwd_flag,
    CAST(PULocationID AS INT) AS pickup_zone_id, CAST(DOLocationID AS INT) AS dropoff_zone_id,
    CAST(payment_type AS INT) AS payment_type, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
    CAST(NULL AS DOUBLE) AS airport_fee, cbd_congestion_fee,
    ehail_fee, CAST(trip_type AS INT) AS trip_type
  FROM fx_green),
timed AS (
  SELECT *, CAST(date_diff('minute', pickup_at, dropoff_at) AS INT) AS trip_duration_minutes,
    CAST(year(pickup_at) AS INT) AS pickup_year, CAST(month(pickup_at) AS INT) AS pickup_month,
    CAST(dayofweek(pickup_at) AS INT) AS pickup_dayofweek,
    CAST(hour(pickup_at) AS INT) AS pickup_hour
  FROM (SELECT * FROM yellow UNION ALL SELECT * FROM green)),
reasoned AS (
  SELECT *, COALESCE(pickup_hour >= 20 OR pickup_hour < 6, FALSE) AS is_night,
    COALESCE(pickup_dayofweek IN (0, 6), FALSE) AS is_weekend,
    COALESCE(pickup_dayofweek BETWEEN 1 AND 5
      AND (pickup_hour IN (7, 8) OR pickup_hour IN (17, 18)), FALSE) AS is_rush_hour,
    concat_ws(', ',
      CASE WHEN trip_duration_minutes < 0 THEN 'dropoff_before_pickup' END,
      CASE WHEN fare_amount < 0 THEN 'negative_fare' END,
      CASE WHEN total_amount < 0 THEN 'negative_total' END,
      CASE WHEN trip_distance < 0 THEN 'negative_distance' END,
      CASE WHEN trip_distance > 100 THEN 'extreme_distance' END,
      CASE WHEN pickup_year <> 2025 AND pickup_year <> 2026 THEN 'out_of_range_year' END,
      CASE WHEN pickup_month < 1 OR pickup_month > 5 THEN 'out_of_range_month' END
    ) AS dq_flag_reason
  FROM timed),
stg AS (SELECT *, dq_flag_reason = '' AS is_valid FROM reasoned),
zones AS (
  SELECT LocationID AS location_id, Borough AS borough, Zone AS zone_name, service_zone
  FROM fx_zones),
bands(lo, hi, band) AS (VALUES (0, 1, 'Clear'), (2, 3, 'Cloudy'), (45, 45, 'Fog'),
  (48, 48, 'Fog'), (51, 57, 'Drizzle'), (61, 67, 'Rain'), (71, 77, 'Snow'),
  (80, 82, 'Rain Showers'), (85, 86, 'Snow Showers'), (95, 99, 'Thunderstorm')),
hours AS (
  SELECT h.*, CAST(datetime_local AS DATE) AS weather_date,
    CAST(hour(datetime_local) AS INT) AS weather_hour,
    COALESCE(band, 'Other') AS weather_category,
    COALESCE(weather_code >= 61, FALSE) OR COALESCE(snowfall_inch > 0, FALSE)
      OR COALESCE(wind_speed_mph > 25, FALSE) AS is_adverse_weather,
    CAST(year(datetime_local) AS INT) AS weather_year
  FROM weather_hourly h LEFT JOIN bands ON weather_code BETWEEN lo AND hi),
labels(code, label) AS (VALUES (1, 'Credit Card'), (2, 'Cash'), (3, 'No Charge'),
  (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided')),
fct AS (
  SELECT t.taxi_type, t.pickup_at, t.dropoff_at, t.pickup_year, t.pickup_month,
    t.pickup_dayofweek, t.pickup_hour, t.is_night, t.is_weekend, t.is_rush_hour,
    t.trip_duration_minutes, t.trip_distance, t.passenger_count,
    COALESCE(p.label, 'Unknown') AS payment_type,
    t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount, t.improvement_surcharge,
    t.congestion_surcharge, t.cbd_congestion_fee, t.airport_fee, t.total_amount,
    t.pickup_zone_id, t.dropoff_zone_id,
    a.borough AS pickup_borough, a.zone_name AS pickup_zone_name,
    b.borough AS dropoff_borough, b.zone_name AS dropoff_zone_name,
    w.weather_category, w.is_adverse_weather, w.temperature_f, w.precipitation_inch,
    w.wind_speed_mph
  FROM stg t
    LEFT JOIN zones a ON t.pickup_zone_id = a.location_id
    LEFT JOIN zones b ON t.dropoff_zone_id = b.location_id
    LEFT JOIN hours w
      ON w.weather_date = CAST(t.pickup_at AS DATE) AND w.weather_hour = t.pickup_hour
    LEFT JOIN labels p ON p.code = t.payment_type
  WHERE t.is_valid),
city AS (
  SELECT * FROM fct
  WHERE pickup_borough IS NOT NULL AND pickup_borough NOT IN ('Unknown', 'N/A', 'EWR')),
mart AS (
  SELECT pickup_borough, weather_category, is_adverse_weather, pickup_year, pickup_month,
    pickup_hour, is_rush_hour, is_night, is_weekend, payment_type,
    COUNT(*) AS trip_count, SUM(total_amount) AS total_revenue, SUM(fare_amount) AS total_fares,
    SUM(tip_amount) AS total_tips, SUM(tolls_amount) AS total_tolls,
    SUM(congestion_surcharge) AS total_congestion_surcharge,
    SUM(cbd_congestion_fee) AS total_cbd_fee, AVG(total_amount) AS avg_fare_total,
    AVG(tip_amount) AS avg_tip, AVG(trip_duration_minutes) AS avg_duration_minutes,
    AVG(trip_distance) AS avg_distance
  FROM city GROUP BY ALL),
years(y) AS (VALUES (2025), (2026)),
boroughs AS (SELECT DISTINCT pickup_borough FROM mart),
dim_weather AS (
  SELECT CAST(weather_date AS VARCHAR) AS weather_date, weather_hour, temperature_f,
    apparent_temperature_f, precipitation_inch, rain_inch, snowfall_inch, snow_depth_inch,
    weather_code, weather_description, wind_speed_mph, wind_gusts_mph, relative_humidity_pct,
    visibility_ft, weather_category, is_adverse_weather
  FROM hours)
""",
    fixtures.DUCKDB_CLOCK,
)

ORACLE: dict[str, str] = {}


def _add(name: str, body: str) -> None:
    ORACLE[name] = f"{_PRELUDE}\n{body.strip()}"


# --- sources and sinks ----------------------------------------------------------
_add("scan_yellow_files", "SELECT * FROM fx_yellow")
_add("scan_green_files", "SELECT * FROM fx_green")
_add(
    "align_columns_by_name",
    """
SELECT * REPLACE (
  CASE WHEN year(tpep_pickup_datetime) = 2025 THEN NULL ELSE cbd_congestion_fee END
  AS cbd_congestion_fee) FROM fx_yellow
""",
)

_DRIFT = [
    ("VENDORID", "bigint", "bigint", "ok", "VendorID"),
    ("TPEP_PICKUP_DATETIME", "timestamp_ntz", "timestamp_ntz", "ok", "tpep_pickup_datetime"),
    ("TPEP_DROPOFF_DATETIME", "timestamp_ntz", "timestamp_ntz", "ok", "tpep_dropoff_datetime"),
    ("RATECODEID", "double", "double", "ok", "RatecodeID"),
    ("STORE_AND_FWD_FLAG", "string", "string", "ok", "store_and_fwd_flag"),
    ("PULOCATIONID", "bigint", "int", "type_changed", "PULocationID"),
    ("DOLOCATIONID", "bigint", "int", "type_changed", "DOLocationID"),
    ("PAYMENT_TYPE", "bigint", "bigint", "ok", "payment_type"),
    ("cbd_congestion_fee", "double", None, "missing", None),
    ("SURGE", None, "double", "extra", "fare_amount"),
] + [
    (name.upper(), "double", "double", "ok", name)
    for name in (
        "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
        "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
        "Airport_fee",
    )
]


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


_add(
    "schema_drift",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {_text(want)} AS expected_type, {_text(got)} AS"
        f" actual_type, '{status}' AS status, "
        + (f"COUNT({source})" if source else "CAST(NULL AS BIGINT)")
        + " AS non_null_count FROM fx_yellow"
        + ("" if source else " HAVING COUNT(*) >= 0")
        for name, want, got, status, source in _DRIFT
    ),
)

_BROKEN = "(strftime(tpep_pickup_datetime, '%Y-%m') = '2025-03' AND VendorID = 2)"
_add(
    "tolerant_load",
    f"""
SELECT CAST(VendorID AS INT) AS vendor, COUNT(*) AS row_count, SUM(fare_amount) AS fares
FROM fx_yellow WHERE NOT {_BROKEN} GROUP BY VendorID
""",
)
_add(
    "tolerant_load_rejects",
    f"""
SELECT CAST(VendorID AS INT) AS vendor, COUNT(*) AS rejected
FROM fx_yellow WHERE {_BROKEN} GROUP BY VendorID
""",
)
_add(
    "load_history",
    f"""
SELECT CASE WHEN strftime(tpep_pickup_datetime, '%Y-%m') = '2025-03' THEN 'PARTIALLY_LOADED'
    ELSE 'LOADED' END AS status,
  COUNT(*) FILTER (WHERE NOT {_BROKEN}) AS row_count, COUNT(*) AS row_parsed
FROM fx_yellow GROUP BY 1
""",
)
_add(
    "load_history_by_folder",
    f"""
SELECT 'landed_month=' || strftime(tpep_pickup_datetime, '%Y-%m') AS file_name,
  CASE WHEN bool_or{_BROKEN} THEN 'PARTIALLY_LOADED' ELSE 'LOADED' END AS status,
  COUNT(*) FILTER (WHERE NOT {_BROKEN}) AS row_count, COUNT(*) AS row_parsed,
  MIN('2,"zone ""' || PULocationID || '"", N/A",n/a?') FILTER (WHERE {_BROKEN})
    AS first_error_message
FROM fx_yellow GROUP BY 1
""",
)
_add("tolerant_load_parquet", "SELECT * FROM fx_green")
_add(
    "load_history_parquet",
    """
SELECT 'landed=good' AS file_name, 'LOADED' AS status, COUNT(*) AS row_count,
  COUNT(*) AS row_parsed, CAST(NULL AS VARCHAR) AS first_error_message FROM fx_green
UNION ALL SELECT 'landed=broken', 'LOAD_FAILED', 0, 0, 'no readable rows'
""",
)
_add(
    "tolerant_cast",
    """
SELECT CASE WHEN payment_type = 3 THEN 'rejected' ELSE 'good' END AS table_name,
  COUNT(*) AS row_count FROM fx_yellow GROUP BY 1
""",
)
_add("scan_zone_csv", "SELECT * FROM fx_zones")
_add("flatten_hourly_json", "SELECT * FROM weather_hourly")
_add(
    "weather_code_description",
    """
SELECT weather_code, weather_description, COUNT(*) AS hours
FROM weather_hourly GROUP BY 1, 2
""",
)
_add(
    "parse_local_timestamp",
    "SELECT date_trunc('minute', pickup_at) AS at, COUNT(*) AS trips FROM stg GROUP BY 1",
)
_add("overwrite_table", "SELECT * FROM green")
_add("publish_table", "SELECT * FROM green")
_add("append_table", "SELECT * FROM weather_hourly")
_add(
    "append_small_frame",
    "SELECT * FROM fx_zones UNION ALL SELECT * FROM (VALUES"
    " (9001, 'Queens', 'New Yard', 'Boro Zone'), (9002, NULL, 'Unnamed', NULL))",
)
_INVENTORY = """
SELECT 'landed_month=' || strftime(tpep_pickup_datetime, '%Y-%m') AS landed,
  COUNT(*) AS row_count, strftime(MIN(tpep_pickup_datetime), '%Y-%m') AS first_month,
  strftime(MAX(tpep_pickup_datetime), '%Y-%m') AS last_month
FROM fx_yellow GROUP BY 1
"""
_add("file_inventory", _INVENTORY)
_add(
    "inventory_check",
    f"""
SELECT COUNT(*) AS landed_count, CAST(10 AS BIGINT) AS expected_count,
  COUNT(*) = 10 AS as_expected FROM ({_INVENTORY})
""",
)
_add(
    "sample_rows",
    """
SELECT pickup_at, pickup_zone_id, dropoff_zone_id, fare_amount, trip_distance, total_amount
FROM fct ORDER BY pickup_at, pickup_zone_id, dropoff_zone_id, fare_amount, trip_distance
LIMIT 1000
""",
)

# --- projection and conforming ----------------------------------------------------
_add("conform_yellow", "SELECT * FROM yellow")
_add("conform_green", "SELECT * FROM green")
_add("stg_trips", "SELECT * FROM stg")
_add("stg_zones", "SELECT * FROM zones")
_add("dim_zones", "SELECT * FROM zones")
_add(
    "stg_weather",
    """
SELECT * EXCLUDE (weather_year)
  REPLACE (CAST(weather_date AS VARCHAR) AS weather_date) FROM hours
""",
)
_add("dim_weather", "SELECT * FROM dim_weather")
_add(
    "payment_label",
    """
SELECT payment_type, CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash'
    WHEN 3 THEN 'No Charge' WHEN 4 THEN 'Dispute' WHEN 6 THEN 'Voided' ELSE 'Unknown'
  END AS payment_label, COUNT(*) AS trips
FROM stg GROUP BY 1, 2
""",
)
_add(
    "month_label",
    """
SELECT pickup_month, strftime(MIN(pickup_at), '%b') AS month_label, COUNT(*) AS trips
FROM stg GROUP BY 1
""",
)
_add(
    "trip_duration_minutes",
    "SELECT trip_duration_minutes, COUNT(*) AS trips FROM stg GROUP BY 1",
)
_add(
    "time_flags",
    """
SELECT pickup_dayofweek, pickup_hour, is_night, is_weekend, is_rush_hour, COUNT(*) AS trips
FROM stg GROUP BY ALL
""",
)
_add(
    "weather_category",
    """
SELECT weather_code, weather_category, is_adverse_weather, COUNT(*) AS hours
FROM hours GROUP BY ALL
""",
)

# --- filters ------------------------------------------------------------------------
_add(
    "valid_trips",
    """
SELECT taxi_type, pickup_at, dropoff_at, trip_distance, total_amount, dq_flag_reason
FROM stg WHERE is_valid
""",
)
_add("city_boroughs", "SELECT pickup_borough, COUNT(*) AS trips FROM city GROUP BY 1")
_add("catch_all_zones", "SELECT * FROM zones WHERE location_id IN (22, 23)")
_add(
    "very_long_trips",
    """
SELECT pickup_at, dropoff_at, trip_duration_minutes FROM stg WHERE trip_duration_minutes > 240
""",
)
_add(
    "zero_distance_with_fare",
    """
SELECT pickup_at, trip_distance, fare_amount FROM stg
WHERE trip_distance = 0 AND fare_amount > 5
""",
)
_add(
    "filter_dimensions",
    """
SELECT * FROM mart WHERE pickup_borough IN ('Manhattan', 'Queens')
  AND weather_category IN ('Rain', 'Snow') AND pickup_year = 2026
  AND payment_type = 'Credit Card'
""",
)

# --- joins ----------------------------------------------------------------------------
for _role in ("pickup", "dropoff"):
    _add(
        f"enrich_{_role}_zone",
        f"""
SELECT pickup_at, {_role}_zone_id, borough AS {_role}_borough, zone_name AS {_role}_zone_name
FROM stg LEFT JOIN zones ON {_role}_zone_id = location_id
""",
    )
_add(
    "enrich_weather",
    """
SELECT pickup_at, w.weather_category, w.is_adverse_weather, w.temperature_f,
  w.precipitation_inch, w.wind_speed_mph
FROM stg LEFT JOIN hours w
  ON w.weather_date = CAST(pickup_at AS DATE) AND w.weather_hour = pickup_hour
""",
)
_add("fact_trips", "SELECT * FROM fct")
_add("fact_trips_salted", "SELECT * FROM fct")
_add(
    "pickup_flows",
    """
SELECT pickup_borough, dropoff_borough, COUNT(*) AS trip_count, SUM(total_amount) AS total_revenue
FROM fct GROUP BY 1, 2
""",
)
_add(
    "referential_check",
    """
SELECT COUNT(*) AS failures FROM stg
WHERE pickup_zone_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM zones WHERE location_id = pickup_zone_id)
""",
)
_add(
    "weather_match",
    """
SELECT COUNT(*) AS trips, COUNT(weather_category) AS matched,
  COUNT(weather_category) * 100 / COUNT(*) AS match_pct FROM fct
""",
)

# --- aggregations -----------------------------------------------------------------------
_add("mart_weather_demand", "SELECT * FROM mart")
_BRONZE_COUNTS = """
SELECT 'yellow_raw' AS table_name, COUNT(*) AS row_count FROM fx_yellow
UNION ALL SELECT 'green_raw', COUNT(*) FROM fx_green
UNION ALL SELECT 'zone_lookup', COUNT(*) FROM fx_zones
UNION ALL SELECT 'weather_hourly', COUNT(*) FROM fx_weather
"""
_add("table_counts", _BRONZE_COUNTS)
_add(
    "pickup_range",
    " UNION ALL ".join(
        f"SELECT '{feed}' AS feed, MIN({at}) AS earliest, MAX({at}) AS latest,"
        f" COUNT(DISTINCT year({at})) AS distinct_years FROM {table}"
        for feed, at, table in (
            ("yellow", "tpep_pickup_datetime", "fx_yellow"),
            ("green", "lpep_pickup_datetime", "fx_green"),
            ("weather", "datetime_local", "fx_weather"),
        )
    ),
)
_add(
    "weather_hours_by_year",
    "SELECT weather_year AS yr, COUNT(*) AS hours FROM hours GROUP BY 1 ORDER BY 1",
)
_add("trips_by_taxi_type", "SELECT taxi_type, COUNT(*) AS trips FROM stg GROUP BY 1")
_add(
    "trips_by_month",
    "SELECT pickup_year, pickup_month, COUNT(*) AS trips FROM stg GROUP BY 1, 2 ORDER BY 1, 2",
)
_add(
    "validity_share",
    """
SELECT is_valid, COUNT(*) AS row_count,
  ROUND(COUNT(*) * CAST(100 AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS pct
FROM stg GROUP BY is_valid
""",
)
_add(
    "dq_reason_topk",
    """
SELECT dq_flag_reason, COUNT(*) AS row_count FROM stg WHERE NOT is_valid
GROUP BY 1 ORDER BY row_count DESC, dq_flag_reason LIMIT 20
""",
)
_RULES = (
    "dropoff_before_pickup", "negative_fare", "negative_total", "negative_distance",
    "extreme_distance", "out_of_range_year", "out_of_range_month",
)
_add(
    "dq_rule_counts",
    " UNION ALL ".join(
        f"SELECT '{rule}' AS rule_name,"
        f" COUNT(*) FILTER (WHERE list_contains(string_split(dq_flag_reason, ', '), '{rule}'))"
        f" AS row_count, COUNT(*) FILTER"
        f" (WHERE list_contains(string_split(dq_flag_reason, ', '), '{rule}')) * 100 / COUNT(*)"
        " AS pct FROM stg"
        for rule in _RULES
    ),
)
_add(
    "dq_exploratory_counts",
    """
SELECT COUNT(*) FILTER (WHERE passenger_count IS NULL OR passenger_count = 0)
    AS zero_or_null_passengers,
  COUNT(*) FILTER (WHERE trip_duration_minutes > 240) AS very_long_trips,
  COUNT(*) FILTER (WHERE trip_duration_minutes < 1 AND trip_duration_minutes >= 0)
    AS very_short_trips,
  COUNT(*) FILTER (WHERE trip_distance = 0 AND fare_amount > 5) AS zero_dist_with_fare
FROM stg
""",
)
_add(
    "mart_reaggregate",
    """
SELECT pickup_borough, payment_type, COUNT(*) AS trip_count, SUM(total_amount) AS total_revenue,
  SUM(tip_amount) AS total_tips FROM city GROUP BY 1, 2
""",
)
_WEEKPART = """
SELECT dayofweek(weather_date) IN (0, 6) AS is_weekend, COUNT(DISTINCT weather_date) AS days
FROM hours GROUP BY 1
"""
_add("weekpart_days", _WEEKPART)
_ZONE_FEATURES = """
SELECT {keys}, COUNT(*) AS trip_count, AVG(total_amount) AS avg_total_amount,
  AVG(fare_amount) AS avg_fare_amount, AVG(tip_amount) AS avg_tip_amount,
  AVG(trip_duration_minutes) AS avg_duration_minutes, AVG(trip_distance) AS avg_distance,
  AVG(CAST(is_rush_hour AS INT)) AS pct_rush_hour, AVG(CAST(is_night AS INT)) AS pct_night,
  AVG(CAST(is_weekend AS INT)) AS pct_weekend,
  AVG(CAST(is_adverse_weather AS INT)) AS pct_adverse_weather
FROM fct GROUP BY ALL
"""
_add("zone_features", _ZONE_FEATURES.format(keys="pickup_zone_id"))
_add(
    "layer_reconciliation",
    """
SELECT (SELECT COUNT(*) FROM fx_yellow) AS bronze_yellow,
  (SELECT COUNT(*) FROM fx_green) AS bronze_green,
  (SELECT COUNT(*) FROM stg) AS silver_total,
  (SELECT COUNT(*) FROM fx_yellow) + (SELECT COUNT(*) FROM fx_green) AS expected_total,
  (SELECT COUNT(*) FROM stg)
    - ((SELECT COUNT(*) FROM fx_yellow) + (SELECT COUNT(*) FROM fx_green)) AS difference
""",
)
_add(
    "domain_values",
    """
SELECT DISTINCT weather_category FROM fct WHERE weather_category IS NOT NULL ORDER BY 1
""",
)

# --- reports ------------------------------------------------------------------------------
_add(
    "monthly_volume",
    """
SELECT pickup_borough, pickup_year, pickup_month,
  strftime(make_date(2025, pickup_month, 1), '%b') AS month_label,
  CAST(SUM(trip_count) AS BIGINT) AS trip_count
FROM mart GROUP BY 1, 2, 3
""",
)
_add(
    "hourly_demand_weekpart",
    f"""
SELECT pickup_borough, pickup_hour, is_weekend, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
  SUM(trip_count) / MAX(days) AS avg_trips
FROM mart JOIN ({_WEEKPART}) USING (is_weekend) GROUP BY 1, 2, 3
""",
)
_add(
    "avg_trip_cost",
    """
SELECT weather_category, pickup_borough, CAST(y AS INT) AS pickup_year,
  COALESCE(cost, 0) AS avg_cost
FROM (SELECT DISTINCT weather_category, pickup_borough FROM mart
    WHERE weather_category IS NOT NULL) AS present
  CROSS JOIN years
  LEFT JOIN (
    SELECT weather_category, pickup_borough, pickup_year AS y,
      (SUM(total_revenue) - SUM(total_tips)) / SUM(trip_count) AS cost
    FROM mart GROUP BY 1, 2, 3) AS found USING (weather_category, pickup_borough, y)
""",
)
# Trips and hours per borough and year under a condition; {measure} is summed.
_EXPOSED = """
(SELECT pickup_borough, CAST(y AS INT) AS pickup_year,
  COALESCE((SELECT {measure} FROM mart m WHERE m.pickup_borough = b.pickup_borough
    AND m.pickup_year = y AND ({trip})), 0) AS amount,
  (SELECT COUNT(*) FROM hours WHERE weather_year = y AND ({hour})) AS exposure
 FROM boroughs b CROSS JOIN years)
"""


def _exposed(measure: str, trip: str, hour: str) -> str:
    return _EXPOSED.format(measure=measure, trip=trip, hour=hour)


def _versus(measure: str, hit: tuple[str, str], base: tuple[str, str], extra: str = "") -> str:
    """Rates per exposure hour of a condition and its baseline."""
    return f"""
SELECT a.pickup_borough, a.pickup_year, a.amount AS hit_amount, a.exposure AS hit_hours,
  c.amount AS base_amount, c.exposure AS base_hours,
  CASE WHEN a.exposure > 0 THEN a.amount / a.exposure ELSE 0 END AS hit_rate,
  CASE WHEN c.exposure > 0 THEN c.amount / c.exposure ELSE 0 END AS base_rate{extra}
FROM {_exposed(measure, *hit)} a JOIN {_exposed(measure, *base)} c
  USING (pickup_borough, pickup_year)
"""


_TRIPS_SUM = "CAST(SUM(trip_count) AS BIGINT)"
_PCT = "CASE WHEN base_rate > 0 THEN (hit_rate - base_rate) / base_rate * 100 ELSE 0 END"
_SCOPES = {
    "all": ("TRUE", "TRUE"),
    "day": ("NOT is_night", "weather_hour BETWEEN 6 AND 19"),
    "night": ("is_night", "NOT weather_hour BETWEEN 6 AND 19"),
}
_add(
    "adverse_demand_change",
    " UNION ALL ".join(
        f"""
SELECT pickup_borough, pickup_year, '{scope}' AS scope, hit_amount AS adverse_trip_count,
  hit_hours AS adverse_hours, base_amount AS clear_trip_count, base_hours AS clear_hours,
  {_PCT} AS pct_change
FROM ({_versus(
    _TRIPS_SUM,
    (f"{trip} AND is_adverse_weather", f"{hour} AND is_adverse_weather"),
    (f"{trip} AND NOT is_adverse_weather", f"{hour} AND NOT is_adverse_weather"),
)})
"""
        for scope, (trip, hour) in _SCOPES.items()
    ),
)
_add(
    "weather_type_demand_change",
    " UNION ALL ".join(
        f"""
SELECT pickup_borough, pickup_year, '{kind}' AS weather_type, {_PCT} AS pct_change
FROM ({_versus(
    _TRIPS_SUM,
    (f"weather_category = '{kind}'", f"weather_category = '{kind}'"),
    ("weather_category = 'Clear'", "weather_category = 'Clear'"),
)})
"""
        for kind in ("Rain", "Snow")
    ),
)


def _delta(rush_hours: str) -> str:
    return " UNION ALL ".join(
        f"""
SELECT pickup_borough, pickup_year, '{period}' AS period, hit_rate - base_rate AS delta
FROM ({_versus(
    "SUM(total_revenue)",
    (f"{trip} AND is_adverse_weather", f"{hour} AND is_adverse_weather"),
    (f"{trip} AND NOT is_adverse_weather", f"{hour} AND NOT is_adverse_weather"),
)})
"""
        for period, trip, hour in (
            ("Rush Hour", "is_rush_hour", rush_hours),
            ("Off-Peak", "NOT is_rush_hour", f"NOT ({rush_hours})"),
        )
    )


_RUSH = "weather_hour IN (7, 8, 17, 18)"
_add("adverse_revenue_delta", _delta(_RUSH))
_add(
    "adverse_revenue_delta_strict",
    _delta(f"{_RUSH} AND dayofweek(weather_date) NOT IN (0, 6)"),
)
_add(
    "rush_revenue_swing",
    f"""
SELECT pickup_borough, period, SUM(delta) FILTER (WHERE pickup_year = 2025) AS first_delta,
  SUM(delta) FILTER (WHERE pickup_year = 2026) AS second_delta,
  SUM(delta) FILTER (WHERE pickup_year = 2026) - SUM(delta) FILTER (WHERE pickup_year = 2025)
    AS swing
FROM ({_delta(_RUSH)}) GROUP BY 1, 2
""",
)
_add(
    "borough_share_shift",
    f"""
SELECT pickup_borough, pickup_year, adverse_share, clear_share,
  adverse_share - clear_share AS shift_pp
FROM (
  SELECT pickup_borough, pickup_year,
    CASE WHEN SUM(hit_amount) OVER w > 0
      THEN CAST(hit_amount AS DOUBLE) / SUM(hit_amount) OVER w * 100 ELSE 0 END AS adverse_share,
    CASE WHEN SUM(base_amount) OVER w > 0
      THEN CAST(base_amount AS DOUBLE) / SUM(base_amount) OVER w * 100 ELSE 0 END AS clear_share
  FROM ({_versus(_TRIPS_SUM, ("is_adverse_weather", "TRUE"), ("NOT is_adverse_weather", "TRUE"))})
  WINDOW w AS (PARTITION BY pickup_year))
""",
)
_add(
    "yoy_change",
    """
SELECT pickup_borough, first_trips, second_trips,
  CASE WHEN first_trips > 0 THEN (second_trips - first_trips) / first_trips * 100 ELSE 0 END
    AS pct_change
FROM (SELECT pickup_borough, COUNT(*) FILTER (WHERE pickup_year = 2025) AS first_trips,
  COUNT(*) FILTER (WHERE pickup_year = 2026) AS second_trips FROM city GROUP BY 1)
""",
)
_FACT_TYPES = {
    "taxi_type": "string", "pickup_at": "timestamp_ntz", "dropoff_at": "timestamp_ntz",
    "pickup_year": "int", "pickup_month": "int", "pickup_dayofweek": "int", "pickup_hour": "int",
    "is_night": "boolean", "is_weekend": "boolean", "is_rush_hour": "boolean",
    "trip_duration_minutes": "int", "trip_distance": "double", "passenger_count": "double",
    "payment_type": "string", "fare_amount": "double", "extra": "double", "mta_tax": "double",
    "tip_amount": "double", "tolls_amount": "double", "improvement_surcharge": "double",
    "congestion_surcharge": "double", "cbd_congestion_fee": "double", "airport_fee": "double",
    "total_amount": "double", "pickup_zone_id": "int", "dropoff_zone_id": "int",
    "pickup_borough": "string", "pickup_zone_name": "string", "dropoff_borough": "string",
    "dropoff_zone_name": "string", "weather_category": "string", "is_adverse_weather": "boolean",
    "temperature_f": "double", "precipitation_inch": "double", "wind_speed_mph": "double",
}
_add(
    "profile_columns",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS column_type, COUNT({name}) AS"
        f" non_null_count, CAST(MIN({name}{plus}) AS VARCHAR) AS sample_value, COUNT(*) AS row_count,"
        f" CAST({len(_FACT_TYPES)} AS INT) AS column_count FROM fct"
        for name, kind in _FACT_TYPES.items()
        for plus in (" + 0" if kind == "double" else "",)
    ),
)

# --- documented analyses --------------------------------------------------------------------
_CONDITION = """CASE WHEN weather_category IN ('Clear', 'Cloudy', 'Drizzle') THEN 'Clear/Normal'
  WHEN weather_category IN ('Rain', 'Snow') THEN weather_category
  WHEN weather_category IS NOT NULL THEN 'Other' END"""
_CONDITIONS = "conditions(condition) AS (VALUES ('Clear/Normal'), ('Rain'), ('Snow'))"
_ORIGINAL_PCT = "CASE WHEN {base} > 0 THEN ({value} - {base}) / {base} * 100 ELSE 0 END"
_add(
    "revenue_per_active_minute",
    f"""
, {_CONDITIONS},
rates AS (
  SELECT b.pickup_borough, c.condition, COALESCE((
    SELECT (SUM(total_amount) - SUM(tip_amount)) / COUNT(*) / NULLIF(AVG(trip_duration_minutes), 0)
    FROM city t
    WHERE t.pickup_borough = b.pickup_borough AND {_CONDITION} = c.condition), 0) AS per_minute
  FROM boroughs b CROSS JOIN conditions c)
SELECT r.pickup_borough, r.condition, r.per_minute,
  {_ORIGINAL_PCT.format(value="r.per_minute", base="n.per_minute")} AS pct_vs_normal
FROM rates r JOIN rates n ON r.pickup_borough = n.pickup_borough
  AND n.condition = 'Clear/Normal'
""",
)
_add(
    "trips_per_hour",
    f"""
, {_CONDITIONS},
exposure AS (
  SELECT c.condition, (SELECT COUNT(*) FROM hours WHERE {_CONDITION} = c.condition) AS hours
  FROM conditions c),
rates AS (
  SELECT b.pickup_borough, e.condition, e.hours,
    CASE WHEN e.hours > 0 THEN (SELECT COUNT(*) FROM city t
      WHERE t.pickup_borough = b.pickup_borough AND {_CONDITION} = e.condition) / e.hours
      ELSE 0 END AS trips_per_hour,
    COALESCE((SELECT (SUM(total_amount) - SUM(tip_amount)) / COUNT(*) FROM city t
      WHERE t.pickup_borough = b.pickup_borough AND {_CONDITION} = e.condition), 0) AS avg_fare
  FROM boroughs b CROSS JOIN exposure e)
SELECT r.*, {_ORIGINAL_PCT.format(value="r.trips_per_hour", base="n.trips_per_hour")}
  AS pct_vs_normal
FROM rates r JOIN rates n ON r.pickup_borough = n.pickup_borough
  AND n.condition = 'Clear/Normal'
""",
)
_add(
    "weather_hour_share",
    f"""
SELECT {_CONDITION} AS condition, COUNT(*) AS hours,
  COUNT(*) * 100 / (SELECT COUNT(*) FROM hours) AS pct
FROM hours GROUP BY 1
""",
)
_GAP = """(total_amount - (COALESCE(fare_amount, 0) + COALESCE(extra, 0) + COALESCE(mta_tax, 0)
  + COALESCE(tip_amount, 0) + COALESCE(tolls_amount, 0) + COALESCE(improvement_surcharge, 0)
  + COALESCE(congestion_surcharge, 0) + COALESCE(cbd_congestion_fee, 0)
  + COALESCE(airport_fee, 0)))"""
_OFF = f"ABS({_GAP}) > 0.005"
_add(
    "total_mismatch",
    f"""
SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {_OFF}) AS mismatched,
  COUNT(*) FILTER (WHERE {_OFF}) * 100 / COUNT(*) AS pct FROM fct
""",
)
_add(
    "top_gaps",
    f"""
SELECT ROUND({_GAP}, 2) AS gap, COUNT(*) AS trips FROM fct WHERE {_OFF}
GROUP BY 1 ORDER BY trips DESC, gap LIMIT 10
""",
)
_add(
    "surcharge_by_month",
    f"""
SELECT taxi_type, pickup_year, pickup_month, COUNT(*) AS trips,
  COUNT(*) FILTER (WHERE {_OFF}) AS mismatched, AVG({_GAP}) FILTER (WHERE {_OFF}) AS avg_gap,
  COUNT(*) FILTER (WHERE {_OFF}) / COUNT(*) AS mismatched_share
FROM fct GROUP BY 1, 2, 3
""",
)
_add(
    "unknown_payment_profile",
    """
SELECT pickup_year, COUNT(*) FILTER (WHERE payment_type = 0) AS type0_trips,
  COUNT(*) FILTER (WHERE payment_type = 0) * 100 / COUNT(*) AS type0_pct,
  AVG(total_amount) FILTER (WHERE payment_type = 0) AS type0_avg_total,
  AVG(total_amount) FILTER (WHERE payment_type = 1) AS card_avg_total
FROM stg GROUP BY 1
""",
)
_add(
    "payment0_by_vendor",
    """
SELECT vendor_id, COUNT(*) AS trips, COUNT(*) FILTER (WHERE payment_type = 0) AS type0_trips,
  COUNT(*) FILTER (WHERE payment_type = 0) * 100 / COUNT(*) AS type0_pct
FROM stg GROUP BY 1
""",
)
_add(
    "tip_audit",
    """
SELECT payment_type, COUNT(*) AS trips, AVG(tip_amount) AS avg_tip,
  COUNT(*) FILTER (WHERE tip_amount = 0) AS zero_tip_trips
FROM fct GROUP BY 1
""",
)
# Islands by running difference instead of row arithmetic in days.
_RUNS = """
SELECT weather_year, MAX(hours) AS longest_hours FROM (
  SELECT weather_year, run, COUNT(*) AS hours FROM (
    SELECT weather_year, SUM(starts) OVER (PARTITION BY weather_year ORDER BY datetime_local)
      AS run
    FROM (SELECT weather_year, datetime_local,
      CASE WHEN date_diff('hour', LAG(datetime_local)
        OVER (PARTITION BY weather_year ORDER BY datetime_local), datetime_local) = 1
        THEN 0 ELSE 1 END AS starts
      FROM hours WHERE weather_category = 'Snow'))
  GROUP BY 1, 2)
GROUP BY 1
"""
_add("longest_run", _RUNS)
_SEVERITY = f"""
SELECT weather_year, COUNT(*) FILTER (WHERE weather_category = 'Snow') AS snow_hours,
  SUM(snowfall_inch) AS total_snowfall,
  AVG(snow_depth_inch) FILTER (WHERE weather_category = 'Snow') AS avg_snow_depth,
  MAX(snow_depth_inch) FILTER (WHERE weather_category = 'Snow') AS max_snow_depth,
  COUNT(*) FILTER (WHERE weather_category = 'Snow' AND month(datetime_local) = 1)
    AS january_snow_hours,
  COUNT(*) FILTER (WHERE weather_category = 'Snow' AND month(datetime_local) = 3)
    AS march_snow_hours,
  COUNT(*) FILTER (WHERE weather_category = 'Rain') AS rain_hours,
  AVG(rain_inch) FILTER (WHERE weather_category = 'Rain') AS rain_intensity,
  SUM(rain_inch) AS total_rainfall, COALESCE(MAX(longest_hours), 0) AS longest_hours
FROM hours LEFT JOIN ({_RUNS}) USING (weather_year) GROUP BY 1
"""
_add("storm_severity", _SEVERITY)
_METRICS = (
    "snow_hours", "total_snowfall", "avg_snow_depth", "max_snow_depth", "january_snow_hours",
    "march_snow_hours", "rain_hours", "rain_intensity", "total_rainfall", "longest_hours",
)
_add(
    "storm_severity_change",
    f", severity AS ({_SEVERITY}), tall AS ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST(MAX({m}) FILTER (WHERE weather_year = 2025) AS DOUBLE)"
        f" AS first_value, CAST(MAX({m}) FILTER (WHERE weather_year = 2026) AS DOUBLE)"
        " AS second_value FROM severity"
        for m in _METRICS
    )
    + ") SELECT *, "
    + _ORIGINAL_PCT.format(value="second_value", base="first_value")
    + " AS pct_change FROM tall",
)
_add(
    "trip_shape_by_condition",
    """
SELECT pickup_borough, pickup_year, is_adverse_weather, AVG(trip_duration_minutes)
  AS avg_duration, AVG(trip_distance) AS avg_distance FROM city GROUP BY 1, 2, 3
""",
)
_DEFECTS = {
    "zero_distance_with_fare": "trip_distance = 0 AND fare_amount > 0",
    "zero_total": "total_amount = 0",
    "zero_total_no_charge_or_dispute": "total_amount = 0"
    " AND payment_type IN ('No Charge', 'Dispute')",
    "unknown_borough": "pickup_borough IS NULL OR pickup_borough IN ('Unknown', 'N/A')",
    "airport_outside_city": "pickup_borough = 'EWR'",
}
_add(
    "left_in_defects",
    " UNION ALL ".join(
        f"SELECT '{name}' AS defect, COUNT(*) FILTER (WHERE {condition}) AS trips,"
        f" COUNT(*) FILTER (WHERE {condition}) * 100 / COUNT(*) AS pct FROM fct"
        for name, condition in _DEFECTS.items()
    ),
)
_add(
    "zero_totals_by_payment",
    """
SELECT payment_type, COUNT(*) AS trips,
  COUNT(*) FILTER (WHERE total_amount = 0) AS zero_total_trips,
  COUNT(*) FILTER (WHERE total_amount = 0) * 100 / COUNT(*) AS zero_total_pct
FROM fct GROUP BY 1
""",
)
# All other columns of a staged trip in their order, NULLs first.
_BY_COLUMN = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "taxi_type", "vendor_id", "dropoff_at", "passenger_count", "trip_distance",
        "rate_code_id", "store_and_fwd_flag", "payment_type", "extra", "mta_tax", "tip_amount",
        "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
        "airport_fee", "cbd_congestion_fee", "ehail_fee", "trip_type", "trip_duration_minutes",
        "pickup_year", "pickup_month", "pickup_dayofweek", "pickup_hour", "is_night",
        "is_weekend", "is_rush_hour", "is_valid", "dq_flag_reason",
    )
)
_RESENT = "(SELECT * FROM stg UNION ALL SELECT * FROM stg WHERE payment_type = 2)"
_add(
    "duplicate_trips",
    f"""
SELECT pickup_at, pickup_zone_id, dropoff_zone_id, fare_amount, COUNT(*) AS copies
FROM {_RESENT} GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1
""",
)
_add(
    "drop_duplicate_trips",
    f"""
SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
    PARTITION BY pickup_at, pickup_zone_id, dropoff_zone_id, fare_amount ORDER BY {_BY_COLUMN})
  AS n FROM {_RESENT}) WHERE n = 1
""",
)
_add(
    "invalid_share_by_weather",
    """
SELECT is_adverse_weather, COUNT(*) AS trips, COUNT(*) FILTER (WHERE NOT is_valid)
  AS invalid_trips, AVG(CASE WHEN is_valid THEN 0 ELSE 1 END) AS invalid_share
FROM stg LEFT JOIN hours w
  ON w.weather_date = CAST(pickup_at AS DATE) AND w.weather_hour = pickup_hour
GROUP BY 1
""",
)

# --- segmentation -----------------------------------------------------------------------------
_SCORES = ", ".join(
    f"(z.{f} - AVG(z.{f}) OVER ()) / STDDEV_SAMP(z.{f}) OVER () AS {f}" for f in FEATURES
)
_add(
    "standardize_features",
    f", scores AS (SELECT pickup_zone_id, {_SCORES} FROM"
    f" ({_ZONE_FEATURES.format(keys='pickup_zone_id')}) z) SELECT pickup_zone_id, "
    + ", ".join(f"ROUND({f}, 6) + 0 AS {f}" for f in FEATURES)
    + " FROM scores",
)


def _distance(a: str, b: str) -> str:
    return "SQRT(" + " + ".join(f"POWER({a}.{f} - {b}.{f}, 2)" for f in FEATURES) + ")"


_add(
    "davies_bouldin",
    f""", scores AS (SELECT pickup_borough, {_SCORES}
  FROM ({_ZONE_FEATURES.format(keys="pickup_zone_id, pickup_borough")}) z),
known AS (SELECT * FROM scores WHERE pickup_borough IS NOT NULL),
centres AS (SELECT pickup_borough, {", ".join(f"AVG({f}) AS {f}" for f in FEATURES)}
  FROM known GROUP BY 1),
scatter AS (SELECT c.pickup_borough, AVG({_distance("k", "c")}) AS s
  FROM known k JOIN centres c USING (pickup_borough) GROUP BY 1),
worst AS (SELECT a.pickup_borough, MAX((sa.s + sb.s) / {_distance("a", "b")}) AS r
  FROM centres a JOIN centres b ON a.pickup_borough <> b.pickup_borough
    JOIN scatter sa ON sa.pickup_borough = a.pickup_borough
    JOIN scatter sb ON sb.pickup_borough = b.pickup_borough GROUP BY 1)
SELECT CAST(COUNT(*) AS INT) AS clusters, ROUND(AVG(r), 6) AS davies_bouldin_index FROM worst
""",
)

_BOROUGH_SCORES = f""", scores AS (SELECT pickup_zone_id, pickup_borough, {_SCORES}
  FROM ({_ZONE_FEATURES.format(keys="pickup_zone_id, pickup_borough")}) z),
known AS (SELECT * FROM scores WHERE pickup_borough IS NOT NULL),
centres AS (SELECT pickup_borough, {", ".join(f"AVG({f}) AS {f}" for f in FEATURES)}
  FROM known GROUP BY 1),
near AS (SELECT k.*, c.pickup_borough AS nearest FROM known k CROSS JOIN centres c
  QUALIFY row_number() OVER (PARTITION BY k.pickup_zone_id, k.pickup_borough
    ORDER BY {_distance("k", "c")}, c.pickup_borough) = 1)
"""
_add("assign_to_centres", _BOROUGH_SCORES + "SELECT pickup_zone_id, pickup_borough, nearest FROM near")
_add(
    "lloyd_step",
    _BOROUGH_SCORES
    + "SELECT nearest, COUNT(*) AS size, "
    + ", ".join(f"ROUND(AVG({f}), 6) + 0 AS {f}" for f in FEATURES)
    + " FROM near GROUP BY 1",
)
_add(
    "centroid_pivot",
    f", z AS ({_ZONE_FEATURES.format(keys='pickup_zone_id')}) "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, "
        + ", ".join(
            f"ROUND(AVG({f}) FILTER (WHERE pickup_zone_id % 4 = {i}), 6) + 0 AS cluster_{i + 1}"
            for i in range(4)
        )
        + " FROM z"
        for f in FEATURES
    ),
)
_add(
    "k_comparison_of_fixed",
    f""", scores AS (SELECT pickup_zone_id, {_SCORES}
  FROM ({_ZONE_FEATURES.format(keys="pickup_zone_id")}) z),
tall AS (SELECT k, pickup_zone_id % k AS c, scores.* FROM scores,
  (VALUES (3), (4), (5), (6)) AS ks(k)),
centres AS (SELECT k, c, {", ".join(f"AVG({f}) AS {f}" for f in FEATURES)} FROM tall GROUP BY 1, 2),
scatter AS (SELECT t.k, t.c, AVG({_distance("t", "m")}) AS s
  FROM tall t JOIN centres m ON t.k = m.k AND t.c = m.c GROUP BY 1, 2),
worst AS (SELECT a.k, a.c, MAX((sa.s + sb.s) / {_distance("a", "b")}) AS r
  FROM centres a JOIN centres b ON a.k = b.k AND a.c <> b.c
    JOIN scatter sa ON sa.k = a.k AND sa.c = a.c
    JOIN scatter sb ON sb.k = b.k AND sb.c = b.c GROUP BY 1, 2),
scored AS (SELECT k, AVG(r) AS i FROM worst GROUP BY 1)
SELECT 'k=' || k AS model, CAST(k AS INT) AS k, ROUND(i, 6) AS davies_bouldin_index,
  CAST(rank() OVER (ORDER BY i) AS INT) AS index_rank,
  ROUND(lag(i) OVER (ORDER BY k) - i, 6) + 0 AS gain FROM scored
""",
)

# --- eager aggregation: the same rows as without it -----------------------------
for _plain in (
    "mart_weather_demand",
    "pickup_flows",
    "adverse_demand_change",
    "revenue_per_active_minute",
    "trip_shape_by_condition",
):
    ORACLE[f"{_plain}_eager"] = ORACLE[_plain]
_add("zone_features_eager", _ZONE_FEATURES.format(keys="pickup_zone_id, pickup_borough"))

# --- streaming ----------------------------------------------------------------------------------
_add(
    "incremental_load",
    "SELECT * FROM fx_green",
)
_add("stream_stage_trips", "SELECT * FROM stg")
_add(
    "stream_hourly_demand",
    """
SELECT hour_start, pickup_zone_id, trip_count, total_revenue, w.weather_category,
  w.is_adverse_weather
FROM (SELECT date_trunc('hour', pickup_at) AS hour_start, pickup_zone_id,
    COUNT(*) AS trip_count, SUM(total_amount) AS total_revenue
  FROM stg WHERE is_valid GROUP BY 1, 2) AS d
LEFT JOIN hours w ON w.datetime_local = d.hour_start
""",
)

# --- checks and pipeline ------------------------------------------------------------------------


def _check(name: str, severity: str, failures: str) -> str:
    status = "warn" if severity == "warn" else "fail"
    return (
        f"SELECT '{name}' AS name, failures, '{severity}' AS severity,"
        f" CASE WHEN failures = 0 THEN 'pass' ELSE '{status}' END AS status"
        f" FROM ({failures})"
    )


def _nulls(table: str, source: str, column: str, severity: str = "error") -> str:
    return _check(
        f"not_null:{table}.{column}",
        severity,
        f"SELECT COUNT(*) AS failures FROM {source} WHERE {column} IS NULL",
    )


def _values(table: str, source: str, column: str, listed: str, severity: str = "error") -> str:
    return _check(
        f"accepted_values:{table}.{column}",
        severity,
        f"SELECT COUNT(*) AS failures FROM {source} WHERE {column} NOT IN ({listed})",
    )


def _unique(table: str, source: str, column: str) -> str:
    return _check(
        f"unique:{table}.{column}",
        "error",
        f"SELECT COUNT(*) AS failures FROM (SELECT {column} FROM {source} GROUP BY {column}"
        " HAVING COUNT(*) > 1)",
    )


def _parent(table: str, source: str) -> str:
    return _check(
        f"relationship:{table}.pickup_zone_id",
        "warn",
        f"SELECT COUNT(*) AS failures FROM {source} LEFT JOIN zones ON"
        " pickup_zone_id = location_id"
        " WHERE pickup_zone_id IS NOT NULL AND location_id IS NULL",
    )


_CATEGORY_LIST = (
    "'Clear', 'Cloudy', 'Fog', 'Drizzle', 'Rain', 'Snow', 'Rain Showers', 'Snow Showers',"
    " 'Thunderstorm', 'Other'"
)
_FEED_LIST = "'yellow', 'green'"
_SUITE = [
    _unique("zone_lookup", "fx_zones", "LocationID"),
    _nulls("zone_lookup", "fx_zones", "LocationID"),
    *[
        _nulls("stg_trips", "stg", c)
        for c in ("taxi_type", "pickup_at", "dropoff_at", "is_valid")
    ],
    _values("stg_trips", "stg", "taxi_type", _FEED_LIST),
    _values("stg_trips", "stg", "payment_type", "1, 2, 3, 4, 5, 6", "warn"),
    _parent("stg_trips", "stg"),
    _unique("stg_zones", "zones", "location_id"),
    *[_nulls("stg_zones", "zones", c) for c in ("location_id", "borough")],
    *[
        _nulls("stg_weather", "hours", c)
        for c in ("weather_date", "weather_hour", "weather_category")
    ],
    _values("stg_weather", "hours", "weather_category", _CATEGORY_LIST),
    *[_nulls("fct_trips", "fct", c) for c in ("pickup_at", "taxi_type", "total_amount")],
    _nulls("fct_trips", "fct", "pickup_borough", "warn"),
    _values("fct_trips", "fct", "taxi_type", _FEED_LIST),
    _parent("fct_trips", "fct"),
    *[
        _nulls("mart_weather_demand", "mart", c)
        for c in ("pickup_borough", "pickup_year", "trip_count", "total_revenue")
    ],
    _unique("dim_zones", "zones", "location_id"),
    *[_nulls("dim_zones", "zones", c) for c in ("location_id", "borough")],
    *[
        _nulls("dim_weather", "hours", c)
        for c in ("weather_date", "weather_hour", "weather_category")
    ],
    _unique("dim_weather", "hours", "weather_date,weather_hour"),
]
_add("expectations_suite", " UNION ALL ".join(_SUITE))
for _kind in ("not_null", "unique", "accepted_values", "relationship"):
    _add(
        f"expect_{_kind}",
        " UNION ALL ".join(
            check
            for check in _SUITE
            if f"'{_kind}:" in check and "weather_date,weather_hour" not in check
        ),
    )
_add(
    "min_row_count",
    f"""
SELECT table_name, row_count, minimum, row_count >= minimum AS passed FROM (
  SELECT *, CAST(CASE table_name WHEN 'yellow_raw' THEN 1000
    WHEN 'green_raw' THEN 1000000000000000000 WHEN 'zone_lookup' THEN 1 ELSE 0 END AS BIGINT)
    AS minimum FROM ({_BRONZE_COUNTS}))
""",
)
_LAYERS = f"""
SELECT 'bronze' AS layer, * FROM ({_BRONZE_COUNTS})
UNION ALL SELECT 'silver', 'stg_trips', COUNT(*) FROM stg
UNION ALL SELECT 'silver', 'stg_zones', COUNT(*) FROM zones
UNION ALL SELECT 'silver', 'stg_weather', COUNT(*) FROM hours
UNION ALL SELECT 'gold', 'fct_trips', COUNT(*) FROM fct
UNION ALL SELECT 'gold', 'mart_weather_demand', COUNT(*) FROM mart
UNION ALL SELECT 'gold', 'dim_zones', COUNT(*) FROM zones
UNION ALL SELECT 'gold', 'dim_weather', COUNT(*) FROM hours
"""
_add("layer_counts", _LAYERS)
_add("run_pipeline", _LAYERS)
_add(
    "expect_unique_of_repeated_trips",
    _check(
        "unique:stg_trips.pickup_at,pickup_zone_id,dropoff_zone_id,fare_amount",
        "warn",
        """SELECT COUNT(*) AS failures FROM (SELECT 1 FROM stg
  WHERE pickup_at IS NOT NULL AND pickup_zone_id IS NOT NULL AND dropoff_zone_id IS NOT NULL
    AND fare_amount IS NOT NULL
  GROUP BY pickup_at, pickup_zone_id, dropoff_zone_id, fare_amount HAVING COUNT(*) > 1)""",
    ),
)
_add(
    "observed_write",
    """
SELECT 'row_count' AS name, COUNT(*) AS failures FROM stg
UNION ALL SELECT 'not_null:stg_trips.taxi_type', COUNT(*) FILTER (WHERE taxi_type IS NULL) FROM stg
UNION ALL SELECT 'not_null:stg_trips.pickup_at', COUNT(*) FILTER (WHERE pickup_at IS NULL) FROM stg
UNION ALL SELECT 'not_null:stg_trips.dropoff_at', COUNT(*) FILTER (WHERE dropoff_at IS NULL)
  FROM stg
UNION ALL SELECT 'not_null:stg_trips.is_valid', COUNT(*) FILTER (WHERE is_valid IS NULL) FROM stg
UNION ALL SELECT 'accepted_values:stg_trips.taxi_type',
  COUNT(*) FILTER (WHERE taxi_type NOT IN ('yellow', 'green')) FROM stg
UNION ALL SELECT 'accepted_values:stg_trips.payment_type',
  COUNT(*) FILTER (WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)) FROM stg
""",
)
