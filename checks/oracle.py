"""SQL counterparts of the registered queries, written for DuckDB.

Each text stands alone over the tables of the star schema. It is built from
SQL's own functions and not from the library, so that it can find its errors.
"""

import re

from pyspark.sql.types import DoubleType, StringType

from skyledger.plans.pipeline import ANALYSES
from skyledger.schema import READINGS_SCHEMA, readings_schema

REGISTRY = """
registry AS (
  SELECT s_suppkey,
         'AQ-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS station_id,
         n_name || '_Station_' || CAST(s_suppkey % 5 + 1 AS VARCHAR) AS station_name,
         n_name AS country,
         n_name || '_' || CAST(s_suppkey % 4 AS VARCHAR) AS city,
         CAST((s_suppkey * 37) % 120 - 60 AS DOUBLE) AS latitude,
         CAST((s_suppkey * 53) % 360 - 180 AS DOUBLE) AS longitude,
         CAST((s_suppkey * 41) % 2500 AS INT) AS elevation_m,
         CASE s_suppkey % 5 WHEN 0 THEN 'Traffic' WHEN 1 THEN 'Industrial' WHEN 2 THEN 'Urban Background'
              WHEN 3 THEN 'Suburban' ELSE 'Rural Background' END AS station_type,
         CAST(45 + (s_nationkey * 11) % 51 AS INT) AS industrial_index,
         CAST(30 + (s_nationkey * 7) % 61 AS INT) AS regulation_score,
         CAST(1993 + s_suppkey % 6 AS INT) AS commissioning_year
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

READINGS = REGISTRY + """,
raw AS (
  SELECT registry.*, lineitem.*,
         l_shipdate + ((l_orderkey * 5 + l_linenumber * 3) % 24) * INTERVAL '1' HOUR AS ts,
         l_extendedprice / 200 AS pm
  FROM lineitem JOIN registry ON l_suppkey = s_suppkey
), cal AS (
  SELECT *, CAST(year(ts) AS INT) AS yr, CAST(month(ts) AS INT) AS mo, CAST(day(ts) AS INT) AS dy,
         CAST(hour(ts) AS INT) AS hr, CAST(isodow(ts) - 1 AS INT) AS dow,
         CAST(floor(CASE WHEN pm <= 12.0e0 THEN pm * 50 / 12
              WHEN pm <= 35.4e0 THEN 50 + (pm - 12) * 50 / 23.4e0
              WHEN pm <= 55.4e0 THEN 100 + (pm - 35.4e0) * 50 / 20
              WHEN pm <= 150.4e0 THEN 150 + (pm - 55.4e0) * 50 / 95
              WHEN pm <= 250.4e0 THEN 200 + (pm - 150.4e0) * 100 / 100
              ELSE 300 + (pm - 250.4e0) * 200 / 250 END) AS INT) AS aqi
  FROM raw
), readings AS (
  SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
             CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
             CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS record_id,
    ts AS timestamp, CAST(ts AS DATE) AS date, yr AS year, mo AS month, dy AS day, hr AS hour,
    dow AS day_of_week, CASE WHEN dow >= 5 THEN 1 ELSE 0 END AS is_weekend,
    station_id, station_name, country, city, latitude, longitude, elevation_m, station_type,
    pm AS PM2_5,
    CASE WHEN l_partkey % 97 <> 0 THEN pm * (1.3e0 + l_discount) END AS PM10,
    l_quantity * 4 AS NO2, l_quantity * (1 + l_tax) AS SO2, l_discount * 50 + 1 AS CO,
    300 - l_quantity * 5 AS O3, l_tax * 50 AS VOC, l_discount * l_tax * 100 AS Lead,
    aqi AS AQI,
    CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate'
         WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN aqi <= 200 THEN 'Unhealthy'
         WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS AQI_category,
    30 - abs(latitude) * 0.5e0 + l_discount * 10 AS temperature_c, 40 + l_quantity AS humidity_pct,
    l_tax * 100 AS wind_speed_mps, CAST((l_partkey * 7) % 360 AS INT) AS wind_direction_deg,
    1013.25e0 - elevation_m * 0.12e0 AS pressure_hpa, l_discount * 5 AS precipitation_mm,
    CAST(industrial_index + l_partkey % 11 - 5 AS DOUBLE) AS industrial_output_index,
    CAST(industrial_index * 2 + l_partkey % 31 AS INT) AS active_factory_count,
    CAST(least(5, greatest(1, floor(regulation_score / 20.0e0) + CASE WHEN yr >= 2000 THEN 1 ELSE 0 END)) AS INT)
      AS emission_standard_level,
    CASE WHEN regulation_score > 65 THEN 1 ELSE 0 END AS has_carbon_tax,
    least(100.0e0, greatest(0.0e0, regulation_score * 0.6e0 + (yr - 1995) * 1.5e0 + l_linenumber)) AS green_energy_pct,
    'Sector_' || lpad(CAST(l_partkey % 15 AS VARCHAR), 2, '0') AS dominant_industry_sector,
    least(100.0e0, greatest(20.0e0, regulation_score * 0.9e0 + l_partkey % 9)) AS regulatory_compliance_rate,
    aqi * 0.5e0 + l_linenumber AS respiratory_cases_per_100k, aqi * 0.2e0 + l_tax * 10 AS cardiovascular_cases_per_100k,
    aqi * 0.08e0 + l_discount * 10 AS hospital_admissions_per_100k, aqi * 0.015e0 + l_tax AS premature_deaths_per_million,
    regulation_score AS regulation_stringency_score,
    CASE WHEN yr IN (1996, 1998, 2000) AND mo = 1 AND dy = 1 AND hr = 0 THEN 1 ELSE 0 END AS policy_change_flag,
    regulation_score * 0.7e0 + (yr - 1995) * 2.5e0 + l_discount AS environmental_investment_index,
    CASE l_returnflag WHEN 'A' THEN 'Valid' WHEN 'R' THEN 'Suspect' ELSE 'Missing_Interpolated' END AS data_quality_flag,
    CASE l_linestatus WHEN 'O' THEN 'Calibrated' ELSE 'Due_Calibration' END AS sensor_calibration_status
  FROM cal
)"""

CLEANED = READINGS + """,
cleaned AS (
  SELECT *,
    CASE WHEN AQI <= 50 THEN 'Low' WHEN AQI <= 100 THEN 'Moderate' WHEN AQI <= 200 THEN 'High' ELSE 'Severe' END
      AS pollution_severity,
    CAST(AQI // 50 * 50 AS VARCHAR) || '-' || CAST(AQI // 50 * 50 + 50 AS VARCHAR) AS aqi_bracket
  FROM readings
  WHERE PM2_5 IS NOT NULL AND PM10 IS NOT NULL AND NO2 IS NOT NULL AND SO2 IS NOT NULL AND CO IS NOT NULL
    AND O3 IS NOT NULL AND AQI IS NOT NULL AND country IS NOT NULL AND city IS NOT NULL AND station_id IS NOT NULL
    AND AQI >= 0 AND AQI <= 500
)"""

ORACLE_SQL: dict[str, str] = {}


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    """A rounded double without negative zero."""
    lift = " * (1 + 1e-13)" if digits <= 6 else ""
    return f"round(CAST({expression} AS DOUBLE){lift}, {digits}) + 0.0e0 AS {name or expression}"


def rs(*names: str, digits: int = 6) -> str:
    return ", ".join(r(n, digits=digits) for n in names)


def raw(name: str, select: str) -> None:
    ORACLE_SQL[name] = f"WITH {READINGS}\n{select.strip()}"


def clean(name: str, select: str) -> None:
    ORACLE_SQL[name] = f"WITH {CLEANED}\n{select.strip()}"


def stations(name: str, select: str) -> None:
    ORACLE_SQL[name] = f"WITH {REGISTRY}\n{select.strip()}"


POLLUTANTS = ["PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "VOC", "Lead"]
HEALTH = ["respiratory_cases_per_100k", "cardiovascular_cases_per_100k", "hospital_admissions_per_100k",
          "premature_deaths_per_million"]
PROFILE = ["PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "industrial_output_index", "regulation_stringency_score",
           "green_energy_pct"]

# --- sources --------------------------------------------------------------------
raw("scan_readings", f"""
SELECT year, count(*) AS row_count, CAST(sum(AQI) AS BIGINT) AS aqi_sum, count(PM10) AS pm10_count,
       min(timestamp) AS first_time, max(date) AS last_date, {r('avg(PM2_5)', 'avg_pm25')}
FROM readings GROUP BY year""")
raw("scan_profile", "SELECT count(*) AS row_count, CAST(49 AS INT) AS column_count FROM readings")
raw("sample_per_part", """
SELECT record_id, year, AQI FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY md5('42' || record_id), record_id) AS rn,
         (SELECT greatest(1000, 21000 // count(DISTINCT year)) FROM readings) AS k FROM readings) WHERE rn <= k""")
raw("head_per_part", """
SELECT record_id, year, timestamp, AQI FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY timestamp, record_id) AS rn FROM readings) WHERE rn <= 2000""")
raw("sample_rows", "SELECT record_id, station_id, AQI FROM readings ORDER BY md5('42' || record_id), record_id LIMIT 5000")
raw("parse_time_columns", "SELECT record_id, timestamp, date FROM readings")

COUNTRY = f"""
SELECT country, {r('avg(AQI)', 'avg_aqi')}, min(AQI) AS min_aqi, max(AQI) AS max_aqi, {r('stddev_samp(AQI)', 'std_aqi')},
       {r('quantile_disc(PM2_5, 0.5)', 'median_pm25')}, {r('avg(PM10)', 'avg_pm10')}, {r('avg(NO2)', 'avg_no2')},
       {r('avg(SO2)', 'avg_so2')}, {r('avg(CO)', 'avg_co')}, {r('avg(O3)', 'avg_o3')}, count(*) AS record_count,
       {r('avg(regulation_stringency_score)', 'regulation_score')},
       {r('avg(industrial_output_index)', 'avg_industrial_output')}, {r('avg(green_energy_pct)', 'avg_green_energy_pct')}
FROM cleaned GROUP BY country"""
CITY = f"""
SELECT city, country, {r('avg(AQI)', 'avg_aqi')}, {r('avg(PM2_5)', 'avg_pm25')}, {r('avg(PM10)', 'avg_pm10')},
       {r('avg(NO2)', 'avg_no2')}, count(DISTINCT station_id) AS station_count, count(*) AS record_count,
       {r('avg(respiratory_cases_per_100k)', 'avg_respiratory_cases')},
       {r('avg(hospital_admissions_per_100k)', 'avg_hospital_admissions')}
FROM cleaned GROUP BY city, country"""
SECTOR = f"""
SELECT dominant_industry_sector AS sector, {r('avg(AQI)', 'avg_aqi')}, {r('avg(PM2_5)', 'avg_pm25')},
       {r('avg(NO2)', 'avg_no2')}, {r('avg(SO2)', 'avg_so2')}, {r('avg(industrial_output_index)', 'avg_industrial_output')},
       {r('avg(regulatory_compliance_rate)', 'avg_compliance_rate')}, count(*) AS record_count
FROM cleaned GROUP BY dominant_industry_sector"""
HEALTH_TABLE = f"""
SELECT aqi_bracket, {r('avg(respiratory_cases_per_100k)', 'avg_respiratory_cases')},
       {r('avg(cardiovascular_cases_per_100k)', 'avg_cardiovascular_cases')},
       {r('avg(hospital_admissions_per_100k)', 'avg_hospital_admissions')},
       {r('avg(premature_deaths_per_million)', 'avg_premature_deaths')}, count(*) AS record_count,
       CAST(min(AQI // 50 * 50) AS INT) AS bracket_low
FROM cleaned GROUP BY aqi_bracket"""

clean("read_result_table", COUNTRY)
raw("dataset_metadata", """
SELECT 'total' AS section, 'records' AS item, count(*) AS records, CAST(NULL AS VARCHAR) AS detail FROM readings
UNION ALL SELECT 'total', 'columns', 49, NULL
UNION ALL SELECT 'total', 'countries', count(DISTINCT country), NULL FROM readings
UNION ALL SELECT 'total', 'cities', count(DISTINCT city), NULL FROM readings
UNION ALL SELECT 'total', 'stations', count(DISTINCT station_id), NULL FROM readings
UNION ALL SELECT 'total', 'start', NULL, CAST(min(date) AS VARCHAR) FROM readings
UNION ALL SELECT 'total', 'end', NULL, CAST(max(date) AS VARCHAR) FROM readings
UNION ALL SELECT 'country', country, count(*), NULL FROM readings GROUP BY country
UNION ALL SELECT 'city', city, count(*), NULL FROM readings GROUP BY city
UNION ALL SELECT 'sector', dominant_industry_sector, count(*), NULL FROM readings GROUP BY dominant_industry_sector
UNION ALL (SELECT 'station', station_id, count(*), NULL FROM readings GROUP BY station_id ORDER BY station_id LIMIT 5)
UNION ALL SELECT 'part', CAST(year AS VARCHAR), count(*), NULL FROM readings GROUP BY year""" + "".join(
    f"\nUNION ALL SELECT 'column', '{f.name}', {i}, '{f.dataType.simpleString()}'"
    for i, f in enumerate(readings_schema(record_id=StringType()), start=1)))
raw("dataset_overview", """
SELECT count(*) AS total_records, count(DISTINCT country) AS countries, count(DISTINCT city) AS cities,
       count(DISTINCT station_id) AS stations, min(date) AS first_date, max(date) AS last_date FROM readings""")

# --- sinks ----------------------------------------------------------------------
clean("write_result", SECTOR)
raw("write_readings", f"SELECT country, count(*) AS row_count, {r('avg(PM10)', 'avg_pm10')} FROM readings GROUP BY country")
CATALOG = """
SELECT 'country_aqi_stats' AS table_name, count(*) AS row_count FROM (SELECT DISTINCT country FROM cleaned)
UNION ALL SELECT 'city_aqi_stats', count(*) FROM (SELECT DISTINCT city, country FROM cleaned)
UNION ALL SELECT 'yearly_trends', count(*) FROM (SELECT DISTINCT year, country FROM cleaned)
UNION ALL SELECT 'sector_impact', count(*) FROM (SELECT DISTINCT dominant_industry_sector FROM cleaned)
UNION ALL SELECT 'policy_effectiveness', count(*) FROM (SELECT DISTINCT country, has_carbon_tax FROM cleaned)
UNION ALL SELECT 'hourly_patterns', count(*) FROM (SELECT DISTINCT hour FROM cleaned)
UNION ALL SELECT 'health_correlations', count(*) FROM (SELECT DISTINCT aqi_bracket FROM cleaned)"""
clean("run_pipeline", CATALOG)
clean("result_catalog", CATALOG)
clean("append_log", f"""
SELECT 'data_cleaning' AS stage, count(*) AS records_processed, 'cleaned_readings' AS output_table FROM cleaned
UNION ALL SELECT table_name, row_count, table_name FROM ({CATALOG})""")
raw("assert_unique_keys", """
SELECT station_id, timestamp, count(*) AS n FROM readings GROUP BY station_id, timestamp HAVING count(*) > 1""")
raw("write_csv_report", f"SELECT dominant_industry_sector, {r('avg(AQI)', 'mean_aqi')} FROM readings GROUP BY dominant_industry_sector")
raw("summary_metrics", """,
means AS (SELECT country, avg(AQI) AS m FROM readings WHERE country IS NOT NULL GROUP BY country),
numbers AS (
  SELECT 'overview' AS section, 'total_records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM readings
  UNION ALL SELECT 'overview', 'countries', count(DISTINCT country) FROM readings
  UNION ALL SELECT 'overview', 'cities', count(DISTINCT city) FROM readings
  UNION ALL SELECT 'overview', 'stations', count(DISTINCT station_id) FROM readings
  UNION ALL SELECT 'findings', 'global_mean_aqi', avg(AQI) FROM readings
  UNION ALL SELECT 'findings', 'industrial_output_correlation', corr(AQI, industrial_output_index) FROM readings
  UNION ALL SELECT 'findings', 'regulation_correlation', corr(AQI, regulation_stringency_score) FROM readings
  UNION ALL SELECT 'findings', 'carbon_tax_reduction_pct',
    (avg(AQI) FILTER (has_carbon_tax = 0) - avg(AQI) FILTER (has_carbon_tax = 1))
    / avg(AQI) FILTER (has_carbon_tax = 0) * 100 FROM readings
), texts AS (
  SELECT 'overview' AS section, 'first_date' AS metric, CAST(min(date) AS VARCHAR) AS text FROM readings
  UNION ALL SELECT 'overview', 'last_date', CAST(max(date) AS VARCHAR) FROM readings
  UNION ALL (SELECT 'findings', 'most_polluted_country', country FROM means ORDER BY m DESC, country LIMIT 1)
  UNION ALL (SELECT 'findings', 'cleanest_country', country FROM means ORDER BY m, country LIMIT 1)
)
SELECT section, metric, round(value, 6) + 0.0e0 AS value, CAST(NULL AS VARCHAR) AS text FROM numbers
UNION ALL SELECT section, metric, CAST(NULL AS DOUBLE), text FROM texts""")

# --- cleaning and derived columns -----------------------------------------------
CRITICAL = " AND ".join(f"{c} IS NOT NULL" for c in
                        ["PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "AQI", "country", "city", "station_id"])
CAST = f"""{rs('PM2_5', 'PM10', 'NO2', 'SO2', 'CO', 'O3', 'industrial_output_index', 'green_energy_pct',
               'regulatory_compliance_rate', digits=8)}, AQI, year, month, hour, regulation_stringency_score, has_carbon_tax"""
raw("drop_incomplete", f"SELECT record_id, country, AQI FROM readings WHERE {CRITICAL}")
raw("cast_columns", f"SELECT record_id, {CAST} FROM readings")
raw("valid_aqi", "SELECT record_id, AQI FROM readings WHERE AQI BETWEEN 0 AND 500")
raw("pollution_severity", """
SELECT record_id, CASE WHEN AQI <= 50 THEN 'Low' WHEN AQI <= 100 THEN 'Moderate' WHEN AQI <= 200 THEN 'High'
                       ELSE 'Severe' END AS pollution_severity FROM readings""")
raw("aqi_bracket", """
SELECT record_id, CAST(AQI // 50 * 50 AS VARCHAR) || '-' || CAST((AQI // 50 + 1) * 50 AS VARCHAR) AS aqi_bracket FROM readings""")
CAST_NAMES = {part.split(" AS ")[-1].strip() for part in re.split(r",(?![^(]*\))", CAST)}
OTHER = [f for f in READINGS_SCHEMA if f.name not in CAST_NAMES]
clean("clean_readings", f"SELECT {CAST}, " + ", ".join(
    r(f.name, digits=8) if isinstance(f.dataType, DoubleType) else f.name for f in OTHER) + ", pollution_severity, aqi_bracket FROM cleaned")
RANGES = {"PM2_5": (2, 500), "PM10": (5, 800), "NO2": (1, 200), "SO2": (0.5, 150), "CO": (0.1, 50), "O3": (5, 300),
          "VOC": (0.01, 5), "Lead": (0, 1.5)}
raw("clamp_pollutants", "SELECT record_id, " + ", ".join(
    r(f"CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END", c, 8) for c, (low, high) in RANGES.items()
) + " FROM readings")
clean("cleaning_audit", """
SELECT a AS initial_count, b AS final_count, a - b AS removed_count
FROM (SELECT count(*) AS a FROM readings), (SELECT count(*) AS b FROM cleaned)""")
raw("traffic_factor", """
SELECT record_id, CAST(CASE WHEN hour IN (7, 8, 9) THEN 1.3 WHEN hour IN (17, 18, 19) THEN 1.2 ELSE 0.8 END AS DOUBLE)
  AS traffic_factor FROM readings""")
raw("aqi_from_pm25", """
SELECT record_id,
  CAST(least(500, greatest(0, round_even(CASE
    WHEN PM2_5 <= 12 THEN PM2_5 * (50 / 12.0e0)
    WHEN PM2_5 <= 35.4e0 THEN 50 + (PM2_5 - 12) * ((100 - 50) / (35.4e0 - 12))
    WHEN PM2_5 <= 55.4e0 THEN 100 + (PM2_5 - 35.4e0) * ((150 - 100) / (55.4e0 - 35.4e0))
    WHEN PM2_5 <= 150.4e0 THEN 150 + (PM2_5 - 55.4e0) * ((200 - 150) / (150.4e0 - 55.4e0))
    WHEN PM2_5 <= 250.4e0 THEN 200 + (PM2_5 - 150.4e0) * ((300 - 200) / (250.4e0 - 150.4e0))
    ELSE 300 + (PM2_5 - 250.4e0) * ((500 - 300) / (500.4e0 - 250.4e0)) END, 0))) AS INT) AS aqi_rounded,
  CAST(least(500, greatest(0, AQI)) AS INT) AS aqi_cut
FROM readings""")
raw("aqi_category", "SELECT record_id, AQI_category AS aqi_category FROM readings")
raw("calendar_features", "SELECT record_id, year, month, day, hour, day_of_week, is_weekend FROM readings")
raw("label_calendar", """
SELECT record_id,
  list_extract(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'], month) AS month_label,
  list_extract(['Mon','Tue','Wed','Thu','Fri','Sat','Sun'], day_of_week + 1) AS dow_label FROM readings""")

MONTHS = "[1.35e0, 1.30e0, 1.15e0, 0.95e0, 0.85e0, 0.80e0, 0.75e0, 0.78e0, 0.88e0, 1.00e0, 1.20e0, 1.40e0]"
HOURS = ("[0.60e0, 0.55e0, 0.50e0, 0.48e0, 0.50e0, 0.58e0, 0.72e0, 0.90e0, 1.15e0, 1.10e0, 1.00e0, 0.95e0, "
         "0.92e0, 0.90e0, 0.88e0, 0.90e0, 0.95e0, 1.10e0, 1.20e0, 1.15e0, 1.05e0, 0.92e0, 0.80e0, 0.70e0]")
WEEKDAYS = "[1.05e0, 1.08e0, 1.08e0, 1.06e0, 1.04e0, 0.88e0, 0.82e0]"
raw("pollution_factor", f"""
SELECT record_id, round((1 + 1e-13) * ((0.5e0 + industrial_index / 100.0e0 * 1.2e0) * (1 - regulation_score / 200.0e0)
  * list_extract({MONTHS}, CASE WHEN readings.latitude < 0 THEN (month + 5) % 12 + 1 ELSE month END)
  * list_extract({HOURS}, hour + 1)
  * (CASE WHEN regulation_score > 70 THEN 1 - (year - 1995) * 0.015e0 ELSE 1 - (year - 1995) * 0.008e0 END)
  * list_extract({WEEKDAYS}, day_of_week + 1)
  * CASE readings.station_type WHEN 'Traffic' THEN 1.3e0 WHEN 'Industrial' THEN 1.5e0 WHEN 'Urban Background' THEN 1.0e0
      WHEN 'Suburban' THEN 0.8e0 WHEN 'Rural Background' THEN 0.5e0 ELSE 1.0e0 END), 6) + 0.0e0 AS pollution_factor
FROM readings JOIN registry USING (station_id)""")
raw("emission_standard", "SELECT record_id, emission_standard_level AS emission_standard FROM readings")
raw("carbon_tax_flag", "SELECT record_id, has_carbon_tax AS carbon_tax FROM readings")
raw("policy_change_flag", "SELECT record_id, policy_change_flag AS policy_change FROM readings")
raw("expected_industry", f"""
SELECT record_id,
  {r(f"industrial_index * list_extract({MONTHS}, month) * (1 + (year - 1995) * 0.01e0)", 'expected_output')},
  {r('industrial_index * 2.5e0', 'expected_factories')},
  {r('least(100, greatest(0, regulation_score * 0.6e0 + (year - 1995) * 1.5e0))', 'expected_green_pct')},
  {r('least(100, greatest(20, regulation_score * 0.9e0))', 'expected_compliance')},
  {r('regulation_score * 0.7e0 + (year - 1995) * 2.5e0', 'expected_investment')}
FROM readings JOIN registry USING (station_id)""")
raw("expected_health", f"""
SELECT record_id, {r('AQI * 0.5e0 * 1.5e0', 'expected_respiratory')}, {r('AQI * 0.2e0 * 1.5e0', 'expected_cardiovascular')},
  {r('AQI * 0.08e0 * 1.5e0', 'expected_admissions')}, {r('AQI * 0.015e0', 'expected_deaths')} FROM readings""")
raw("expected_weather", f"""
SELECT record_id, {r('t', 'expected_temperature')}, {r('least(100, greatest(10, 70 - 0.5e0 * t))', 'expected_humidity')},
  {r('p', 'expected_pressure')}
FROM (SELECT record_id, 30 - 0.5e0 * abs(latitude) + 5 * list_extract({MONTHS}, month) - 5 * cos((hour - 14) * pi() / 12) AS t,
             1013.25e0 - 0.12e0 * elevation_m AS p FROM readings)""")
clean("aqi_badge", """
SELECT country, CASE WHEN avg(AQI) <= 50 THEN 'green' WHEN avg(AQI) <= 100 THEN 'orange' ELSE 'red' END AS aqi_badge
FROM cleaned GROUP BY country""")
clean("regulation_badge", """
SELECT country, CASE WHEN avg(regulation_stringency_score) > 70 THEN 'green'
  WHEN avg(regulation_stringency_score) > 50 THEN 'orange' ELSE 'red' END AS regulation_badge
FROM cleaned GROUP BY country""")


def shown(expression: str, name: str, digits: int = 1) -> str:
    return f"round_even({expression}, {digits}) + 0.0e0 AS {name}"


clean("display_round", f"""
SELECT country, {shown('avg(AQI)', 'avg_aqi')}, {r('stddev_samp(AQI)', 'std_aqi')}, min(AQI) AS min_aqi, max(AQI) AS max_aqi,
  {shown('quantile_disc(PM2_5, 0.5)', 'median_pm25')}, {shown('avg(PM10)', 'avg_pm10')}, {shown('avg(NO2)', 'avg_no2')},
  {shown('avg(SO2)', 'avg_so2')}, {shown('avg(CO)', 'avg_co')}, {shown('avg(O3)', 'avg_o3')}, count(*) AS record_count,
  CAST(round_even(avg(regulation_stringency_score), 0) AS INT) AS regulation_score,
  {shown('avg(industrial_output_index)', 'avg_industrial_output')}, {shown('avg(green_energy_pct)', 'avg_green_energy_pct')}
FROM cleaned GROUP BY country""")

# --- joins and the observation grid ---------------------------------------------
raw("enrich_with_registry", f"""
SELECT station_id, record_id, timestamp, {r('PM2_5')}, registry.station_name, registry.country, registry.city,
  {r('registry.latitude', 'latitude')}, {r('registry.longitude', 'longitude')}, registry.elevation_m, registry.station_type,
  industrial_index, regulation_score, commissioning_year
FROM readings JOIN registry USING (station_id)""")
raw("commissioned_only", """
SELECT record_id, station_id, year FROM readings JOIN registry USING (station_id) WHERE year >= commissioning_year""")
stations("observation_spine", """
SELECT station_id, count(*) AS slots, CAST(sum(hour(t)) AS BIGINT) AS hour_sum, min(t) AS first_slot, max(t) AS last_slot
FROM (SELECT station_id, commissioning_year,
             unnest(generate_series(TIMESTAMP '1995-01-01 00:00:00', TIMESTAMP '2001-12-31 21:00:00', INTERVAL 3 HOUR)) AS t
      FROM registry)
WHERE year(t) >= commissioning_year GROUP BY station_id""")

# --- result tables --------------------------------------------------------------
clean("country_aqi_stats", COUNTRY)
clean("city_aqi_stats", CITY)
clean("yearly_trends", f"""
SELECT year, country, {r('avg(AQI)', 'avg_aqi')}, {r('avg(PM2_5)', 'avg_pm25')},
  {r('avg(industrial_output_index)', 'avg_industrial_output')}, {r('avg(green_energy_pct)', 'avg_green_energy_pct')},
  {r('avg(regulatory_compliance_rate)', 'avg_compliance_rate')}, count(*) AS total_records
FROM cleaned GROUP BY year, country""")
clean("sector_impact", SECTOR)
clean("policy_effectiveness", f"""
SELECT country, has_carbon_tax, {r('avg(AQI)', 'avg_aqi')}, {r('avg(PM2_5)', 'avg_pm25')},
  {r('avg(regulatory_compliance_rate)', 'avg_compliance_rate')}, {r('avg(green_energy_pct)', 'avg_green_energy_pct')},
  count(*) AS record_count
FROM cleaned GROUP BY country, has_carbon_tax""")
clean("hourly_patterns", f"""
SELECT hour, {r('avg(AQI)', 'avg_aqi')}, {r('avg(PM2_5)', 'avg_pm25')}, {r('avg(NO2)', 'avg_no2')}, {r('avg(CO)', 'avg_co')},
  CAST(CASE WHEN hour BETWEEN 7 AND 9 THEN 1.3 WHEN hour BETWEEN 17 AND 19 THEN 1.2 ELSE 0.8 END AS DOUBLE) AS avg_traffic_factor,
  count(*) AS record_count
FROM cleaned GROUP BY hour""")
clean("health_correlations", HEALTH_TABLE)

# --- statistics over raw readings -----------------------------------------------
STATISTICS = {
    "count": "CAST(count({c}) AS DOUBLE)", "mean": "round(avg({c}), 6)", "std": "round(stddev_samp({c}), 6)",
    "min": "round(min({c}), 6)", "max": "round(max({c}), 6)", "25%": "quantile_cont({c}, 0.25)",
    "50%": "quantile_cont({c}, 0.5)", "75%": "quantile_cont({c}, 0.75)",
}
raw("describe_pollutants", "\nUNION ALL ".join(
    f"SELECT '{s}' AS statistic, " + ", ".join(f"round({e.format(c=c)}, 8) + 0.0e0 AS {c}" for c in POLLUTANTS) + " FROM readings"
    for s, e in STATISTICS.items()))


def histogram_sql(column: str, by: str | None, bins: int, groups: str = "") -> str:
    key, using = (f"{by}, ", f"USING ({by})") if by else ("", "")
    join = f"JOIN bounds {using}" if by else "CROSS JOIN bounds"
    return f""",
bounds AS (SELECT {key}CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM readings
           {groups} {f'GROUP BY {by}' if by else ''}),
counts AS (SELECT {key}CAST(least(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin, count(*) AS n
           FROM readings {join} WHERE {column} IS NOT NULL GROUP BY ALL),
edges AS (SELECT bounds.*, CAST(unnest(range({bins})) AS INT) AS bin FROM bounds)
SELECT {key}bin, round(lo + bin * ((hi - lo) / {bins}), 6) + 0.0e0 AS bin_low,
       round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) + 0.0e0 AS bin_high, coalesce(n, 0) AS n
FROM edges LEFT JOIN counts USING ({key}bin)"""


raw("aqi_histogram", histogram_sql("AQI", None, 50))
raw("compliance_histogram", histogram_sql("regulatory_compliance_rate", "country", 30, """
  WHERE country IN (SELECT country FROM (SELECT country, min({'t': timestamp, 'r': record_id}) AS first FROM readings
                    WHERE country IS NOT NULL GROUP BY country) ORDER BY first, country LIMIT 8)"""))
raw("admissions_histogram", histogram_sql("hospital_admissions_per_100k", "AQI_category", 30,
                                          "WHERE AQI_category IN ('Good', 'Moderate', 'Unhealthy', 'Hazardous')"))
raw("category_counts", "SELECT AQI_category, count(*) AS n FROM readings WHERE AQI_category IS NOT NULL GROUP BY AQI_category")
raw("box_stats", "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", {rs('q1', 'median', 'q3', digits=8)},
  {r(f"min({c}) FILTER ({c} >= q1 - 1.5e0 * (q3 - q1))", 'whisker_low', 8)},
  {r(f"max({c}) FILTER ({c} <= q3 + 1.5e0 * (q3 - q1))", 'whisker_high', 8)},
  count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS outliers
FROM readings, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM readings)
GROUP BY q1, median, q3""" for c in POLLUTANTS[:4]))
raw("correlation_matrix", "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0e0 AS corr FROM readings" for a in POLLUTANTS for b in POLLUTANTS))
raw("yearly_aqi_band", """
SELECT year, round(m, 6) AS mean, round(s, 6) AS std, round(m - s, 6) AS band_low, round(m + s, 6) AS band_high
FROM (SELECT year, avg(AQI) AS m, stddev_samp(AQI) AS s FROM readings WHERE year IS NOT NULL GROUP BY year)""")
raw("monthly_aqi", f"""
SELECT month, {r('avg(AQI)', 'mean_aqi')},
  list_extract(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'], month) AS label
FROM readings GROUP BY month""")
raw("hourly_aqi", f"SELECT hour, {r('avg(AQI)', 'mean_aqi')} FROM readings GROUP BY hour")
raw("dow_aqi", f"""
SELECT day_of_week, {r('avg(AQI)', 'mean_aqi')}, list_extract(['Mon','Tue','Wed','Thu','Fri','Sat','Sun'], day_of_week + 1) AS label
FROM readings GROUP BY day_of_week""")
raw("country_aqi_ranking", f"""
SELECT country, {r('m', 'mean_aqi')}, CAST(row_number() OVER (ORDER BY m DESC, country) AS INT) AS position
FROM (SELECT country, avg(AQI) AS m FROM readings WHERE country IS NOT NULL GROUP BY country)""")
raw("top_cities", f"""
SELECT city, {r('m', 'mean_aqi')} FROM (SELECT city, avg(AQI) AS m FROM readings WHERE city IS NOT NULL GROUP BY city)
ORDER BY m DESC, city LIMIT 20""")
raw("sector_aqi", f"SELECT dominant_industry_sector, {r('avg(AQI)', 'mean_aqi')} FROM readings GROUP BY dominant_industry_sector")


def trend_sql(x: str) -> str:
    return f"SELECT regr_slope(AQI, {x}) AS s, regr_intercept(AQI, {x}) AS i, min({x}) AS lo, max({x}) AS hi FROM readings"


for _name, _x in (("industrial_trend", "industrial_output_index"), ("green_energy_trend", "green_energy_pct")):
    raw(_name, f"SELECT {r('s', 'slope')}, {r('i', 'intercept')}, {r('lo', 'x_min')}, {r('hi', 'x_max')} FROM ({trend_sql(_x)})")
raw("trend_line_points", f"""
SELECT CAST(p AS INT) AS point, {r('lo + p * (hi - lo) / 99', 'x')}, {r('i + s * (lo + p * (hi - lo) / 99)', 'y')}
FROM ({trend_sql('industrial_output_index')}), range(100) t(p)""")
raw("trend_line_fixed", f"""
SELECT CAST(p AS INT) AS point, {r('p * 100 / 99.0e0', 'x')}, {r('i + s * (p * 100 / 99.0e0)', 'y')}
FROM ({trend_sql('green_energy_pct')}), range(100) t(p)""")
raw("carbon_tax_aqi", f"""
SELECT has_carbon_tax, CASE has_carbon_tax WHEN 0 THEN 'No Carbon Tax' WHEN 1 THEN 'Has Carbon Tax' END AS label,
  {r('avg(AQI)', 'mean')}, {r('stddev_samp(AQI)', 'std')} FROM readings GROUP BY has_carbon_tax""")
raw("regulation_aqi_means", f"""
SELECT regulation_stringency_score, {r('avg(AQI)', 'mean_aqi')} FROM readings GROUP BY regulation_stringency_score""")
# p-value: Student's t by the finite series for whole degrees of freedom v, its coefficients from the gamma function
raw("regulation_pearson", """,
means AS (SELECT regulation_stringency_score AS x, avg(AQI) AS y FROM readings GROUP BY ALL),
test AS (SELECT corr(y, x) AS r, count(*) AS n FROM means),
terms AS (
  SELECT abs(r) AS s, sqrt(1 - r * r) AS c, n - 2 AS v, unnest(range(n // 2 + 1)) AS j FROM test
), series AS (
  SELECT any_value(s) AS s, any_value(c) AS c, any_value(v) AS v,
    sum(exp(lgamma(j + 0.5e0) - lgamma(j + 1.0e0) - 0.5e0 * ln(pi())) * pow(c, 2 * j)) FILTER (2 * j <= v - 2) AS even_sum,
    sum(exp(lgamma(j + 1.0e0) - lgamma(j + 1.5e0) + 0.5e0 * ln(pi()) - ln(2)) * pow(c, 2 * j + 1)) FILTER (2 * j <= v - 3) AS odd_sum
  FROM terms
)
SELECT round(r, 6) + 0.0e0 AS r, n,
  round(1 - CASE WHEN v % 2 = 0 THEN s * even_sum ELSE 2 / pi() * (asin(s) + s * coalesce(odd_sum, 0)) END, 6) + 0.0e0 AS p_value
FROM test, series""")
raw("emission_standard_pollutants", f"""
SELECT emission_standard_level, {r('avg(PM2_5)', 'mean_pm25')}, {r('avg(NO2)', 'mean_no2')}, {r('avg(SO2)', 'mean_so2')}
FROM readings GROUP BY emission_standard_level""")
raw("investment_trend", f"""
SELECT year, country, {r('avg(environmental_investment_index)', 'mean_investment')} FROM readings
WHERE country IN (SELECT DISTINCT country FROM readings ORDER BY country LIMIT 6) GROUP BY year, country""")
raw("industrial_scatter_sample", f"""
SELECT record_id, {rs('industrial_output_index', 'green_energy_pct')}, AQI FROM
  (SELECT * FROM readings ORDER BY md5('42' || record_id), record_id LIMIT 5000)""")
raw("aqi_respiratory_sample", f"""
SELECT record_id, AQI, {r('respiratory_cases_per_100k')}, regulation_stringency_score FROM
  (SELECT * FROM readings ORDER BY md5('42' || record_id), record_id LIMIT 5000)""")
raw("health_by_country_normalized", ",\nmeans AS (SELECT country, " + ", ".join(f"avg({c}) AS {c}" for c in HEALTH)
    + " FROM readings WHERE country IS NOT NULL GROUP BY country)\nSELECT country, " + ", ".join(
        r(f"({c} - (SELECT min({c}) FROM means)) / nullif((SELECT max({c}) - min({c}) FROM means), 0)", c) for c in HEALTH)
    + " FROM means")
raw("yearly_health", f"""
SELECT year, {r(f'avg({HEALTH[0]})', 'mean_respiratory')}, {r(f'avg({HEALTH[1]})', 'mean_cardiovascular')}
FROM readings GROUP BY year""")
raw("global_mean_aqi", f"SELECT {r('avg(AQI)', 'global_mean_aqi')} FROM readings")
raw("extreme_countries", f""",
means AS (SELECT country, avg(AQI) AS m FROM readings WHERE country IS NOT NULL GROUP BY country)
SELECT (SELECT country FROM means ORDER BY m DESC, country LIMIT 1) AS highest, {r('max(m)', 'highest_mean')},
       (SELECT country FROM means ORDER BY m, country LIMIT 1) AS lowest, {r('min(m)', 'lowest_mean')} FROM means""")
raw("aqi_correlations", f"""
SELECT {r('corr(AQI, industrial_output_index)', 'corr_industrial_output_index_AQI')},
       {r('corr(AQI, regulation_stringency_score)', 'corr_regulation_stringency_score_AQI')} FROM readings""")
raw("carbon_tax_reduction", f"""
SELECT {r('(a - b) / a * 100', 'reduction_pct')} FROM (
  SELECT avg(AQI) FILTER (has_carbon_tax = 0) AS a, avg(AQI) FILTER (has_carbon_tax = 1) AS b FROM readings)""")

# --- reports over result tables -------------------------------------------------
SCORED = f"""folds AS (
  SELECT AQI, PM2_5, substr(md5('42' || record_id), 1, 8) < '33333333' AS held FROM readings
), fit AS (
  SELECT avg(AQI) AS mean, regr_slope(AQI, PM2_5) AS slope, regr_intercept(AQI, PM2_5) AS intercept, count(*) AS n FROM folds WHERE NOT held
), predicted AS (
  SELECT 'FittedLine' AS model_name, 1 AS columns, AQI, AQI - (slope * PM2_5 + intercept) AS e FROM folds, fit WHERE held
  UNION ALL SELECT 'GivenLine', 1, AQI, AQI - (PM2_5 * 1.1e0 + 20) FROM folds WHERE held
  UNION ALL SELECT 'Mean', 0, AQI, AQI - mean FROM folds, fit WHERE held
), scored AS (
  SELECT model_name, round_even(1 - sum(e * e) / (var_pop(AQI) * count(*)), 4) + 0.0e0 AS r2, round_even(sqrt(avg(e * e)), 4) + 0.0e0 AS rmse,
         round_even(avg(abs(e)), 4) + 0.0e0 AS mae, CAST(columns AS INT) AS columns, (SELECT n FROM fit) AS train_size, count(*) AS test_size
  FROM predicted GROUP BY model_name, columns
), best AS (
  SELECT model_name, r2 FROM scored ORDER BY r2 DESC, model_name LIMIT 1
)"""


def scored(name: str, select: str) -> None:
    ORACLE_SQL[name] = f"WITH {CLEANED}, {SCORED}\n{select.strip()}"


scored("overview_cards", """
SELECT count(*) AS total_records, count(DISTINCT country) AS countries, round_even(avg(AQI), 1) AS mean_aqi,
       count(DISTINCT (city, country)) AS cities, (SELECT model_name FROM best) AS best_model, (SELECT r2 FROM best) AS best_r2 FROM cleaned""")
scored("write_tuning_results", """
SELECT model_name, '{"columns":' || columns || '}' AS best_params, r2 AS cv_score, r2 AS test_r2, rmse AS test_rmse, mae AS test_mae,
       0.0e0 AS duration_seconds, columns AS feature_count, train_size, test_size FROM scored""")
scored("model_comparison", """
SELECT model_name, r2 AS test_r2, rmse AS test_rmse, mae AS test_mae, 0.0e0 AS duration_seconds,
       model_name = (SELECT model_name FROM best) AS is_best FROM scored""")
scored("r2_badge", """
SELECT model_name, CASE WHEN r2 >= 0.99 THEN 'green' WHEN r2 >= 0.95 THEN 'blue' ELSE 'orange' END AS r2_badge FROM scored""")
scored("model_ranking", f"""
SELECT CAST(row_number() OVER (ORDER BY r2 DESC, model_name) AS INT) AS position, model_name, r2 AS test_r2,
       CASE WHEN r2 >= 0.99 THEN 'green' WHEN r2 >= 0.95 THEN 'blue' ELSE 'orange' END AS r2_badge,
       rmse AS test_rmse, mae AS test_mae, r2 AS cv_score, 0.0e0 AS duration_seconds FROM scored""")
scored("model_summary", """
SELECT model_name AS section, metric, value, CAST(NULL AS VARCHAR) AS text FROM (
  UNPIVOT (SELECT model_name, r2 AS test_r2, rmse AS test_rmse, mae AS test_mae, r2 AS cv_score, 0.0e0 AS duration_seconds,
                  CAST(columns AS DOUBLE) AS feature_count, CAST(train_size AS DOUBLE) AS train_size, CAST(test_size AS DOUBLE) AS test_size FROM scored)
  ON COLUMNS(* EXCLUDE model_name) INTO NAME metric VALUE value)
UNION ALL SELECT model_name, 'best_params', NULL, '{"columns":' || columns || '}' FROM scored
UNION ALL SELECT 'best', 'best_model', r2, model_name FROM best""")
BADGE = "CASE WHEN a <= 50 THEN 'green' WHEN a <= 100 THEN 'orange' ELSE 'red' END AS aqi_badge"
clean("country_ranking", f"""
SELECT CAST(row_number() OVER (ORDER BY a DESC, country) AS INT) AS position, country, {shown('a', 'avg_aqi')}, {BADGE},
  {shown('med', 'median_pm25')}, {shown('no2', 'avg_no2')}, {shown('so2', 'avg_so2')},
  CAST(round_even(reg, 0) AS INT) AS regulation_score,
  CASE WHEN reg > 70 THEN 'green' WHEN reg > 50 THEN 'orange' ELSE 'red' END AS regulation_badge,
  {shown('green', 'avg_green_energy_pct')}, n AS record_count
FROM (SELECT country, avg(AQI) AS a, quantile_disc(PM2_5, 0.5) AS med, avg(NO2) AS no2, avg(SO2) AS so2,
             avg(regulation_stringency_score) AS reg, avg(green_energy_pct) AS green, count(*) AS n FROM cleaned GROUP BY country)""")
clean("top_city_table", f"""
SELECT CAST(row_number() OVER (ORDER BY a DESC, city, country) AS INT) AS position, city, country, {shown('a', 'avg_aqi')}, {BADGE},
  {shown('pm25', 'avg_pm25')}, {shown('pm10', 'avg_pm10')}, {shown('no2', 'avg_no2')}, station_count,
  {shown('resp', 'avg_respiratory_cases')}
FROM (SELECT city, country, avg(AQI) AS a, avg(PM2_5) AS pm25, avg(PM10) AS pm10, avg(NO2) AS no2,
             count(DISTINCT station_id) AS station_count, avg(respiratory_cases_per_100k) AS resp
      FROM cleaned GROUP BY city, country)
ORDER BY a DESC, city, country LIMIT 20""")
clean("sector_table", f"""
SELECT sector, {shown('a', 'avg_aqi')}, {BADGE}, {shown('pm25', 'avg_pm25')}, {shown('no2', 'avg_no2')}, {shown('so2', 'avg_so2')},
  {shown('ind', 'avg_industrial_output')}, {shown('comp', 'avg_compliance_rate')}, n AS record_count
FROM (SELECT dominant_industry_sector AS sector, avg(AQI) AS a, avg(PM2_5) AS pm25, avg(NO2) AS no2, avg(SO2) AS so2,
             avg(industrial_output_index) AS ind, avg(regulatory_compliance_rate) AS comp, count(*) AS n FROM cleaned GROUP BY ALL)""")
clean("health_table", f"""
SELECT aqi_bracket, CAST(min(AQI // 50 * 50) AS INT) AS bracket_low,
  {shown('avg(respiratory_cases_per_100k)', 'avg_respiratory_cases')},
  {shown('avg(cardiovascular_cases_per_100k)', 'avg_cardiovascular_cases')},
  {shown('avg(hospital_admissions_per_100k)', 'avg_hospital_admissions')},
  {shown('avg(premature_deaths_per_million)', 'avg_premature_deaths', 2)}, count(*) AS record_count
FROM cleaned GROUP BY aqi_bracket""")

raw("part_sketches", """
SELECT CAST(year AS VARCHAR) AS part, count(*) AS row_count, count(PM2_5) AS pm25_count, true AS country_within, true AS city_within, true AS station_id_within
FROM readings GROUP BY year""")
raw("sketch_overview", """
SELECT count(*) AS total_records, true AS country_within, true AS city_within, true AS station_id_within, true AS median_within FROM readings""")
GROUPINGS = {"yearly_trends": "year, country", "sector_impact": "dominant_industry_sector", "policy_effectiveness": "country, has_carbon_tax",
             "hourly_patterns": "hour", "health_correlations": "aqi_bracket"}
clean("cube_means", "\nUNION ALL\n".join(f"""
SELECT '{name}' AS "grouping", concat_ws('|', {keys}) AS group_key, count(*) AS record_count, {r('avg(AQI)', 'mean_aqi')}, {r('stddev_samp(AQI)', 'std_aqi')},
  {r('max(AQI)', 'max_aqi')}, {r('min(AQI)', 'min_aqi')}, {r('avg(PM2_5)', 'mean_pm25')} FROM cleaned GROUP BY {keys}""" for name, keys in GROUPINGS.items()))

# --- machine learning -----------------------------------------------------------
NUMERIC = ["PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "VOC", "Lead", "temperature_c", "humidity_pct", "wind_speed_mps",
           "pressure_hpa", "industrial_output_index", "active_factory_count", "emission_standard_level", "has_carbon_tax",
           "green_energy_pct", "regulatory_compliance_rate", "regulation_stringency_score", "year", "month", "hour",
           "day_of_week", "is_weekend", "latitude", "longitude", "elevation_m"]
CODES = """codes AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INT) AS code
  FROM (SELECT DISTINCT coalesce(station_type, 'nan') AS value FROM readings))"""
raw("ml_features", f",\n{CODES}\nSELECT count(*) AS row_count, " + ", ".join(r(f"avg({c})", f"mean_{c}") for c in NUMERIC)
    + f", {r('avg(code)', 'mean_station_type_enc')}, {r('avg(AQI)', 'mean_AQI')}\n"
    + "FROM readings JOIN codes ON coalesce(station_type, 'nan') = value WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in [*NUMERIC, "AQI"]))
raw("encode_station_type", f",\n{CODES}\nSELECT record_id, station_type, code FROM readings JOIN codes ON coalesce(station_type, 'nan') = value")
TREE_COLUMNS = ["NO2", "temperature_c", "hour"]


def tree_level(number: int) -> str:
    """Best cut of every node of a level, from running sums over the bins."""
    worth = lambda g, n: f"pow(sign({g}) * greatest(abs({g}) - 1, 0), 2) / ({n} + 2)"
    return f"""
cells{number} AS (
  SELECT node, col, bin, count(*) AS n, sum(g) AS g FROM (SELECT node, unnest([0, 1, 2]) AS col, unnest([b0, b1, b2]) AS bin, g FROM nodes{number}) GROUP BY ALL
), sums{number} AS (
  SELECT *, sum(n) OVER upto AS nl, sum(g) OVER upto AS gl, sum(n) OVER whole AS na, sum(g) OVER whole AS ga FROM cells{number}
  WINDOW upto AS (PARTITION BY node, col ORDER BY bin), whole AS (PARTITION BY node, col)
), best{number} AS (
  SELECT node, col, bin, {worth('gl', 'nl')} + {worth('(ga - gl)', '(na - nl)')} - {worth('ga', 'na')} AS gain FROM sums{number}
  WHERE nl >= 3 AND na - nl >= 3 AND na >= 5 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, col, bin) = 1
), nodes{number + 1} AS (
  SELECT 2 * node + 1 + CAST([b0, b1, b2][col + 1] > bin AS INT) AS node, g, b0, b1, b2 FROM nodes{number} JOIN best{number} USING (node)
)"""


# the tree is whole: every node of the first two levels has a cut
raw("gradient_tree", ",\ngiven AS (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS v{i}" for i, c in enumerate(TREE_COLUMNS)) + f""", AQI FROM readings
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*TREE_COLUMNS, 'AQI'])}
), limits AS (
  SELECT {', '.join(f'list_sort(list_distinct(quantile_disc(v{i}, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]))) AS l{i}' for i in range(3))} FROM given
), nodes0 AS (
  SELECT 0 AS node, (SELECT avg(AQI) FROM given) - AQI AS g, {', '.join(f'len(list_filter(l{i}, lambda x: x < v{i})) AS b{i}' for i in range(3))} FROM given, limits
), {tree_level(0)}, {tree_level(1)}
SELECT node, list_extract({TREE_COLUMNS}, col + 1) AS "column", {r('list_extract(list_extract([l0, l1, l2], col + 1), bin + 1)', 'up_to', 4)},
  2 * node + 1 AS "left", 2 * node + 2 AS "right", CAST(NULL AS DOUBLE) AS value, {r('gain', 'gain', 4)}
FROM (SELECT * FROM best0 UNION ALL SELECT * FROM best1), limits
UNION ALL SELECT node, NULL, NULL, NULL, NULL, {r('-sign(sum(g)) * greatest(abs(sum(g)) - 1, 0) / (count(*) + 2) * 0.1e0', 'value', 4)}, NULL FROM nodes2 GROUP BY node""")
raw("train_test_split", """
SELECT CASE WHEN substr(md5('42' || record_id), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS part, station_type,
       count(*) AS n FROM readings GROUP BY ALL""")
raw("regression_metrics", """
SELECT round_even(1 - sum(e * e) / (var_pop(AQI) * count(*)), 4) + 0.0e0 AS r2, round_even(sqrt(avg(e * e)), 4) + 0.0e0 AS rmse,
       round_even(avg(abs(e)), 4) + 0.0e0 AS mae FROM (SELECT AQI, AQI - (PM2_5 * 1.1e0 + 20) AS e FROM readings)""")
PROFILES = "profiles AS (SELECT city, " + ", ".join(f"avg({c}) AS {c}" for c in PROFILE) + """
  FROM readings WHERE city IS NOT NULL GROUP BY city)"""
raw("city_profiles", f",\n{PROFILES}\nSELECT city, {rs(*PROFILE)} FROM profiles")
raw("scale_profiles", f",\n{PROFILES}\nSELECT city, " + ", ".join(
    r(f"({c} - (SELECT avg({c}) FROM profiles)) / (SELECT stddev_pop({c}) FROM profiles)", c) for c in PROFILE) + " FROM profiles")
SCALED = PROFILES + ", scaled AS (SELECT city, [" + ", ".join(
    f"({c} - (SELECT avg({c}) FROM profiles)) / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END FROM profiles)" for c in PROFILE) + """] AS v FROM profiles
)"""
STARTS, CLUSTERS, STEPS = 10, 4, 25


def distance(a: str, b: str) -> str:
    return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, len(PROFILE) + 1))


def lloyd_sql() -> str:
    """Starts by hash, farthest first; then the steps, each a table of centres; the run with the least cost."""
    parts = [f"""first1 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY md5('42' || city), city) - 1 AS INT) AS run, 0 AS i, v AS c FROM scaled QUALIFY run < {STARTS}
)"""]
    for n in range(1, CLUSTERS):
        parts.append(f"""first{n + 1} AS MATERIALIZED (
  SELECT * FROM first{n} UNION ALL
  SELECT run, {n}, v FROM (SELECT run, city, any_value(v) AS v, min({distance('v', 'c')}) AS d FROM scaled, first{n} GROUP BY run, city)
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY d DESC, md5('42' || city) DESC, city DESC) = 1
)""")
    parts.append(f"centres0 AS MATERIALIZED (SELECT * FROM first{CLUSTERS})")
    for n in range(STEPS):
        parts.append(f"""near{n} AS MATERIALIZED (
  SELECT run, city, v, i, d FROM (SELECT run, i, city, v, {distance('v', 'c')} AS d FROM scaled, centres{n})
  QUALIFY row_number() OVER (PARTITION BY run, city ORDER BY d, i) = 1
), centres{n + 1} AS MATERIALIZED (
  SELECT run, i, coalesce(m, c) AS c FROM centres{n} LEFT JOIN (
    SELECT run, i, [{', '.join(f'avg(v[{k}])' for k in range(1, len(PROFILE) + 1))}] AS m FROM near{n} GROUP BY run, i) USING (run, i)
)""")
    last = f"near{STEPS - 1}"
    parts.append(f"""clustered AS (
  SELECT city, CAST(i AS INT) AS cluster FROM {last}
  WHERE run = (SELECT run FROM (SELECT run, round(sum(d), 9) AS cost FROM {last} GROUP BY run) ORDER BY cost, run LIMIT 1)
)""")
    return ",\n".join(parts)


def pca_sql(squarings: int = 14) -> str:
    """Components by squaring the covariance table again and again; the second from what the first leaves."""
    n = len(PROFILE)
    parts = ["cells AS (SELECT city, unnest(range(1, {0})) AS i, unnest(v) AS x FROM scaled)".format(n + 1),
             "cov AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) / (count(*) - 1) AS x FROM cells a JOIN cells b USING (city) GROUP BY a.i, b.i)"]
    for k, start in ((1, "cov"), (2, "rest")):
        if k == 2:
            parts.append("rest AS MATERIALIZED (SELECT cov.i, cov.j, cov.x - l.value * p.x * q.x AS x FROM cov JOIN comp1 p ON p.i = cov.i JOIN comp1 q ON q.i = cov.j, value1 l)")
        before = start
        for s in range(squarings):
            parts.append(f"""pow{k}_{s} AS MATERIALIZED (
  SELECT a.i, b.j, sum(a.x * b.x) / (SELECT sum(x * x) FROM {before}) AS x FROM {before} a JOIN {before} b ON a.j = b.i GROUP BY a.i, b.j)""")
            before = f"pow{k}_{s}"
        parts.append(f"""raw{k} AS MATERIALIZED (
  SELECT i, x / (SELECT sqrt(sum(x * x)) FROM {before} WHERE j = (SELECT i FROM {before} WHERE i = j ORDER BY x DESC, i LIMIT 1)) AS x
  FROM {before} WHERE j = (SELECT i FROM {before} WHERE i = j ORDER BY x DESC, i LIMIT 1)
), comp{k} AS MATERIALIZED (
  SELECT i, x * (SELECT sign(x) FROM raw{k} ORDER BY round(abs(x), 9) DESC, i LIMIT 1) AS x FROM raw{k}
), value{k} AS MATERIALIZED (
  SELECT sum(p.x * cov.x * q.x) AS value FROM cov JOIN comp{k} p ON p.i = cov.i JOIN comp{k} q ON q.i = cov.j
), points{k} AS MATERIALIZED (
  SELECT city, sum(cells.x * p.x) AS pc{k} FROM cells JOIN comp{k} p USING (i) GROUP BY city
)""")
    return ",\n".join(parts)


raw("city_pca", f",\n{SCALED},\n{pca_sql()}\nSELECT city, {rs('pc1', 'pc2')}, " + ", ".join(
    r(f"(SELECT value FROM value{k}) / (SELECT sum(x) FROM cov WHERE i = j)", f"pc{k}_share") for k in (1, 2)) + " FROM points1 JOIN points2 USING (city)")
raw("city_clusters", f",\n{SCALED},\n{lloyd_sql()},\n{pca_sql()}\nSELECT city, {rs(*PROFILE)}, cluster, {rs('pc1', 'pc2')} "
    "FROM profiles JOIN clustered USING (city) JOIN points1 USING (city) JOIN points2 USING (city)")
# a WITH list that is continued must not carry the blank between its parts
ORACLE_SQL.update({name: sql.replace(")\n,", "),") for name, sql in ORACLE_SQL.items()})
ORACLE_SQL["cluster_examples"] = f"WITH {READINGS}," + f"""
{SCALED},\n{lloyd_sql()}
SELECT city, cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY city) AS INT) AS place FROM clustered QUALIFY place <= 5"""
# three models; 15 of the 28 columns of each; per model eight figures and its parameters, and the best one's name
MODEL_ROWS = {"model_tuning_results": 3, "feature_importance": 3 * 15, "model_comparison": 3, "model_summary": 3 * 9 + 1}
STORED = {name: ORACLE_SQL[{"descriptive_statistics": "describe_pollutants", "green_energy_line_points": "trend_line_points"}.get(name, name)]
          for name in ANALYSES}
STORED |= {"city_profiles": ORACLE_SQL["city_profiles"], "city_clusters": ORACLE_SQL["city_profiles"]}  # one row per city in both
EXAMPLES = ORACLE_SQL["cluster_examples"]
ANALYSED = "\n".join(f"UNION ALL SELECT '{name}', count(*) FROM ({sql})" for name, sql in STORED.items())
MODELLED = "\n".join(f"UNION ALL SELECT '{name}', {n}" for name, n in MODEL_ROWS.items())
ORACLE_SQL["run_pipeline"] = f"{ORACLE_SQL['result_catalog']}\n{ANALYSED}\nUNION ALL SELECT 'cluster_examples', count(*) FROM ({EXAMPLES})\n{MODELLED}"
LOGGED = "\n".join(f"UNION ALL SELECT '{name}', count(*), '{name}' FROM ({sql})" for name, sql in STORED.items())
LOGGED += f"\nUNION ALL SELECT 'city_clusters', count(*), 'cluster_examples' FROM ({EXAMPLES})\n"
LOGGED += "\n".join(f"UNION ALL SELECT 'model_tuning', {n}, '{name}'" for name, n in MODEL_ROWS.items())
ORACLE_SQL["append_log"] = ORACLE_SQL["log_table"] = f"{ORACLE_SQL['append_log']}\n{LOGGED}"
