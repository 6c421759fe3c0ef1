"""Readings and station registry derived from a star schema.

``lineitem`` rows become readings, ``supplier`` rows stations and ``nation``
rows countries, with all 49 reading columns. Used to run every operator on
tables that exist in another shape.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


# fixed values: the first year of the data and the two settings that depend on it
FIRST_YEAR = 1995
CUTOVER_YEAR = 2000
CHANGE_YEARS = (1996, 1998, 2000)

_STATION = """
    s_suppkey
    'AQ-' || lpad(CAST(s_suppkey AS STRING), 6, '0') AS station_id
    n_name || '_Station_' || CAST(s_suppkey % 5 + 1 AS STRING) AS station_name
    n_name AS country
    n_name || '_' || CAST(s_suppkey % 4 AS STRING) AS city
    CAST((s_suppkey * 37) % 120 - 60 AS DOUBLE) AS latitude
    CAST((s_suppkey * 53) % 360 - 180 AS DOUBLE) AS longitude
    CAST((s_suppkey * 41) % 2500 AS INT) AS elevation_m
    CASE s_suppkey % 5 WHEN 0 THEN 'Traffic' WHEN 1 THEN 'Industrial' WHEN 2 THEN 'Urban Background' WHEN 3 THEN 'Suburban' ELSE 'Rural Background' END AS station_type
    CAST(45 + (s_nationkey * 11) % 51 AS INT) AS industrial_index
    CAST(30 + (s_nationkey * 7) % 61 AS INT) AS regulation_score
    CAST(1993 + s_suppkey % 6 AS INT) AS commissioning_year
"""

_MEASURED = """
    l_shipdate + ((l_orderkey * 5 + l_linenumber * 3) % 24) * INTERVAL '1' HOUR AS ts
    l_extendedprice / 200 AS pm
"""

_CALENDAR = """
    year(ts) AS yr
    month(ts) AS mo
    day(ts) AS dy
    hour(ts) AS hr
    weekday(ts) AS dow
    CAST(floor(CASE WHEN pm <= 12.0e0 THEN pm * 50 / 12 WHEN pm <= 35.4e0 THEN 50 + (pm - 12) * 50 / 23.4e0 WHEN pm <= 55.4e0 THEN 100 + (pm - 35.4e0) * 50 / 20 WHEN pm <= 150.4e0 THEN 150 + (pm - 55.4e0) * 50 / 95 WHEN pm <= 250.4e0 THEN 200 + (pm - 150.4e0) * 100 / 100 ELSE 300 + (pm - 250.4e0) * 200 / 250 END) AS INT) AS aqi
"""

_READING = """
    md5(concat_ws('|', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(CAST(l_quantity AS BIGINT) AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING))) AS record_id
    ts AS timestamp
    CAST(ts AS DATE) AS date
    yr AS year
    mo AS month
    dy AS day
    hr AS hour
    dow AS day_of_week
    CASE WHEN dow >= 5 THEN 1 ELSE 0 END AS is_weekend
    station_id
    station_name
    country
    city
    latitude
    longitude
    elevation_m
    station_type
    pm AS PM2_5
    CASE WHEN l_partkey % 97 <> 0 THEN pm * (1.3e0 + l_discount) END AS PM10
    l_quantity * 4 AS NO2
    l_quantity * (1 + l_tax) AS SO2
    l_discount * 50 + 1 AS CO
    300 - l_quantity * 5 AS O3
    l_tax * 50 AS VOC
    l_discount * l_tax * 100 AS Lead
    aqi AS AQI
    CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate' WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN aqi <= 200 THEN 'Unhealthy' WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS AQI_category
    30 - abs(latitude) * 0.5e0 + l_discount * 10 AS temperature_c
    40 + l_quantity AS humidity_pct
    l_tax * 100 AS wind_speed_mps
    CAST((l_partkey * 7) % 360 AS INT) AS wind_direction_deg
    1013.25e0 - elevation_m * 0.12e0 AS pressure_hpa
    l_discount * 5 AS precipitation_mm
    CAST(industrial_index + l_partkey % 11 - 5 AS DOUBLE) AS industrial_output_index
    CAST(industrial_index * 2 + l_partkey % 31 AS INT) AS active_factory_count
    CAST(least(5, greatest(1, floor(regulation_score / 20.0e0) + CASE WHEN yr >= 2000 THEN 1 ELSE 0 END)) AS INT) AS emission_standard_level
    CASE WHEN regulation_score > 65 THEN 1 ELSE 0 END AS has_carbon_tax
    least(100.0e0, greatest(0.0e0, regulation_score * 0.6e0 + (yr - 1995) * 1.5e0 + l_linenumber)) AS green_energy_pct
    'Sector_' || lpad(CAST(l_partkey % 15 AS STRING), 2, '0') AS dominant_industry_sector
    least(100.0e0, greatest(20.0e0, regulation_score * 0.9e0 + l_partkey % 9)) AS regulatory_compliance_rate
    aqi * 0.5e0 + l_linenumber AS respiratory_cases_per_100k
    aqi * 0.2e0 + l_tax * 10 AS cardiovascular_cases_per_100k
    aqi * 0.08e0 + l_discount * 10 AS hospital_admissions_per_100k
    aqi * 0.015e0 + l_tax AS premature_deaths_per_million
    regulation_score AS regulation_stringency_score
    CASE WHEN yr IN (1996, 1998, 2000) AND mo = 1 AND dy = 1 AND hr = 0 THEN 1 ELSE 0 END AS policy_change_flag
    regulation_score * 0.7e0 + (yr - 1995) * 2.5e0 + l_discount AS environmental_investment_index
    CASE l_returnflag WHEN 'A' THEN 'Valid' WHEN 'R' THEN 'Suspect' ELSE 'Missing_Interpolated' END AS data_quality_flag
    CASE l_linestatus WHEN 'O' THEN 'Calibrated' ELSE 'Due_Calibration' END AS sensor_calibration_status
"""


def _items(block: str) -> list[str]:
    return [line.strip() for line in block.strip().splitlines()]


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Station registry: one row per supplier, plus the supplier key as ``s_suppkey``."""
    supplier = spark.read.parquet(f"{folder}/supplier.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(*_items(_STATION))


def with_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the columns of the registry.

    The two small tables are joined one after the other: Spark knows the size of
    a file, but takes a join of both for their product, and would then send the
    line items to the registry.
    """
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    supplier = spark.read.parquet(f"{folder}/supplier.parquet").select("s_suppkey", "s_nationkey")
    nation = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_name")
    joined = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(*lineitem.columns, *_items(_STATION))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """The 49-column readings table over the star schema in ``folder``."""
    return (
        with_stations(spark, folder)
        .selectExpr("*", *_items(_MEASURED))
        .selectExpr("*", *_items(_CALENDAR))
        .selectExpr(*_items(_READING))
    )


def bare_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings without station attributes (id, time, station, PM2.5), to be joined with a registry."""
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    record_id = next(item for item in _items(_READING) if item.endswith(" AS record_id"))
    return lineitem.selectExpr(
        record_id,
        "'AQ-' || lpad(CAST(l_suppkey AS STRING), 6, '0') AS station_id",
        next(item for item in _items(_MEASURED) if item.endswith(" AS ts")).replace(" AS ts", " AS timestamp"),
        "l_extendedprice / 200 AS PM2_5",
    )
