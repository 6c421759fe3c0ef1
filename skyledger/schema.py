"""Declared schema of the readings table (49 columns).

Declaring it saves the extra full pass that schema inference costs.
"""

from pyspark.sql.types import (
    DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

# fixed values: column order and type of the source files
READINGS_SCHEMA = StructType([
    StructField("record_id", LongType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("date", DateType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("hour", IntegerType()),
    StructField("day_of_week", IntegerType()),
    StructField("is_weekend", IntegerType()),
    StructField("station_id", StringType()),
    StructField("station_name", StringType()),
    StructField("country", StringType()),
    StructField("city", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("elevation_m", IntegerType()),
    StructField("station_type", StringType()),
    StructField("PM2_5", DoubleType()),
    StructField("PM10", DoubleType()),
    StructField("NO2", DoubleType()),
    StructField("SO2", DoubleType()),
    StructField("CO", DoubleType()),
    StructField("O3", DoubleType()),
    StructField("VOC", DoubleType()),
    StructField("Lead", DoubleType()),
    StructField("AQI", IntegerType()),
    StructField("AQI_category", StringType()),
    StructField("temperature_c", DoubleType()),
    StructField("humidity_pct", DoubleType()),
    StructField("wind_speed_mps", DoubleType()),
    StructField("wind_direction_deg", IntegerType()),
    StructField("pressure_hpa", DoubleType()),
    StructField("precipitation_mm", DoubleType()),
    StructField("industrial_output_index", DoubleType()),
    StructField("active_factory_count", IntegerType()),
    StructField("emission_standard_level", IntegerType()),
    StructField("has_carbon_tax", IntegerType()),
    StructField("green_energy_pct", DoubleType()),
    StructField("dominant_industry_sector", StringType()),
    StructField("regulatory_compliance_rate", DoubleType()),
    StructField("respiratory_cases_per_100k", DoubleType()),
    StructField("cardiovascular_cases_per_100k", DoubleType()),
    StructField("hospital_admissions_per_100k", DoubleType()),
    StructField("premature_deaths_per_million", DoubleType()),
    StructField("regulation_stringency_score", IntegerType()),
    StructField("policy_change_flag", IntegerType()),
    StructField("environmental_investment_index", DoubleType()),
    StructField("data_quality_flag", StringType()),
    StructField("sensor_calibration_status", StringType()),
])
READINGS_COLUMNS = READINGS_SCHEMA.fieldNames()


def readings_schema(**overrides: DataType) -> StructType:
    """The readings schema; a keyword replaces one column's type, e.g. ``record_id=StringType()``."""
    return StructType([StructField(f.name, overrides.get(f.name, f.dataType)) for f in READINGS_SCHEMA])
