"""The seven stored result tables, each one group-by over cleaned readings.

Every aggregate is combined inside the map tasks before its shuffle, so what
crosses the network grows with the number of groups, not with the readings,
and a group that holds a third of all rows costs nothing extra.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.functions.aqi import bracket_start
from skyledger.functions.derive import traffic_factor

MEDIAN_ACCURACY = 10_000


def group_profile(c: DataFrame, keys: list[str], averages: dict[str, str], *others: Column,
                  count: str = "record_count") -> DataFrame:
    """Averages (output name -> input column), further aggregates and a row count per group."""
    means = [F.avg(source).alias(name) for name, source in averages.items()]
    return c.groupBy(*keys).agg(*means, *others, F.count("*").alias(count))


def country_aqi_stats(c: DataFrame, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    return group_profile(
        c, ["country"],
        {
            "avg_aqi": "AQI", "avg_pm10": "PM10", "avg_no2": "NO2", "avg_so2": "SO2", "avg_co": "CO", "avg_o3": "O3",
            "regulation_score": "regulation_stringency_score",
            "avg_industrial_output": "industrial_output_index",
            "avg_green_energy_pct": "green_energy_pct",
        },
        F.min("AQI").alias("min_aqi"),
        F.max("AQI").alias("max_aqi"),
        F.stddev("AQI").alias("std_aqi"),
        F.percentile_approx("PM2_5", 0.5, accuracy).alias("median_pm25"),
    ).select(
        "country", "avg_aqi", "min_aqi", "max_aqi", "std_aqi", "median_pm25", "avg_pm10", "avg_no2", "avg_so2",
        "avg_co", "avg_o3", "record_count", "regulation_score", "avg_industrial_output", "avg_green_energy_pct",
    )


def city_aqi_stats(c: DataFrame, approx_stations: bool = False) -> DataFrame:
    """Per city; the exact station count is taken over rows already reduced to one per station and task."""
    distinct = F.approx_count_distinct("station_id") if approx_stations else F.countDistinct("station_id")
    return group_profile(
        c, ["city", "country"],
        {
            "avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_pm10": "PM10", "avg_no2": "NO2",
            "avg_respiratory_cases": "respiratory_cases_per_100k",
            "avg_hospital_admissions": "hospital_admissions_per_100k",
        },
        distinct.alias("station_count"),
    ).select(
        "city", "country", "avg_aqi", "avg_pm25", "avg_pm10", "avg_no2", "station_count", "record_count",
        "avg_respiratory_cases", "avg_hospital_admissions",
    )


def yearly_trends(c: DataFrame) -> DataFrame:
    return group_profile(
        c, ["year", "country"],
        {
            "avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_industrial_output": "industrial_output_index",
            "avg_green_energy_pct": "green_energy_pct", "avg_compliance_rate": "regulatory_compliance_rate",
        },
        count="total_records",
    )


def sector_impact(c: DataFrame) -> DataFrame:
    return group_profile(
        c.withColumnRenamed("dominant_industry_sector", "sector"), ["sector"],
        {
            "avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_no2": "NO2", "avg_so2": "SO2",
            "avg_industrial_output": "industrial_output_index", "avg_compliance_rate": "regulatory_compliance_rate",
        },
    )


def policy_effectiveness(c: DataFrame) -> DataFrame:
    return group_profile(
        c, ["country", "has_carbon_tax"],
        {
            "avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_compliance_rate": "regulatory_compliance_rate",
            "avg_green_energy_pct": "green_energy_pct",
        },
    )


def hourly_patterns(c: DataFrame) -> DataFrame:
    means = group_profile(c, ["hour"], {"avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_no2": "NO2", "avg_co": "CO"})
    return means.withColumn("avg_traffic_factor", traffic_factor("hour")).select(
        "hour", "avg_aqi", "avg_pm25", "avg_no2", "avg_co", "avg_traffic_factor", "record_count"
    )


def health_correlations(c: DataFrame) -> DataFrame:
    """Per index bracket; ``bracket_low`` orders the brackets as numbers."""
    means = group_profile(
        c, ["aqi_bracket"],
        {
            "avg_respiratory_cases": "respiratory_cases_per_100k",
            "avg_cardiovascular_cases": "cardiovascular_cases_per_100k",
            "avg_hospital_admissions": "hospital_admissions_per_100k",
            "avg_premature_deaths": "premature_deaths_per_million",
        },
    )
    return means.withColumn("bracket_low", bracket_start("aqi_bracket"))


RESULT_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "country_aqi_stats": country_aqi_stats,
    "city_aqi_stats": city_aqi_stats,
    "yearly_trends": yearly_trends,
    "sector_impact": sector_impact,
    "policy_effectiveness": policy_effectiveness,
    "hourly_patterns": hourly_patterns,
    "health_correlations": health_correlations,
}

# how each table is read back: column and direction
RESULT_ORDER = {
    "country_aqi_stats": [("avg_aqi", False)],
    "city_aqi_stats": [("avg_aqi", False)],
    "yearly_trends": [("country", True), ("year", True)],
    "sector_impact": [("avg_aqi", False)],
    "policy_effectiveness": [("country", True), ("has_carbon_tax", True)],
    "hourly_patterns": [("hour", True)],
    "health_correlations": [("aqi_bracket", True)],
    "processing_log": [("id", True)],
    "model_tuning_results": [("test_r2", False)],
}
