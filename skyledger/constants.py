"""Categories, breakpoints, factors and ranges the results depend on.

Everything here is data, not logic. The values are part of the contract: a
different number gives a different result table.
"""

# --- fixed values: cleaning -------------------------------------------------
CRITICAL_COLUMNS = ["PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "AQI", "country", "city", "station_id"]

CAST_TO_DOUBLE = [
    "PM2_5", "PM10", "NO2", "SO2", "CO", "O3",
    "industrial_output_index", "green_energy_pct", "regulatory_compliance_rate",
]
CAST_TO_INT = ["AQI", "year", "month", "hour", "regulation_stringency_score", "has_carbon_tax"]

AQI_MIN, AQI_MAX = 0, 500
AQI_BRACKET_WIDTH = 50

# upper bound (inclusive) -> label; anything above the last bound is the fallback
SEVERITY_BOUNDS = [(50, "Low"), (100, "Moderate"), (200, "High")]
SEVERITY_ABOVE = "Severe"

CATEGORY_BOUNDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
CATEGORY_ABOVE = "Hazardous"

# --- fixed values: PM2.5 breakpoints of the index ----------------------------
# (concentration, index) corner points, joined by straight lines
PM25_CORNERS = [(0.0, 0), (12.0, 50), (35.4, 100), (55.4, 150), (150.4, 200), (250.4, 300), (500.4, 500)]

# --- fixed values: plausible pollutant ranges --------------------------------
POLLUTANT_RANGES = {
    "PM2_5": (2.0, 500.0),
    "PM10": (5.0, 800.0),
    "NO2": (1.0, 200.0),
    "SO2": (0.5, 150.0),
    "CO": (0.1, 50.0),
    "O3": (5.0, 300.0),
    "VOC": (0.01, 5.0),
    "Lead": (0.0, 1.5),
}
POLLUTANTS = ["PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "VOC", "Lead"]

# --- fixed values: multiplicative factors ------------------------------------
MONTH_FACTOR = {
    1: 1.35, 2: 1.30, 3: 1.15, 4: 0.95, 5: 0.85, 6: 0.80,
    7: 0.75, 8: 0.78, 9: 0.88, 10: 1.00, 11: 1.20, 12: 1.40,
}
HOUR_FACTOR = {
    0: 0.60, 1: 0.55, 2: 0.50, 3: 0.48, 4: 0.50, 5: 0.58,
    6: 0.72, 7: 0.90, 8: 1.15, 9: 1.10, 10: 1.00, 11: 0.95,
    12: 0.92, 13: 0.90, 14: 0.88, 15: 0.90, 16: 0.95, 17: 1.10,
    18: 1.20, 19: 1.15, 20: 1.05, 21: 0.92, 22: 0.80, 23: 0.70,
}
WEEKDAY_FACTOR = {0: 1.05, 1: 1.08, 2: 1.08, 3: 1.06, 4: 1.04, 5: 0.88, 6: 0.82}
STATION_TYPE_FACTOR = {
    "Traffic": 1.3, "Industrial": 1.5, "Urban Background": 1.0, "Suburban": 0.8, "Rural Background": 0.5,
}
TRAFFIC_MORNING, TRAFFIC_EVENING = (7, 9, 1.3), (17, 19, 1.2)
TRAFFIC_OTHER = 0.8
START_YEAR = 2015
EMISSION_CUTOVER_YEAR = 2020
POLICY_CHANGE_YEARS = [2016, 2018, 2020, 2022, 2024]
CARBON_TAX_SCORE = 65

# --- fixed values: labels ----------------------------------------------------
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAY_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
CARBON_TAX_LABELS = {0: "No Carbon Tax", 1: "Has Carbon Tax"}

# --- fixed values: column sets of the analyses -------------------------------
HEALTH_COLUMNS = [
    "respiratory_cases_per_100k", "cardiovascular_cases_per_100k",
    "hospital_admissions_per_100k", "premature_deaths_per_million",
]
PROFILE_COLUMNS = [
    "PM2_5", "PM10", "NO2", "SO2", "CO", "O3",
    "industrial_output_index", "regulation_stringency_score", "green_energy_pct",
]
FEATURE_COLUMNS = [
    "PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "VOC", "Lead",
    "temperature_c", "humidity_pct", "wind_speed_mps", "pressure_hpa",
    "industrial_output_index", "active_factory_count",
    "emission_standard_level", "has_carbon_tax", "green_energy_pct",
    "regulatory_compliance_rate", "regulation_stringency_score",
    "year", "month", "hour", "day_of_week", "is_weekend",
    "latitude", "longitude", "elevation_m",
]
ADMISSION_CATEGORIES = ["Good", "Moderate", "Unhealthy", "Hazardous"]

# --- fixed values: primary keys of the result tables -------------------------
RESULT_KEYS = {
    "country_aqi_stats": ["country"],
    "city_aqi_stats": ["city", "country"],
    "yearly_trends": ["year", "country"],
    "sector_impact": ["sector"],
    "policy_effectiveness": ["country", "has_carbon_tax"],
    "hourly_patterns": ["hour"],
    "health_correlations": ["aqi_bracket"],
    "model_tuning_results": ["model_name"],
}
