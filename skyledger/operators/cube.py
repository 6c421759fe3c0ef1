"""Partial aggregates of many groupings from one scan, and the tables rolled up from them.

A cube has one row per group of every grouping: the grouping's name, the values
of its keys, the number of rows, and for each measure how many values there are,
their sum and sum of squares about the measure's pivot, the smallest and the
largest. Such rows add up, so cubes of parts of the readings make the cube of
all (``merge``), and every mean and deviation follows from them.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.functions.aqi import bracket_start
from skyledger.functions.derive import carbon_tax_label, dow_label, month_label, traffic_factor
from skyledger.functions.numeric import nan_to_null

# groupings of the result tables (over cleaned readings) and of the analyses (over raw ones)
TABLE_GROUPINGS: dict[str, list[str]] = {
    "yearly_trends": ["year", "country"], "sector_impact": ["dominant_industry_sector"], "policy_effectiveness": ["country", "has_carbon_tax"],
    "hourly_patterns": ["hour"], "health_correlations": ["aqi_bracket"],
}
ANALYSIS_GROUPINGS: dict[str, list[str]] = {
    "yearly_aqi_band": ["year"], "monthly_aqi": ["month"], "hourly_aqi": ["hour"], "dow_aqi": ["day_of_week"], "country_aqi_ranking": ["country"],
    "sector_aqi": ["dominant_industry_sector"], "carbon_tax_aqi": ["has_carbon_tax"], "regulation_aqi_means": ["regulation_stringency_score"],
    "emission_standard_pollutants": ["emission_standard_level"],
}
TABLE_MEASURES = [
    "AQI", "PM2_5", "NO2", "SO2", "CO", "industrial_output_index", "green_energy_pct", "regulatory_compliance_rate", "respiratory_cases_per_100k",
    "cardiovascular_cases_per_100k", "hospital_admissions_per_100k", "premature_deaths_per_million",
]
ANALYSIS_MEASURES = ["AQI", "PM2_5", "NO2", "SO2"]
SPREAD = ("AQI",)
# squares are summed about this value, which takes the edge off their cancellation; any value gives the same deviation
PIVOT = 100.0


def cube(r: DataFrame, groupings: dict[str, list[str]], measures: list[str], nan_is_missing: bool = True, spread: tuple[str, ...] = SPREAD) -> DataFrame:
    """All groupings in one scan: rows are opened to the groupings and combined map-side, so only groups are shuffled."""
    keys = list(dict.fromkeys(k for own in groupings.values() for k in own))
    sets = [[F.col(k) for k in own] for own in groupings.values()]
    value = lambda m: nan_to_null(F.col(m).cast("double")) if nan_is_missing else F.col(m).cast("double")
    sums = [c for m in measures for c in (F.count(value(m)).alias(f"{m}_n"), F.sum(value(m)).alias(f"{m}_sum"))]
    sums += [c for m in spread for c in (
        F.sum((value(m) - PIVOT) * (value(m) - PIVOT)).alias(f"{m}_squares"), F.min(value(m)).alias(f"{m}_min"), F.max(value(m)).alias(f"{m}_max"))]
    # the id has a bit per key, set where a grouping leaves the key out
    ids = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own): name for name, own in groupings.items()}
    rows = r.select(*keys, *[m for m in measures if m not in keys]).groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("_id"), F.count("*").alias("n"), *sums)
    name = F.coalesce(*[F.when(F.col("_id") == i, n) for i, n in ids.items()])
    return rows.select(name.alias("grouping"), *keys, "n", *[f"{m}_{s}" for m in measures for s in ("n", "sum")], *[f"{m}_{s}" for m in spread for s in ("squares", "min", "max")])


def merge(cubes: list[DataFrame]) -> DataFrame:
    """The cube of all parts from the cubes of the parts."""
    rows = reduce(DataFrame.unionByName, cubes)
    added = [c for c in rows.columns if c == "n" or c.endswith(("_n", "_sum", "_squares"))]
    ends = [c for c in rows.columns if c.endswith(("_min", "_max"))]
    keys = [c for c in rows.columns if c not in added and c not in ends]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in added], *[(F.min if c.endswith("_min") else F.max)(c).alias(c) for c in ends]).select(*rows.columns)


def mean(measure: str) -> Column:
    return F.try_divide(F.col(f"{measure}_sum"), F.col(f"{measure}_n"))


def deviation(measure: str) -> Column:
    """Sample deviation; NULL for a single value."""
    n, off = F.col(f"{measure}_n"), F.col(f"{measure}_sum") - PIVOT * F.col(f"{measure}_n")
    return F.sqrt(F.greatest(F.try_divide(F.col(f"{measure}_squares") - F.try_divide(off * off, n), n - 1), F.lit(0.0)))


def _group(name: str, means: dict[str, str], count: str | None = "record_count", keys: dict[str, str] | None = None) -> Callable[[DataFrame], DataFrame]:
    """Rows of one grouping with means (output name -> measure); ``keys`` renames keys. Without a count, rows with a NULL key are left out."""
    def build(c: DataFrame) -> DataFrame:
        own = {**TABLE_GROUPINGS, **ANALYSIS_GROUPINGS}[name]
        rows = c.where(F.col("grouping") == name)
        rows = rows if count else rows.dropna(subset=own)
        return rows.select(*[F.col(k).alias((keys or {}).get(k, k)) for k in own], *[mean(m).alias(out) for out, m in means.items()], *([F.col("n").alias(count)] if count else []))
    return build


def _with(build: Callable[[DataFrame], DataFrame], name: str, column: Callable[[], Column], order: list[str] | None = None) -> Callable[[DataFrame], DataFrame]:
    return lambda c: (lambda df: df.select(*order) if order else df)(build(c).withColumn(name, column()))


def _band(name: str, label: bool = False) -> Callable[[DataFrame], DataFrame]:
    def build(c: DataFrame) -> DataFrame:
        key = ANALYSIS_GROUPINGS[name][0]
        rows = c.where(F.col("grouping") == name).dropna(subset=[key]).select(key, mean("AQI").alias("mean"), deviation("AQI").alias("std"))
        if label:
            return rows.select(key, carbon_tax_label(key).alias("label"), "mean", "std")
        return rows.withColumns({"band_low": F.col("mean") - F.col("std"), "band_high": F.col("mean") + F.col("std")})
    return build


# the same tables as those of ``result_tables`` and ``trends``, from a cube instead of the readings
CUBE_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "yearly_trends": _group("yearly_trends", {
        "avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_industrial_output": "industrial_output_index", "avg_green_energy_pct": "green_energy_pct",
        "avg_compliance_rate": "regulatory_compliance_rate"}, "total_records"),
    "sector_impact": _group("sector_impact", {
        "avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_no2": "NO2", "avg_so2": "SO2", "avg_industrial_output": "industrial_output_index",
        "avg_compliance_rate": "regulatory_compliance_rate"}, keys={"dominant_industry_sector": "sector"}),
    "policy_effectiveness": _group("policy_effectiveness", {
        "avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_compliance_rate": "regulatory_compliance_rate", "avg_green_energy_pct": "green_energy_pct"}),
    "hourly_patterns": _with(
        _group("hourly_patterns", {"avg_aqi": "AQI", "avg_pm25": "PM2_5", "avg_no2": "NO2", "avg_co": "CO"}), "avg_traffic_factor", lambda: traffic_factor("hour"),
        ["hour", "avg_aqi", "avg_pm25", "avg_no2", "avg_co", "avg_traffic_factor", "record_count"]),
    "health_correlations": _with(_group("health_correlations", {
        "avg_respiratory_cases": "respiratory_cases_per_100k", "avg_cardiovascular_cases": "cardiovascular_cases_per_100k",
        "avg_hospital_admissions": "hospital_admissions_per_100k", "avg_premature_deaths": "premature_deaths_per_million"}),
        "bracket_low", lambda: bracket_start("aqi_bracket")),
    "yearly_aqi_band": _band("yearly_aqi_band"),
    "carbon_tax_aqi": _band("carbon_tax_aqi", label=True),
    "monthly_aqi": _with(_group("monthly_aqi", {"mean_aqi": "AQI"}, None), "label", lambda: month_label("month")),
    "dow_aqi": _with(_group("dow_aqi", {"mean_aqi": "AQI"}, None), "label", lambda: dow_label("day_of_week")),
    **{name: _group(name, {"mean_aqi": "AQI"}, None) for name in ("hourly_aqi", "country_aqi_ranking", "sector_aqi", "regulation_aqi_means")},
    "emission_standard_pollutants": _group("emission_standard_pollutants", {"mean_pm25": "PM2_5", "mean_no2": "NO2", "mean_so2": "SO2"}, None),
}


def table_cube(cleaned: DataFrame) -> DataFrame:
    return cube(cleaned, TABLE_GROUPINGS, TABLE_MEASURES, nan_is_missing=False)


def analysis_cube(raw: DataFrame) -> DataFrame:
    return cube(raw, ANALYSIS_GROUPINGS, ANALYSIS_MEASURES)
