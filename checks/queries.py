"""One query per operator, each over the whole readings table of a star-schema folder."""

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType

from skyledger import constants as C
from skyledger.functions import aqi, derive
from skyledger.functions.numeric import half_up
from skyledger.operators import (
    boosting, cleaning, clusters, cube, distributions, features, joins, reporting, result_tables, sinks, trends, tuning,
)
from skyledger.operators.tree_params import TreeParams
from skyledger.plans import pipeline
from skyledger.plans.folders import shared_folder
from skyledger.schema import readings_schema
from skyledger.session import with_settings
from skyledger.sources import readings as source, results, sampling, sketches, star

EXACT_ACCURACY = 1_000_000
FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"
SAMPLE_TOTAL, HEAD_ROWS, SAMPLE_ROWS = 21_000, 2_000, 5_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed precision and without negative zero, for comparison across engines.

    The factor lifts values that lie on the border between two roundings but for
    the order of a sum; the SQL counterparts have it as well.
    """
    doubles = [f.name for f in df.schema if isinstance(f.dataType, DoubleType)]
    lift = 1 + 1e-13 if digits <= 6 else 1.0
    return df.withColumns({n: half_up(F.col(n) * lift, digits) + F.lit(0.0) for n in doubles}) if doubles else df


def add(name: str, build: Query, digits: int) -> None:
    QUERIES[name] = lambda spark, folder: rounded(build(with_settings(spark), folder), digits)


def query(build: Query | None = None, *, digits: int = 6):
    """Register a query under its function name."""
    def register(fn: Query) -> Query:
        add(fn.__name__, fn, digits)
        return fn
    return register(build) if build else register


def on_raw(name: str, fn: Callable[[DataFrame], DataFrame], digits: int = 6) -> None:
    """Register a function of the raw readings."""
    add(name, lambda spark, folder: fn(star.readings(spark, folder)), digits)


def on_clean(name: str, fn: Callable[[DataFrame], DataFrame], digits: int = 6) -> None:
    """Register a function of the cleaned readings."""
    add(name, lambda spark, folder: fn(cleaned(spark, folder)), digits)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_readings(star.readings(spark, folder))


# --- sources --------------------------------------------------------------------

@query
def scan_readings(spark, folder):
    """Readings written as CSV parts, scanned back with the declared schema."""
    path = new_folder(spark, "readings-csv")
    sinks.write_readings(star.readings(spark, folder), path, compression="snappy")
    scanned = source.scan_readings(spark, path, schema=readings_schema(record_id=StringType()))
    return scanned.groupBy("year").agg(
        F.count("*").alias("row_count"), F.sum("AQI").alias("aqi_sum"), F.count("PM10").alias("pm10_count"),
        F.min("timestamp").alias("first_time"), F.max("date").alias("last_date"), F.avg("PM2_5").alias("avg_pm25"),
    )


# the number of partitions belongs to the engine, not to the data
on_raw("scan_profile", lambda r: source.scan_profile(r).select("row_count", "column_count"))
on_raw("sample_per_part", lambda r: sampling.sample_per_part(
    r.select("record_id", "year", "AQI"), "year", SAMPLE_TOTAL))
on_raw("head_per_part", lambda r: sampling.head_per_part(
    r.select("record_id", "year", "timestamp", "AQI"), "year", n=HEAD_ROWS))
on_raw("sample_rows", lambda r: sampling.sample_rows(r.select("record_id", "station_id", "AQI"), SAMPLE_ROWS))


@query
def parse_time_columns(spark, folder):
    text = star.readings(spark, folder).select(
        "record_id",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
    )
    return source.parse_time_columns(text)


@query
def read_result_table(spark, folder):
    base = new_folder(spark, "results")
    sinks.write_result(result_tables.country_aqi_stats(cleaned(spark, folder), EXACT_ACCURACY), "country_aqi_stats", base)
    return results.read_result_table(spark, base, "country_aqi_stats").drop("processed_at")


on_raw("dataset_metadata", lambda r: source.dataset_metadata(r, "year"))
on_raw("dataset_overview", source.dataset_overview)


@query
def part_sketches(spark, folder):
    """Stored sketches of every year, and whether their answers keep their bounds against the readings themselves."""
    base, r = new_folder(spark, "sketches"), star.readings(spark, folder)
    sketches.store_sketches(r, "year", base)
    table = results.read_result_table(spark, base, sketches.SKETCHES, order=[]).drop("processed_at")
    exact = r.groupBy(F.col("year").cast("string").alias("part")).agg(
        *[F.countDistinct(k).alias(k) for k in sketches.KEYS], F.count("PM2_5").alias("PM2_5"))
    near = lambda k: F.abs(F.hll_sketch_estimate(f"hll_{k}") - F.col(k)) <= F.greatest(F.lit(1), F.ceil(F.col(k) * sketches.distinct_error()))
    return table.join(exact, "part").select(
        "part", F.col("rows").alias("row_count"), F.col("count_PM2_5").alias("pm25_count"), *[near(k).alias(f"{k}_within") for k in sketches.KEYS])


@query
def sketch_overview(spark, folder):
    """Rows and distinct keys of all years from their sketches, and whether the median's rank is within its bound."""
    base, r = new_folder(spark, "sketches"), star.readings(spark, folder)
    sketches.store_sketches(r.where("year < 1996"), "year", base)
    sketches.store_sketches(r, "year", base)
    found = sketches.approximate_overview(results.read_result_table(spark, base, sketches.SKETCHES, order=[]).drop("processed_at"))
    median, error = found.select("median_PM2_5").scalar(), distributions.rank_margin(sketches.KLL_SIZE)
    exact = r.agg(F.avg(F.when(F.col("PM2_5") <= median, 1.0).when(F.col("PM2_5") > median, 0.0)).alias("rank"), *[F.countDistinct(k).alias(k) for k in sketches.KEYS])
    exact = exact.select(F.struct("*")).scalar()
    near = lambda k: F.abs(F.col(f"{k}_count") - exact[k]) <= F.greatest(F.lit(1), F.ceil(exact[k] * sketches.distinct_error()))
    return found.select("total_records", *[near(k).alias(f"{k}_within") for k in sketches.KEYS], (F.abs(exact["rank"] - 0.5) <= error).alias("median_within"))


@query
def cube_means(spark, folder):
    """Every group of the result tables' groupings from one scan, the cube of the years added up."""
    c = cleaned(spark, folder)
    parts = [cube.table_cube(c.where(F.col("year") <= 1995)), cube.table_cube(c.where(F.col("year") > 1995))]
    keys = dict.fromkeys(k for own in cube.TABLE_GROUPINGS.values() for k in own)
    return cube.merge(parts).select(
        "grouping", F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("group_key"), F.col("n").alias("record_count"), cube.mean("AQI").alias("mean_aqi"),
        cube.deviation("AQI").alias("std_aqi"), F.col("AQI_max").alias("max_aqi"), F.col("AQI_min").alias("min_aqi"), cube.mean("PM2_5").alias("mean_pm25"))


# --- sinks ----------------------------------------------------------------------

@query
def write_result(spark, folder):
    base = new_folder(spark, "results")
    sinks.write_result(result_tables.sector_impact(cleaned(spark, folder)), "sector_impact", base)
    return results.read_result_table(spark, base, "sector_impact").drop("processed_at")


@query
def write_readings(spark, folder):
    path = new_folder(spark, "readings")
    sinks.write_readings(star.readings(spark, folder), path, "parquet")
    scanned = source.scan_readings(spark, path, "parquet", readings_schema(record_id=StringType()))
    return scanned.groupBy("country").agg(F.count("*").alias("row_count"), F.avg("PM10").alias("avg_pm10"))


_STORED: dict[tuple[str, str], str] = {}


def _stored(spark: SparkSession, folder: str) -> str:
    """Folder of a pipeline run; three queries read it, so it is run once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        base = new_folder(spark, "pipeline")
        pipeline.run_pipeline(spark, star.readings(spark, folder), base)
        _STORED[key] = base
    return _STORED[key]


@query
def run_pipeline(spark, folder):
    """Clean, aggregate, analyse and tune the models into stored tables; the row count of each."""
    base = _stored(spark, folder)
    names = [*result_tables.RESULT_TABLES, *pipeline.ANALYSES, "city_profiles", "city_clusters", "cluster_examples", *pipeline.MODEL_TABLES]
    return sinks.result_catalog({n: results.read_result_table(spark, base, n) for n in names})


def _comparable_log(log: DataFrame) -> DataFrame:
    """Without times and Spark's version, which no other engine can know."""
    return log.select("stage", "records_processed", "output_table")


@query
def append_log(spark, folder):
    base = _stored(spark, folder)
    return _comparable_log(results.read_result_table(spark, base, "processing_log"))


on_raw("assert_unique_keys", lambda r: sinks.assert_unique_keys(r, ["station_id", "timestamp"]))
on_clean("result_catalog", lambda c: sinks.result_catalog({n: f(c) for n, f in result_tables.RESULT_TABLES.items()}))


@query
def write_csv_report(spark, folder):
    path = new_folder(spark, "report")
    sinks.write_csv_report(trends.mean_by(star.readings(spark, folder), "dominant_industry_sector"), path)
    return spark.read.schema("dominant_industry_sector string, mean_aqi double").option("header", True).csv(path)


on_raw("summary_metrics", reporting.summary_metrics)


# --- cleaning and derived columns -----------------------------------------------

on_raw("drop_incomplete", lambda r: cleaning.drop_incomplete(r).select("record_id", "country", "AQI"))


@query(digits=8)
def cast_columns(spark, folder):
    """All fifteen columns as text, converted back."""
    r = star.readings(spark, folder)
    text = r.select("record_id", *[F.col(c).cast("string").alias(c) for c in cleaning.CAST_SPEC])
    return cleaning.cast_columns(text)


on_raw("valid_aqi", lambda r: cleaning.valid_range(r, "AQI", 0, 500).select("record_id", "AQI"))
on_raw("pollution_severity", lambda r: r.select("record_id", aqi.pollution_severity("AQI").alias("pollution_severity")))
on_raw("aqi_bracket", lambda r: r.select("record_id", aqi.aqi_bracket("AQI").alias("aqi_bracket")))
on_raw("clean_readings", cleaning.clean_readings, digits=8)
on_raw("clamp_pollutants", lambda r: cleaning.clamp_to_ranges(r).select("record_id", *C.POLLUTANTS), digits=8)
on_raw("cleaning_audit", cleaning.cleaning_audit)
on_raw("traffic_factor", lambda r: r.select("record_id", derive.traffic_factor("hour").alias("traffic_factor")))
on_raw("aqi_from_pm25", lambda r: r.select(
    "record_id", aqi.aqi_from_pm25("PM2_5", "round").alias("aqi_rounded"), aqi.aqi_from_pm25("PM2_5", "trunc").alias("aqi_cut")))
on_raw("aqi_category", lambda r: r.select("record_id", aqi.aqi_category("AQI").alias("aqi_category")))
on_raw("calendar_features", lambda r: r.select(
    "record_id", *[c.alias(n) for n, c in derive.calendar_features("timestamp").items()]))
on_raw("label_calendar", lambda r: r.select(
    "record_id", derive.month_label("month").alias("month_label"), derive.dow_label("day_of_week").alias("dow_label")))


@query
def pollution_factor(spark, folder):
    stations = star.registry(spark, folder).select("station_id", "industrial_index", "regulation_score")
    r = joins.enrich_with_registry(star.readings(spark, folder), stations, ["industrial_index", "regulation_score"])
    return r.select("record_id", derive.pollution_factor(star.FIRST_YEAR).alias("pollution_factor"))


on_raw("emission_standard", lambda r: r.select(
    "record_id", derive.emission_standard("regulation_stringency_score", "year", star.CUTOVER_YEAR).alias("emission_standard")))
on_raw("carbon_tax_flag", lambda r: r.select(
    "record_id", derive.carbon_tax_flag("regulation_stringency_score").alias("carbon_tax")))
on_raw("policy_change_flag", lambda r: r.select(
    "record_id", derive.policy_change_flag("timestamp", star.CHANGE_YEARS).alias("policy_change")))


@query
def expected_industry(spark, folder):
    stations = star.registry(spark, folder).select("station_id", "industrial_index", "regulation_score")
    r = joins.enrich_with_registry(star.readings(spark, folder), stations, ["industrial_index", "regulation_score"])
    return r.select("record_id", *[c.alias(n) for n, c in derive.expected_industry(star.FIRST_YEAR).items()])


on_raw("expected_health", lambda r: r.select(
    "record_id", *[c.alias(n) for n, c in derive.expected_health("AQI", 1.5).items()]))
on_raw("expected_weather", lambda r: r.select("record_id", *[c.alias(n) for n, c in derive.expected_weather().items()]))
on_clean("aqi_badge", lambda c: result_tables.country_aqi_stats(c).select("country", aqi.aqi_badge("avg_aqi").alias("aqi_badge")))
on_clean("regulation_badge", lambda c: result_tables.country_aqi_stats(c).select(
    "country", aqi.regulation_badge("regulation_score").alias("regulation_badge")))
on_clean("display_round", lambda c: reporting.display_round(result_tables.country_aqi_stats(c, EXACT_ACCURACY)))


# --- joins and the observation grid ---------------------------------------------

@query
def enrich_with_registry(spark, folder):
    return joins.enrich_with_registry(star.bare_readings(spark, folder), star.registry(spark, folder))


@query
def commissioned_only(spark, folder):
    kept = joins.commissioned_only(star.readings(spark, folder), star.registry(spark, folder))
    return kept.select("record_id", "station_id", "year")


@query
def observation_spine(spark, folder):
    spine = joins.observation_spine(star.registry(spark, folder), FIRST_DAY, LAST_DAY)
    return spine.groupBy("station_id").agg(
        F.count("*").alias("slots"), F.sum(F.hour("timestamp")).alias("hour_sum"),
        F.min("timestamp").alias("first_slot"), F.max("timestamp").alias("last_slot"),
    )


# --- result tables --------------------------------------------------------------

for _name, _table in result_tables.RESULT_TABLES.items():
    if _name == "country_aqi_stats":
        on_clean(_name, lambda c: result_tables.country_aqi_stats(c, EXACT_ACCURACY))
    else:
        on_clean(_name, _table)


# --- statistics over raw readings -----------------------------------------------

@query(digits=8)
def describe_pollutants(spark, folder):
    table = distributions.describe(star.readings(spark, folder), digits=None)
    quartile = F.col("statistic").contains("%")
    return table.select("statistic", *[
        F.when(quartile, F.col(c)).otherwise(F.round(c, 6)).alias(c) for c in C.POLLUTANTS])


on_raw("aqi_histogram", lambda r: distributions.histogram(r, "AQI", 50))
on_raw("category_counts", lambda r: distributions.value_counts(r, "AQI_category"))
on_raw("box_stats", distributions.box_stats, digits=8)
on_raw("correlation_matrix", trends.correlation_matrix)
on_raw("yearly_aqi_band", lambda r: trends.mean_std_by(r, "year"))
on_raw("monthly_aqi", trends.monthly_aqi)
on_raw("hourly_aqi", lambda r: trends.mean_by(r, "hour"))
on_raw("dow_aqi", trends.dow_aqi)
on_raw("country_aqi_ranking", lambda r: reporting.rank_table(trends.mean_by(r, "country"), "mean_aqi", ["country"]))
on_raw("top_cities", lambda r: trends.top_groups(r, "city", 20))
on_raw("sector_aqi", lambda r: trends.mean_by(r, "dominant_industry_sector"))
on_raw("industrial_trend", lambda r: trends.linear_trend(r, "industrial_output_index"))
on_raw("green_energy_trend", lambda r: trends.linear_trend(r, "green_energy_pct"))
on_raw("trend_line_points", lambda r: trends.trend_line(r, "industrial_output_index"))
on_raw("trend_line_fixed", lambda r: trends.trend_line(r, "green_energy_pct", low=0, high=100))
on_raw("carbon_tax_aqi", trends.carbon_tax_aqi)
on_raw("regulation_aqi_means", lambda r: trends.mean_by(r, "regulation_stringency_score"))
on_raw("regulation_pearson", trends.regulation_pearson)
on_raw("emission_standard_pollutants", lambda r: trends.mean_by(
    r, "emission_standard_level", {"mean_pm25": "PM2_5", "mean_no2": "NO2", "mean_so2": "SO2"}))
on_raw("compliance_histogram", distributions.compliance_histogram)
on_raw("investment_trend", trends.investment_trend)
on_raw("industrial_scatter_sample", lambda r: sampling.sample_rows(
    r.select("record_id", "industrial_output_index", "green_energy_pct", "AQI"), SAMPLE_ROWS))
on_raw("aqi_respiratory_sample", lambda r: sampling.sample_rows(
    r.select("record_id", "AQI", "respiratory_cases_per_100k", "regulation_stringency_score"), SAMPLE_ROWS))
on_raw("health_by_country_normalized", trends.health_by_country_normalized)
on_raw("admissions_histogram", distributions.admissions_histogram)
on_raw("yearly_health", trends.yearly_health)
on_raw("global_mean_aqi", trends.global_mean)
on_raw("extreme_countries", lambda r: trends.extreme_groups(r, "country"))
on_raw("aqi_correlations", lambda r: trends.corr_pairs(
    r, [("industrial_output_index", "AQI"), ("regulation_stringency_score", "AQI")]))
on_raw("carbon_tax_reduction", trends.group_reduction)


# --- reports over result tables -------------------------------------------------

@query
def overview_cards(spark, folder):
    c = cleaned(spark, folder)
    return reporting.overview_cards(result_tables.country_aqi_stats(c), result_tables.city_aqi_stats(c), scored(spark, folder))


on_clean("country_ranking", lambda c: reporting.country_ranking(result_tables.country_aqi_stats(c, EXACT_ACCURACY)))
on_clean("top_city_table", lambda c: reporting.top_city_table(result_tables.city_aqi_stats(c)))
on_clean("sector_table", lambda c: reporting.sector_table(result_tables.sector_impact(c)))
on_clean("health_table", lambda c: reporting.health_table(result_tables.health_correlations(c)))


@query
def log_table(spark, folder):
    return _comparable_log(reporting.log_table(results.read_result_table(spark, _stored(spark, folder), "processing_log")))


# --- machine learning -----------------------------------------------------------

on_raw("ml_features", lambda r: features.ml_features(r).agg(
    F.count("*").alias("row_count"), *[F.avg(c).alias(f"mean_{c}") for c in [*C.FEATURE_COLUMNS, features.ENCODED, features.LABEL]]))
on_raw("encode_station_type", lambda r: features.encode_label(r.select("record_id", "station_type"), "station_type", "code"))


@query
def train_test_split(spark, folder):
    ids = star.readings(spark, folder).select("record_id", "station_type")
    train, test = features.train_test_split(ids)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))) \
        .groupBy("part", "station_type").agg(F.count("*").alias("n"))


on_raw("regression_metrics", lambda r: tuning.regression_metrics(
    r.select((F.col("PM2_5") * 1.1 + 20).alias("prediction"), F.col("AQI").alias("label"))))
on_raw("city_profiles", clusters.city_profiles)
on_raw("scale_profiles", lambda r: clusters.scale_profiles(clusters.city_profiles(r)))


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    """City profiles as a stored table: the fits below read them many times."""
    base = new_folder(spark, "profiles")
    sinks.write_result(clusters.city_profiles(star.readings(spark, folder)), "city_profiles", base, ["city"])
    return results.read_result_table(spark, base, "city_profiles").drop("processed_at")


@query
def city_clusters(spark, folder):
    profiles = _profiles(spark, folder)
    scaled = clusters.scale_profiles(profiles)
    return clusters.city_cluster_table(profiles, clusters.city_clusters(scaled), clusters.city_pca(scaled))


@query
def city_pca(spark, folder):
    return clusters.city_pca(clusters.scale_profiles(_profiles(spark, folder)))


@query
def cluster_examples(spark, folder):
    """The first cities of every cluster."""
    return clusters.cluster_examples(clusters.city_clusters(clusters.scale_profiles(_profiles(spark, folder))))


def split_features(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Feature rows of the whole table, stored once because every fit reads them again."""
    path = new_folder(spark, "features")
    sinks.write_readings(features.mark_split(features.ml_features(star.readings(spark, folder))), path, "parquet")
    return features.marked_split(spark.read.parquet(path))


# One full search per model, folder and application: the queries on its tuning row, its scores and its importances share it.
_SEARCHES: dict[tuple[str, str, str], tuple] = {}


def _search(spark: SparkSession, folder: str, model: str) -> tuple[tuning.Search, DataFrame]:
    key = (spark.sparkContext.applicationId, folder, model)
    if key not in _SEARCHES:
        _SEARCHES[key] = pipeline.TUNERS[model](*split_features(spark, folder))
    return _SEARCHES[key]


@query
def random_search(spark, folder):
    """All points of the boosting search with their scores over three folds."""
    search, _ = _search(spark, folder, "GradientBoosting")
    rows = [(i, json.dumps(p), float(s), p == search.params) for i, (p, s) in enumerate(zip(search.points, search.scores))]
    return spark.createDataFrame(rows, "point int, params string, score double, is_best boolean")


@query
def tune_random_forest(spark, folder):
    return _search(spark, folder, "RandomForest")[1]


@query
def tune_gradient_boosting(spark, folder):
    return _search(spark, folder, "GradientBoosting")[1]


@query
def tune_boosted_regularized(spark, folder):
    return _search(spark, folder, "RegularizedBoosting")[1]


@query
def feature_importance(spark, folder):
    """Importances in the best model of each search."""
    parts = [tuning.feature_importance(spark, _search(spark, folder, m)[0].model).select(F.lit(m).alias("model_name"), "*") for m in pipeline.TUNERS]
    return reduce(DataFrame.unionByName, parts)


@query(digits=4)
def gradient_tree(spark, folder):
    """One tree of two levels over all rows, grown by group-bys, with L1 and L2 weights."""
    columns, params = ["NO2", "temperature_c", "hour"], TreeParams(max_depth=2, min_samples_split=5, min_samples_leaf=3, learning_rate=0.1, reg_alpha=1.0, reg_lambda=2.0)
    rows = star.readings(spark, folder).select(*columns, "AQI").dropna()
    limits = boosting.bin_limits(rows, columns, 8, EXACT_ACCURACY)
    base = rows.agg(F.avg("AQI")).first()[0]
    errors = boosting.binned(rows, limits, ["AQI"]).select("bins", (F.lit(base) - F.col("AQI")).alias("g"), F.lit(1.0).alias("h"))
    # every level reads the rows again: 512 bins at most are all they differ in
    errors = boosting.alike(errors).localCheckpoint()
    return boosting.tree_table(spark, boosting.grow(errors, params), columns, limits)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Tuning table of three predictors with a closed form: the mean, a fitted line and a given line over PM2.5."""
    r = star.readings(spark, folder).select("record_id", "AQI", "PM2_5")
    train, test = features.train_test_split(r)
    fit = train.agg(F.avg("AQI").alias("mean"), F.regr_slope("AQI", "PM2_5").alias("slope"),
                    F.regr_intercept("AQI", "PM2_5").alias("intercept"), F.count("*").alias("n"))
    # four numbers, told once: as subqueries each of their uses would scan the readings again
    fitted = {name: F.lit(value) for name, value in fit.first().asDict().items()}
    predictions = {
        "FittedLine": (fitted["slope"] * F.col("PM2_5") + fitted["intercept"], 1),
        "GivenLine": (F.col("PM2_5") * 1.1 + 20, 1),
        "Mean": (fitted["mean"], 0),
    }
    # one pass over the test rows for all predictors
    rows = test.select("AQI", *[p.alias(name) for name, (p, _) in predictions.items()])
    metrics = rows.agg(F.count("*").alias("n"), *[
        F.struct(*[m.alias(k) for k, m in tuning.metric_columns(F.col("AQI"), F.col(name)).items()]).alias(name) for name in predictions])
    table = F.array(*[F.struct(
        F.lit(name).alias("model_name"), F.create_map(F.lit("columns"), F.lit(columns)).alias("best_params"),
        F.col(name)["r2"].alias("cv_score"), F.col(name)["r2"].alias("test_r2"), F.col(name)["rmse"].alias("test_rmse"), F.col(name)["mae"].alias("test_mae"),
        F.lit(0.0).alias("duration_seconds"), F.lit(columns).alias("feature_count"), fitted["n"].cast("long").alias("train_size"), F.col("n").alias("test_size"),
    ) for name, (_, columns) in predictions.items()])
    return metrics.select(F.explode(table).alias("row")).select("row.*")


@query
def write_tuning_results(spark, folder):
    base = new_folder(spark, "tuning")
    sinks.write_tuning_results(scored(spark, folder), base)
    return results.read_result_table(spark, base, sinks.TUNING_TABLE).drop("tuned_at")


@query
def model_comparison(spark, folder):
    return tuning.model_comparison([scored(spark, folder)])


@query
def model_ranking(spark, folder):
    return reporting.model_ranking(scored(spark, folder))


@query
def r2_badge(spark, folder):
    return scored(spark, folder).select("model_name", aqi.r2_badge("test_r2").alias("r2_badge"))


@query
def model_summary(spark, folder):
    return reporting.model_summary(scored(spark, folder).withColumn("best_params", F.to_json("best_params")))
