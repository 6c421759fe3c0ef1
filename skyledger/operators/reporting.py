"""Reports over the stored result tables, which hold one row per group."""

from pyspark.sql import DataFrame, Window, functions as F

from skyledger.functions.aqi import aqi_badge, bracket_start, r2_badge, regulation_badge
from skyledger.functions.numeric import half_even, nan_to_null, pair_corr
from skyledger.operators.trends import extreme_groups, reduction_pct
from skyledger.sources.readings import dataset_overview

ONE_DIGIT = {name: 1 for name in (
    "avg_aqi", "median_pm25", "avg_pm25", "avg_pm10", "avg_no2", "avg_so2", "avg_co", "avg_o3", "avg_green_energy_pct",
    "avg_industrial_output", "avg_compliance_rate", "avg_respiratory_cases", "avg_cardiovascular_cases",
    "avg_hospital_admissions", "duration_seconds",
)}
DISPLAY_DIGITS = ONE_DIGIT | {"avg_premature_deaths": 2, "regulation_score": 0}


def display_round(df: DataFrame, digits: dict[str, int] = DISPLAY_DIGITS) -> DataFrame:
    """Displayed precision, half to even; columns with 0 digits become whole numbers."""
    shown = {}
    for name in df.columns:
        if name in digits:
            rounded = half_even(name, digits[name])
            shown[name] = rounded.cast("int") if digits[name] == 0 else rounded
    return df.withColumns(shown)


def rank_table(df: DataFrame, by: str, keys: list[str], n: int | None = None) -> DataFrame:
    """Position by ``by`` from the highest down, ties by key; only the first ``n`` rows if given.

    Meant for tables of one row per group: without ``n`` the positions are
    numbered in one task.
    """
    order = [F.desc_nulls_last(by), *keys]
    rows = df if n is None else df.orderBy(*order).limit(n)
    return rows.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def country_ranking(country: DataFrame) -> DataFrame:
    ranked = rank_table(country, "avg_aqi", ["country"]).withColumns({
        "aqi_badge": aqi_badge("avg_aqi"), "regulation_badge": regulation_badge("regulation_score"),
    })
    return display_round(ranked.select(
        "position", "country", "avg_aqi", "aqi_badge", "median_pm25", "avg_no2", "avg_so2", "regulation_score",
        "regulation_badge", "avg_green_energy_pct", "record_count",
    ))


def top_city_table(city: DataFrame, n: int = 20) -> DataFrame:
    ranked = rank_table(city, "avg_aqi", ["city", "country"], n).withColumn("aqi_badge", aqi_badge("avg_aqi"))
    return display_round(ranked.select(
        "position", "city", "country", "avg_aqi", "aqi_badge", "avg_pm25", "avg_pm10", "avg_no2", "station_count",
        "avg_respiratory_cases",
    ))


def sector_table(sector: DataFrame) -> DataFrame:
    badged = sector.withColumn("aqi_badge", aqi_badge("avg_aqi")).orderBy(F.desc_nulls_last("avg_aqi"), "sector")
    return display_round(badged.select(
        "sector", "avg_aqi", "aqi_badge", "avg_pm25", "avg_no2", "avg_so2", "avg_industrial_output",
        "avg_compliance_rate", "record_count",
    ))


def health_table(health: DataFrame) -> DataFrame:
    ordered = health.withColumn("bracket_low", bracket_start("aqi_bracket")).orderBy("aqi_bracket")
    return display_round(ordered.select(
        "aqi_bracket", "bracket_low", "avg_respiratory_cases", "avg_cardiovascular_cases", "avg_hospital_admissions",
        "avg_premature_deaths", "record_count",
    ))


def log_table(log: DataFrame) -> DataFrame:
    """The processing log in the order of writing, times cut to seconds."""
    return log.orderBy("id").select(
        "stage", "records_processed", "duration_seconds", "output_table", "spark_version",
        F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss").alias("processed_at"),
    )


def model_ranking(tuning: DataFrame) -> DataFrame:
    ranked = rank_table(tuning, "test_r2", ["model_name"]).withColumn("r2_badge", r2_badge("test_r2"))
    return display_round(ranked.select(
        "position", "model_name", "test_r2", "r2_badge", "test_rmse", "test_mae", "cv_score", "duration_seconds",
    ))


def best_model(tuning: DataFrame) -> DataFrame:
    """Model with the highest test r2; the first by name on a tie; NULL if no model has one."""
    first = F.min_by(F.struct("model_name", "test_r2"), F.struct(-F.col("test_r2"), F.col("model_name")))
    best = tuning.filter("test_r2 IS NOT NULL").agg(first.alias("best"))
    return best.select(F.col("best.model_name").alias("best_model"), F.col("best.test_r2").alias("best_r2"))


def overview_cards(country: DataFrame, city: DataFrame, tuning: DataFrame | None = None) -> DataFrame:
    """Records, countries, cities, record-weighted mean index, best model and its r2, in one row."""
    weighted = F.try_divide(F.sum(F.col("avg_aqi") * F.col("record_count")), F.sum("record_count"))
    cards = country.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.count("*").alias("countries"),
        half_even(weighted, 1).alias("mean_aqi"),
    ).withColumn("cities", city.agg(F.count("*")).scalar())
    if tuning is None:
        none = {"best_model": F.lit(None).cast("string"), "best_r2": F.lit(None).cast("double")}
        return cards.withColumns(none)
    best = best_model(tuning).select(F.struct("best_model", "best_r2")).scalar()
    return cards.withColumns({"best_model": best["best_model"], "best_r2": best["best_r2"]})


def _metric_rows(row: DataFrame, section: str, numbers: dict[str, str], texts: dict[str, str]) -> DataFrame:
    """One-row table to (section, metric, value, text) rows; metric name -> column."""
    cells = [f"named_struct('metric', '{m}', 'value', CAST({c} AS DOUBLE), 'text', CAST(NULL AS STRING))"
             for m, c in numbers.items()]
    cells += [f"named_struct('metric', '{m}', 'value', CAST(NULL AS DOUBLE), 'text', CAST({c} AS STRING))"
              for m, c in texts.items()]
    return row.selectExpr(f"'{section}' AS section", f"inline(array({', '.join(cells)}))")


def summary_metrics(r: DataFrame) -> DataFrame:
    """The figures of the written summary as (section, metric, value, text) rows, from three passes."""
    overview = _metric_rows(
        dataset_overview(r), "overview",
        {name: name for name in ("total_records", "countries", "cities", "stations")},
        {name: name for name in ("first_date", "last_date")},
    )
    findings = _metric_rows(
        r.agg(
            F.avg(nan_to_null(F.col("AQI").cast("double"))).alias("mean"),
            pair_corr("industrial_output_index", "AQI").alias("industry"),
            pair_corr("regulation_stringency_score", "AQI").alias("regulation"),
            reduction_pct().alias("reduction"),
        ), "findings",
        {"global_mean_aqi": "mean", "industrial_output_correlation": "industry", "regulation_correlation": "regulation",
         "carbon_tax_reduction_pct": "reduction"}, {},
    )
    extremes = _metric_rows(
        extreme_groups(r, "country"), "findings", {},
        {"most_polluted_country": "highest", "cleanest_country": "lowest"},
    )
    return overview.unionByName(findings).unionByName(extremes)


def model_summary(tuning: DataFrame) -> DataFrame:
    """The figures of the written tuning report as (section, metric, value, text) rows."""
    numbers = ["test_r2", "test_rmse", "test_mae", "cv_score", "duration_seconds", "feature_count", "train_size", "test_size"]
    cast = tuning.select("model_name", *[F.col(n).cast("double").alias(n) for n in numbers])
    values = cast.unpivot(["model_name"], numbers, "metric", "value").select(
        F.col("model_name").alias("section"), "metric", "value", F.lit(None).cast("string").alias("text"))
    params = tuning.select(
        F.col("model_name").alias("section"), F.lit("best_params").alias("metric"),
        F.lit(None).cast("double").alias("value"), F.col("best_params").alias("text"))
    best = best_model(tuning).select(
        F.lit("best").alias("section"), F.lit("best_model").alias("metric"),
        F.col("best_r2").alias("value"), F.col("best_model").alias("text"))
    return values.unionByName(params).unionByName(best)
