"""The whole job: scan, clean, seven result tables, analyses, models, log."""

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from skyledger.operators import clusters, cube, distributions, features, reporting, sinks, trends, tuning
from skyledger.operators.cleaning import clean_readings
from skyledger.operators.result_tables import RESULT_TABLES
from skyledger.schema import READINGS_SCHEMA
from skyledger.sources import readings as source_readings, sampling, storage
from skyledger.sources.readings import scan_readings
from skyledger.sources.results import read_stored, table_path

READINGS = "readings"
CLEANED = "cleaned_readings"
STAGES = ("clean", "tables", "analysis", "models")
MANIFEST = "_manifest"

# analyses on raw readings that are stored as reports
ANALYSES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "descriptive_statistics": distributions.describe,
    "correlation_matrix": trends.correlation_matrix,
    "aqi_histogram": lambda r: distributions.histogram(r, "AQI"),
    "category_counts": lambda r: distributions.value_counts(r, "AQI_category"),
    "box_stats": distributions.box_stats,
    "yearly_aqi_band": lambda r: trends.mean_std_by(r, "year"),
    "monthly_aqi": trends.monthly_aqi,
    "hourly_aqi": lambda r: trends.mean_by(r, "hour"),
    "dow_aqi": trends.dow_aqi,
    "country_aqi_ranking": lambda r: trends.mean_by(r, "country"),
    "top_cities": lambda r: trends.top_groups(r, "city", 20),
    "sector_aqi": lambda r: trends.mean_by(r, "dominant_industry_sector"),
    "industrial_trend": lambda r: trends.linear_trend(r, "industrial_output_index"),
    "green_energy_trend": lambda r: trends.linear_trend(r, "green_energy_pct"),
    "carbon_tax_aqi": trends.carbon_tax_aqi,
    "regulation_pearson": trends.regulation_pearson,
    "emission_standard_pollutants": lambda r: trends.mean_by(
        r, "emission_standard_level", {"mean_pm25": "PM2_5", "mean_no2": "NO2", "mean_so2": "SO2"}),
    "compliance_histogram": distributions.compliance_histogram,
    "investment_trend": trends.investment_trend,
    "health_by_country_normalized": trends.health_by_country_normalized,
    "admissions_histogram": distributions.admissions_histogram,
    "yearly_health": trends.yearly_health,
    "summary_metrics": reporting.summary_metrics,
    "trend_line_points": lambda r: trends.trend_line(r, "industrial_output_index"),
    "green_energy_line_points": lambda r: trends.trend_line(r, "green_energy_pct"),
    "regulation_aqi_means": lambda r: trends.mean_by(r, "regulation_stringency_score"),
    "industrial_scatter_sample": lambda r: sampling.sample_rows(r.select("record_id", "AQI", "industrial_output_index")),
    "aqi_respiratory_sample": lambda r: sampling.sample_rows(
        r.select("record_id", "AQI", "respiratory_cases_per_100k", "regulation_stringency_score")),
    "dataset_overview": source_readings.dataset_overview,
}
CSV_REPORTS = ("descriptive_statistics", "summary_metrics")
MODEL_TABLES = (sinks.TUNING_TABLE, "feature_importance", "model_comparison", "model_summary")
TUNERS = {
    "RandomForest": tuning.tune_random_forest,
    "GradientBoosting": tuning.tune_gradient_boosting,
    "RegularizedBoosting": tuning.tune_boosted_regularized,
}


class Run:
    """One run into a folder: what it has done, for the log, and what a run of the same input has finished before.

    A finished table is marked under the input's fingerprint. A run that starts
    again goes on behind the last mark; without a fingerprint nothing is marked.
    """

    def __init__(self, spark: SparkSession, base: str, fingerprint: str | None):
        self.spark, self.base, self.entries, self._logged = spark, base, [], 0
        self._marks = f"{base.rstrip('/')}/{MANIFEST}/{fingerprint}" if fingerprint else None
        self._done = set(storage.names(spark, self._marks)) if fingerprint else set()
        self._lock = threading.Lock()

    def do(self, stage: str, table: str, job: Callable[[], int], logged: bool = True) -> None:
        """Run a job unless its table is finished."""
        if table in self._done:
            return
        started = time.monotonic()
        rows = job()
        with self._lock:
            if logged:
                self.entries.append({"stage": stage, "records_processed": rows, "duration_seconds": time.monotonic() - started, "output_table": table})
            self._done.add(table)
        if self._marks:
            storage.mark(self.spark, f"{self._marks}/{table}")

    def log(self) -> None:
        """One row for every table that was finished since the last call."""
        if len(self.entries) > self._logged:
            sinks.append_log(self.spark, self.entries[self._logged:], self.base)
            self._logged = len(self.entries)

    def write(self, stage: str, table: str, build: Callable[[], DataFrame], keys: list[str] | None = None) -> None:
        self.do(stage, table, lambda: sinks.write_result(build(), table, self.base, keys))

    def at_once(self, jobs: list[Callable[[], None]], most: int) -> None:
        """Several Spark jobs together, so that small final stages overlap."""
        @inheritable_thread_target(self.spark)
        def run_one(job: Callable[[], None]) -> None:
            job()

        with ThreadPoolExecutor(most) as pool:
            list(pool.map(run_one, jobs))

    def write_all(self, tables: dict[str, Callable[[], DataFrame]], at_once: int) -> None:
        self.at_once([lambda n=n: self.write(n, n, tables[n]) for n in tables], at_once)

    def read(self, table: str) -> DataFrame:
        return read_stored(self.spark, self.base, table)


def store_result_tables(cleaned: DataFrame, base: str, at_once: int = 8, run: Run | None = None) -> None:
    """The seven result tables of cleaned readings: five of them from one scan, whose cube is stored, the others (median, distinct stations) from their own."""
    run = run or Run(cleaned.sparkSession, base, None)
    _store_with_cube(run, "table_cube", lambda: cube.table_cube(cleaned), {n: (lambda f=f: f(cleaned)) for n, f in RESULT_TABLES.items()}, at_once)


def _store_with_cube(run: Run, name: str, build: Callable[[], DataFrame], tables: dict[str, Callable[[], DataFrame]], at_once: int) -> None:
    """Write tables at the same time, those that a cube has from the cube, once that is stored."""
    from_cube = [n for n in tables if n in cube.CUBE_TABLES]

    def rolled_up() -> None:
        run.do(name, name, lambda: sinks.write_result(build(), name, run.base, []), logged=False)
        rows = run.read(name)
        run.write_all({n: (lambda f=cube.CUBE_TABLES[n]: f(rows)) for n in from_cube}, at_once)

    run.at_once([*([rolled_up] if from_cube else []), *[lambda n=n: run.write(n, n, tables[n]) for n in tables if n not in from_cube]], at_once)


def run_pipeline(spark: SparkSession, source: str | DataFrame, base: str, stages="all", fmt: str = "csv",
                 searches: dict[str, dict] | None = None, at_once: int = 8, schema: StructType = READINGS_SCHEMA,
                 fingerprint: str | None = None, resume: bool = True) -> list[dict]:
    """Run all or some stages in their fixed order and log each; returns the log entries of what this run did.

    ``source`` is a path or a readings DataFrame, ``base`` a folder that all
    executors share. CSV is parsed once: if analyses or models follow, the
    readings are first stored as Parquet, and so is a DataFrame before analyses.
    The cleaned readings are stored, too,
    and every later step reads only the columns it needs. Unlike a cached table
    these copies survive the loss of executors and do not compete for memory.
    ``searches`` may give arguments of the three searches by model name; without
    it they are full.

    A run that was broken off is started again with the same call: tables that
    an earlier run finished from the same input are left as they are. The input
    is told by its files (names, sizes, times) if ``source`` is a path; for a
    DataFrame the caller may give a ``fingerprint``. ``resume=False`` does all
    anew.
    """
    chosen = STAGES if stages == "all" else tuple(stages)
    unknown = set(chosen) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    is_path = isinstance(source, str)
    raw = scan_readings(spark, source, fmt, schema) if is_path else source
    fingerprint = storage.fingerprint(spark, source) if is_path and fingerprint is None else fingerprint
    run = Run(spark, base, fingerprint if resume else None)

    try:
        if is_path and fmt == "csv" and {"analysis", "models"} & set(chosen):
            stored, csv = table_path(base, READINGS), raw
            run.do("ingest", READINGS, lambda: sinks.write_readings(csv, stored, "parquet"))
            raw = scan_readings(spark, stored, "parquet", schema)
            run.log()
        elif not is_path and "analysis" in chosen:
            # some thirty jobs read the table: what it is derived from is read and joined once
            stored, derived = table_path(base, READINGS), raw
            run.do("ingest", READINGS, lambda: sinks.write_readings(derived, stored, "parquet"), logged=False)
            raw = spark.read.parquet(stored)
        if "clean" in chosen:
            path = table_path(base, CLEANED)
            run.do("data_cleaning", CLEANED, lambda: sinks.write_readings(clean_readings(raw), path, "parquet"))
            run.log()
        if "tables" in chosen:
            store_result_tables(spark.read.parquet(table_path(base, CLEANED)), base, at_once, run)
            run.log()
        if "analysis" in chosen:
            _store_with_cube(run, "analysis_cube", lambda: cube.analysis_cube(raw), {n: (lambda f=f: f(raw)) for n, f in ANALYSES.items()}, at_once)
            run.log()
            _store_clusters(raw, run)
            _store_reports(run)
            run.log()
        if "models" in chosen:
            _store_models(raw, run, searches or {})
    finally:
        run.log()
    return run.entries


def _store_reports(run: Run) -> None:
    """The two reports that are kept as CSV as well."""
    for name in CSV_REPORTS:
        sinks.write_csv_report(run.read(name).drop("processed_at"), table_path(run.base, f"reports/{name}"))


def _store_clusters(raw: DataFrame, run: Run) -> None:
    run.write("city_profiles", "city_profiles", lambda: clusters.city_profiles(raw), ["city"])

    def clustered() -> DataFrame:
        profiles = run.read("city_profiles").drop("processed_at")
        scaled = clusters.scale_profiles(profiles)
        return clusters.city_cluster_table(profiles, clusters.city_clusters(scaled), clusters.city_pca(scaled))

    run.write("city_clusters", "city_clusters", clustered, ["city"])
    run.write("city_clusters", "cluster_examples", lambda: clusters.cluster_examples(run.read("city_clusters")), [])


def _store_models(raw: DataFrame, run: Run, searches: dict[str, dict]) -> None:
    """Features, the tuning table, importances of every model, comparison and summary; each search is finished on its own."""
    spark, base = raw.sparkSession, run.base
    path = table_path(base, "model_features")
    run.do("model_tuning", "model_features", lambda: sinks.write_readings(features.ml_features(raw), path, "parquet"), logged=False)
    train, test = features.train_test_split(spark.read.parquet(path))

    def searched(name: str) -> int:
        search, row = TUNERS[name](train, test, **searches.get(name, {}))
        sinks.write_result(tuning.feature_importance(spark, search.model).select(F.lit(name).alias("model_name"), "*"), f"importance_{name}", base, [])
        return sinks.write_result(row, f"tuning_{name}", base, [])

    for name in TUNERS:
        run.do("model_tuning", f"tuning_{name}", lambda name=name: searched(name), logged=False)
    results = [run.read(f"tuning_{name}").drop("processed_at") for name in TUNERS]
    importances = [run.read(f"importance_{name}").drop("processed_at") for name in TUNERS]
    run.do("model_tuning", sinks.TUNING_TABLE, lambda: sinks.write_tuning_results(reduce(DataFrame.unionByName, results), base))
    run.write("model_tuning", "feature_importance", lambda: reduce(DataFrame.unionByName, importances), ["model_name", "feature"])
    run.write("model_tuning", "model_comparison", lambda: tuning.model_comparison(results), ["model_name"])
    run.log()
    run.write("model_tuning", "model_summary", lambda: reporting.model_summary(run.read(sinks.TUNING_TABLE)), ["section", "metric"])
    run.log()
