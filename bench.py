"""Time the headline queries and the whole pipeline; prints one JSON line.

``value`` is the wall time of the pipeline the baseline publishes (scan CSV,
clean, seven result tables, store) on its first run in a new session;
``pipeline_warm`` is a second run. Every other key of ``queries`` is a single
operator over the same readings.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql.types import StringType  # noqa: E402

from checks.queries import QUERIES  # noqa: E402
from skyledger.operators import sinks  # noqa: E402
from skyledger.plans.pipeline import run_pipeline  # noqa: E402
from skyledger.schema import readings_schema  # noqa: E402
from skyledger.session import build_session  # noqa: E402
from skyledger.sources import star  # noqa: E402
from skyledger.sources.readings import scan_readings  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "clean_readings", "cleaning_audit", "country_aqi_stats", "city_aqi_stats", "yearly_trends", "sector_impact",
    "policy_effectiveness", "hourly_patterns", "health_correlations", "describe_pollutants", "aqi_histogram",
    "box_stats", "correlation_matrix", "yearly_aqi_band", "top_cities", "industrial_trend", "regulation_pearson",
    "compliance_histogram", "investment_trend", "health_by_country_normalized", "admissions_histogram",
    "summary_metrics", "dataset_metadata", "sample_per_part", "head_per_part", "sample_rows", "enrich_with_registry",
    "commissioned_only", "observation_spine", "pollution_factor", "expected_weather", "country_ranking",
    "overview_cards", "ml_features", "train_test_split", "scale_profiles",
]


def timed(job) -> float:
    started = time.perf_counter()
    job()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = build_session("skyledger-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="skyledger-bench-")
    readings = star.readings(spark, FOLDER)
    # the input of the pipeline: CSV parts as the source application writes them, not timed
    sinks.write_readings(readings.repartition(int(CPUS)), f"{work}/csv")
    raw = scan_readings(spark, f"{work}/csv", schema=readings_schema(record_id=StringType()))
    rows = raw.count()
    pipeline = timed(lambda: run_pipeline(spark, raw, f"{work}/results", ["clean", "tables"]))
    again = timed(lambda: run_pipeline(spark, raw, f"{work}/again", ["clean", "tables"]))
    queries = {"pipeline": pipeline, "pipeline_warm": again}
    for name in HEADLINE:
        queries[name] = timed(lambda: QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "pipeline_wall_time", "value": pipeline, "unit": "sec", "queries": queries,
        "sf": Path(FOLDER).name.removeprefix("sf"), "rows": rows, "rows_per_sec": round(rows / pipeline),
        "total_query_seconds": round(sum(queries.values()), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
