"""Physical plans: pruned scans, single shuffles, reuse, skewed joins."""

import re

import pytest
from pyspark.sql.types import StringType

from skyledger.operators import sinks
from skyledger.operators.cleaning import clean_readings
from skyledger.schema import readings_schema
from skyledger.sources.readings import scan_readings

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, readings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "readings")
    sinks.write_readings(readings, path, "parquet")
    return scan_readings(spark, path, "parquet", readings_schema(record_id=StringType()))


def test_filter_and_columns_reach_the_scan(table, capsys):
    clean_readings(table).groupBy("country").avg("AQI").explain("formatted")
    plan = capsys.readouterr().out
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert {"IsNotNull(AQI)", "GreaterThanOrEqual(AQI,0)", "LessThanOrEqual(AQI,500)"} <= set(pushed.split(", "))
    scanned = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {f.split(":")[0] for f in scanned.split(",")} == {
        "PM2_5", "PM10", "NO2", "SO2", "CO", "O3", "AQI", "country", "city", "station_id"}


def test_hourly_table_shuffles_once(table):
    from skyledger.operators.result_tables import hourly_patterns
    plan = plan_of(hourly_patterns(clean_readings(table)))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("HashAggregate") == 2


def test_station_count_needs_no_expand(table):
    from skyledger.operators.result_tables import city_aqi_stats
    assert "Expand" not in plan_of(city_aqi_stats(clean_readings(table)))


def test_sample_ranks_only_rows_below_the_cut(table):
    from skyledger.sources.sampling import sample_rows
    plan = plan_of(sample_rows(table.select("record_id", "AQI"), 10))
    assert re.search(r"Filter .*<= .*ubquery", plan)


def final_plan(df):
    df.collect()
    return plan_of(df)


def test_quantiles_shuffle_no_column(spark, table):
    """Between the scan and the filter of the hit ranges only sketches and counts per range are exchanged."""
    from skyledger.operators.distributions import exact_quantiles
    plan = final_plan(exact_quantiles(table, ["PM2_5", "NO2"], [0.25, 0.5]))
    assert plan.index("BroadcastNestedLoopJoin" if "BroadcastNestedLoopJoin" in plan else "BroadcastHashJoin") and "SortMergeJoin" not in plan
    metrics = [line for line in plan.splitlines() if "hashpartitioning(column" in line and "value" in line]
    assert metrics == []


def test_samples_keep_a_bounded_number_of_rows(table):
    from skyledger.sources.sampling import head_per_part, sample_per_part, sample_rows
    for df in (sample_rows(table.select("record_id", "AQI"), 10), head_per_part(table.select("record_id", "year", "timestamp"), "year", n=10),
               sample_per_part(table.select("record_id", "year"), "year", 100, floor=5)):
        plan = plan_of(df)
        assert "WindowGroupLimit" in plan and plan.count("FileScan parquet") <= 2 * plan_of(table.select("record_id")).count("FileScan parquet") + 6


def test_compliance_reads_twice(table):
    from skyledger.operators.distributions import compliance_histogram
    from skyledger.operators.trends import investment_trend
    assert plan_of(investment_trend(table)).count("FileScan parquet") == 1
    assert final_plan(compliance_histogram(table)).partition("== Initial Plan")[0].count("FileScan parquet") <= 3


def test_hot_station_is_split_by_the_shuffled_join(spark, table):
    """One station with a third of the rows: adaptive execution splits its partition."""
    from pyspark.sql import functions as F
    from skyledger.operators.joins import commissioned_only
    names = [f"AQ-{i:06d}" for i in range(200)]
    registry = spark.createDataFrame([(n, 1990) for n in names], "station_id string, commissioning_year int")
    station = F.when(F.col("id") % 3 == 0, names[0]).otherwise(F.format_string("AQ-%06d", F.col("id") % 200))
    facts = spark.range(0, 400_000, 1, 8).select(station.alias("station_id"), F.lit(2000).alias("year"), F.md5(F.col("id").cast("string")).alias("m"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB"}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        kept = commissioned_only(facts, registry)
        assert kept.groupBy().count().first()[0] == 400_000
        assert "skew=true" in final_plan(kept.select(F.length("m").alias("n")))
    finally:
        for key in settings:
            spark.conf.unset(key)
